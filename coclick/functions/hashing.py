"""Reproducible randomness as expressions.

Sampling in the reference is unseeded.  Here every random choice is a hash of
(seed, context, draw), so task retries, repartitioning and a second engine
(the SQL oracle) give the same draws.  MD5 is used because it prints the same
hex text on every engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _str(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def uniform_hash(*parts) -> Column:
    """60-bit non-negative bigint from MD5 of the ``|``-joined parts."""
    s = F.concat_ws("|", *[_str(p) for p in parts])
    return F.conv(F.substring(F.md5(s), 1, 15), 16, 10).cast("bigint")


def floyd_sample(n, r, seed: str, *context) -> Column:
    """``r`` distinct indices out of ``[0, n)``, uniform over all r-subsets.

    Floyd's algorithm: for j = n-r .. n-1 draw t in [0, j]; take t unless it
    was taken already, then take j.  Written as an ``aggregate`` over
    ``sequence`` so it stays a JVM expression; O(r^2) per row, independent of n.
    """
    n = F.col(n) if isinstance(n, str) else n
    r = F.col(r) if isinstance(r, str) else r
    empty = F.array().cast("array<bigint>")

    def step(acc, j):
        t = F.pmod(uniform_hash(F.lit(seed), *context, j), j + 1)
        return F.when(F.array_contains(acc, t), F.concat(acc, F.array(j))) \
            .otherwise(F.concat(acc, F.array(t)))

    seq = F.sequence((n - r).cast("bigint"), (n - 1).cast("bigint"))
    return F.when(r > 0, F.aggregate(seq, empty, step)).otherwise(empty)


def balanced_draws(n, k: int, seed: str, *context) -> Column:
    """Exactly ``k`` neighbour indices out of ``n`` (GR4).

    Every index appears ``k div n`` times, and ``k mod n`` further indices are
    drawn without replacement.  Empty when n = 0.
    """
    n = F.col(n) if isinstance(n, str) else n
    nb = n.cast("bigint")
    q = F.floor(F.lit(k) / nb).cast("bigint")
    rem = F.pmod(F.lit(k).cast("bigint"), nb)
    empty = F.array().cast("array<bigint>")
    full = F.when(q > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), q * nb - 1), lambda x: F.pmod(x, nb))) \
        .otherwise(empty)
    return F.when(nb > 0, F.concat(full, floyd_sample(nb, rem, seed, *context))).otherwise(empty)
