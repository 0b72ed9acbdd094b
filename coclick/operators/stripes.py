"""Pair counts without a shuffled row per pair.

The pairs ``a < b`` of a group travel as stripes: one row per group and member
``a`` with its partners ``b`` in arrays of bounded length, hashed and sorted by
``a``.  A task reads the stripes as Arrow batches and closes one ``a`` after the
other: it sums its pairs (:func:`pair_sums`) or keeps the pairs that several groups
hold (:func:`shared_members`).  A pair costs the few bytes of one array element,
once; what is held is a buffer of :data:`ELEMENTS` and the pairs of one ``a``.

Groups of more than ``block`` members meet block by block, and an ``a`` of very many
stripes is dealt to several tasks by a hash of its partners.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coclick.operators.skew import heavy_keys, split_join
from coclick.session import ship_package

#: Members of a group that one array holds.
STRIPE = 256
#: Pairs that a task sorts at a time.
ELEMENTS = 2_000_000
#: Stripes of one member that a task reads.
STRIPES_PER_PIECE = 50_000


def group_stripes(members: DataFrame, group_cols: list[str], member_col: str, value_col: str | None = None,
                  min_size: int = 2, max_size: int | None = None, block: int = STRIPE) -> DataFrame:
    """(group cols, a, bs[, v, vs]): per group and member ``a`` the members over it, and their values.

    ``members`` are distinct on (group, member); groups outside ``[min_size, max_size]`` are skipped.
    """
    sizes = members.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("__n"), F.min(member_col).alias("__lo"), F.max(member_col).alias("__hi"))
    of = sizes.agg(F.max("__n").alias("longest"), F.min("__lo").alias("lo"), F.max("__hi").alias("hi")).first()
    longest = of["longest"] or 0
    # ids that fit four bytes take four
    short = of["lo"] is not None and of["lo"] >= -(1 << 31) and of["hi"] < 1 << 31
    fields = [F.col(member_col).cast("int" if short else "bigint").alias("m"), *([F.col(value_col).alias("v")] if value_col else [])]
    d = members.where(F.col(member_col).isNotNull()).select(*group_cols, F.struct(*fields).alias("__x"))
    for c in group_cols:
        d = d.where(F.col(c).isNotNull())
    fits = F.col("__n") >= min_size
    fits = fits & (F.col("__n") <= max_size) if max_size is not None else fits
    if longest <= min(block, max_size or block) and min_size <= 2:
        lists = d.groupBy(*group_cols).agg(F.sort_array(F.collect_list("__x")).alias("__l")).where(F.size("__l") >= min_size)
        at = lists.select(*group_cols, F.col("__l.m").alias("__m"), *([F.col("__l.v").alias("__v")] if value_col else []),
                          F.posexplode("__l").alias("__p", "__x"))
        rest = lambda c: F.slice(c, F.col("__p") + 2, F.size("__m"))
        out = at.where(F.col("__p") + 1 < F.size("__m"))
        return out.select(*group_cols, F.col("__x.m").alias("a"), rest("__m").alias("bs"),
                          *([F.col("__x.v").alias("v"), rest("__v").alias("vs")] if value_col else []))
    sizes = sizes.where(fits).select(*group_cols, F.ceil(F.col("__n") / block).cast("bigint").alias("__s"))
    lists = split_join(d, sizes, group_cols, split_right=False) \
        .groupBy(*group_cols, "__s", F.pmod(F.xxhash64("__x.m"), F.col("__s")).alias("__b")) \
        .agg(F.sort_array(F.collect_list("__x")).alias("__l"))
    left = lists.select(*group_cols, F.col("__l").alias("__a"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__s") - 1)).alias("__b"))
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    on = [*group_cols, "__b"]
    met = left.repartition(parts, *on).join(lists.select(*on, "__l").repartition(parts, *on), on) \
        .select(*group_cols, F.explode("__a").alias("__x"), "__l") \
        .select(*group_cols, "__x", F.filter("__l", lambda y: y["m"] > F.col("__x.m")).alias("__l")).where(F.size("__l") > 0)
    return met.select(*group_cols, F.col("__x.m").alias("a"), F.col("__l.m").alias("bs"),
                      *([F.col("__x.v").alias("v"), F.col("__l.v").alias("vs")] if value_col else []))


def _dealt(stripes: DataFrame, members: DataFrame, member_col: str) -> DataFrame:
    """Stripes sorted by ``a`` in the task of its hash; those of a heavy ``a`` are cut by their partners' hashes."""
    heavy = heavy_keys(members.select(F.col(member_col).cast("bigint").alias("a")), ["a"], STRIPES_PER_PIECE)
    spark = stripes.sparkSession
    if heavy:
        pieces = F.broadcast(spark.createDataFrame(sorted(heavy.items()), "__h long, __k long"))
        rest = [c for c in stripes.columns if c not in ("bs", "vs")]
        cut = stripes.withColumn("__h", F.xxhash64("a")).join(pieces, "__h", "left") \
            .withColumn("__k", F.coalesce("__k", F.lit(1).cast("long"))) \
            .withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__k") - 1)))
        mine = lambda b: F.pmod(F.xxhash64(b), F.col("__k")) == F.col("__part")
        if "vs" in stripes.columns:
            cut = cut.withColumn("__z", F.when(F.col("__k") == 1, F.arrays_zip("bs", "vs"))
                                 .otherwise(F.filter(F.arrays_zip("bs", "vs"), lambda z: mine(z["bs"])))) \
                .select(*rest, "__part", F.col("__z.bs").alias("bs"), F.col("__z.vs").alias("vs"))
        else:
            cut = cut.withColumn("bs", F.when(F.col("__k") == 1, F.col("bs")).otherwise(F.filter("bs", mine))).select(*rest, "__part", "bs")
        stripes = cut.where(F.size("bs") > 0)
    else:
        stripes = stripes.withColumn("__part", F.lit(0).cast("long"))
    ship_package(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = [F.desc("asked")] if "asked" in stripes.columns else []   # what is asked of a member comes before its stripes
    return stripes.repartition(parts, "a", "__part").sortWithinPartitions("a", *first)


def integral(df: DataFrame, *cols: str) -> bool:
    """Whether the columns hold whole numbers of at most 64 bits, which stripes are made of."""
    return all(df.schema[c].dataType.typeName() in ("byte", "short", "integer", "long") for c in cols)


def _codes(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One number per (a, b), in their order, with what its two halves stand for; ``a`` is sorted."""
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(a))))
    low, high = int(b.min()), int(b.max())
    if (high - low + 1) * len(first) < 1 << 60:
        return of * (high - low + 1) + (b - low), a[first], np.array([low, high - low + 1])
    names, b = np.unique(b, return_inverse=True)
    return of * len(names) + b, a[first], names


def _named(codes: np.ndarray, firsts: np.ndarray, names: np.ndarray, spanned: bool) -> tuple[np.ndarray, np.ndarray]:
    of, b = np.divmod(codes, names[1] if spanned else len(names))
    return firsts[of], b + names[0] if spanned else names[b]


def _by_member(reduce):
    """Runs ``reduce(columns) -> columns`` (a, b and more, sorted by a) over buffers of stripes.

    The last ``a`` of a buffer is held back, reduced, as its stripes may go on: ``reduce``
    also gets rows that it returned before.
    """
    def run(batches: Iterator[pa.RecordBatch], columns) -> Iterator[tuple]:
        held, count, limit = [], 0, ELEMENTS
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(columns(batch))
            count += len(held[-1][0])
            if count < limit:
                continue
            rows = reduce(tuple(map(np.concatenate, zip(*held, strict=True))))
            if not len(rows[0]):
                held, count, limit = [], 0, ELEMENTS
                continue
            cut = np.searchsorted(rows[0], rows[0][-1])
            if cut:
                yield tuple(c[:cut] for c in rows)
            # what one member holds is not sorted again until as much has come
            held, count, limit = [tuple(c[cut:] for c in rows)], 0, max(ELEMENTS, len(rows[0]) - int(cut))
        if held:
            yield reduce(tuple(map(np.concatenate, zip(*held, strict=True))))
    return run


def pair_sums(stripes: DataFrame, members: DataFrame, member_col: str, asked: DataFrame | None = None,
              least: float | None = None, carried: bool = False, marked: bool = False) -> DataFrame:
    """(a, b, weight): groups that hold both members (bigint), or with values the sum of ``v(a) * v(b)`` (double).

    ``carried`` values belong to the members: they are counted and go along as ``va`` and ``vb``.
    With ``marked`` only pairs with two positive values in one group are wanted, and values count without sign.
    ``asked(a, b)`` names the only pairs that are wanted; ``least`` the least weight of a pair.
    ``members`` is what the stripes were made of: its frequent members are dealt to several tasks.
    """
    valued, named = "vs" in stripes.columns, asked is not None
    some = named or marked
    s = stripes.select(F.col("a").cast("bigint").alias("a"), "bs", *([F.col("v").cast("double").alias("v"), F.col("vs").cast("array<double>").alias("vs")] if valued else []),
                       F.lit(False).alias("asked"))
    if asked is not None:
        one, of = F.array(F.lit(0.0)), stripes.schema["bs"].dataType.elementType.typeName()
        known = asked if of != "integer" else asked.where(F.col("b").between(-(1 << 31), (1 << 31) - 1))
        s = s.unionByName(known.select(F.col("a").cast("bigint").alias("a"), F.array(F.col("b").cast(of)).alias("bs"),
                                       *([F.lit(0.0).alias("v"), one.alias("vs")] if valued else []), F.lit(True).alias("asked")))

    def columns(batch: pa.RecordBatch) -> tuple:
        n = pc.list_value_length(batch.column("bs")).to_numpy()
        a = np.repeat(batch.column("a").to_numpy(), n)
        b = batch.column("bs").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        wish = np.repeat(batch.column("asked").to_numpy(zero_copy_only=False), n)
        if not valued:
            return a, b, np.where(wish, 0, 1), wish
        va, vb = np.repeat(batch.column("v").to_numpy(), n), batch.column("vs").flatten().to_numpy(zero_copy_only=False)
        if marked:
            return a, b, np.abs(va * vb), (va > 0) & (vb > 0)
        return (a, b, np.where(wish, 0, 1), wish, va, vb) if carried else (a, b, np.where(wish, 0.0, va * vb), wish)

    def reduce(rows: tuple) -> tuple:
        a, b, w, wish, *more = rows
        if not len(a):
            return rows
        codes, firsts, names = _codes(a, b)
        spanned = (int(b.max()) - int(b.min()) + 1) * len(firsts) < 1 << 60
        if named:
            # most pairs are not asked for: they are left out before the sort
            known = np.unique(codes[wish])
            at = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
            keep = known[at] == codes if len(known) else np.zeros(len(codes), bool)
            codes, w, wish, more = codes[keep], w[keep], wish[keep], [m[keep] for m in more]
            if not len(codes):
                return tuple(c[:0] for c in rows)
        if not more and not valued and not some and w.max() == 1:
            codes.sort()
            at = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            w, wish = np.diff(np.append(at, len(codes))), np.zeros(len(at), bool)
        else:
            by = np.argsort(codes, kind="stable")
            codes = codes[by]
            at = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            w, wish = np.add.reduceat(w[by], at), np.logical_or.reduceat(wish[by], at)
            more = [m[by[at]] for m in more]
        return *_named(codes[at], firsts, names, spanned), w, wish, *more

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b, w, wish, *more in _by_member(reduce)(batches, columns):
            keep = wish & (w != 0) if some else np.ones(len(a), bool)
            if least is not None:
                keep &= w >= least
            out = [c[keep] for c in (a, b, w, *more)]
            for i in range(0, len(out[0]), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[i:i + 100_000]) for c in out], names=["a", "b", "weight", "va", "vb"][:len(out)])

    weight = "double" if valued and not carried else "long"
    return _dealt(s, members, member_col).mapInArrow(run, f"a long, b long, weight {weight}{', va double, vb double' if carried else ''}")


def shared_members(stripes: DataFrame, members: DataFrame, member_col: str, group_col: str, carry: str | None = None,
                   paired: int = 0) -> DataFrame:
    """(a, b, group[, carry]), each once: the groups of every pair that at least two of them hold.

    ``carry`` is a number that belongs to the group.  With ``paired`` a pair of at most that many groups
    gives a row for every two of them, ``group < group_b`` (and ``carry_b``); ``group_b`` is null in the others' rows.
    """
    s = stripes.select(F.col("a").cast("bigint").alias("a"), "bs", F.col(group_col).cast("bigint").alias("g"), (F.col(carry).cast("double") if carry else F.lit(0.0)).alias("c"))

    def columns(batch: pa.RecordBatch) -> tuple:
        n = pc.list_value_length(batch.column("bs")).to_numpy()
        return (np.repeat(batch.column("a").to_numpy(), n), batch.column("bs").flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                np.repeat(batch.column("g").to_numpy(), n), np.repeat(batch.column("c").to_numpy(), n))

    def reduce(rows: tuple) -> tuple:
        # every group of a pair once; pairs of one group stay until their ``a`` is complete
        a, b, g, c = rows
        if not len(a):
            return rows
        codes, _, _ = _codes(a, b)
        by = np.lexsort((g, codes))
        codes, g = codes[by], g[by]
        keep = np.concatenate([[True], (codes[1:] != codes[:-1]) | (g[1:] != g[:-1])])
        by = by[keep]
        return a[by], b[by], g[keep], c[by]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_member(reduce)(batches, columns):
            a, b = rows[:2]
            same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
            keep = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(a) else np.zeros(0, bool)
            rows = [r[keep] for r in rows]
            for part in _two_by_two(*rows, paired) if paired else [rows]:
                for i in range(0, len(part[0]), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(r[i:i + 100_000]) for r in part], names=["a", "b", "g", "c", "h", "d"][:len(part)])

    out = _dealt(s, members, member_col).mapInArrow(run, f"a long, b long, g long, c double{', h long, d double' if paired else ''}")
    if paired:
        return out.select("a", "b", F.col("g").alias(group_col), F.col("h").alias(f"{group_col}_b"),
                          *([F.col("c").alias(carry), F.col("d").alias(f"{carry}_b")] if carry else []))
    return out.select("a", "b", F.col("g").alias(group_col), *([F.col("c").alias(carry)] if carry else []))


def _two_by_two(a: np.ndarray, b: np.ndarray, g: np.ndarray, c: np.ndarray, most: int) -> Iterator[tuple]:
    """Rows sorted by (a, b, g), as (a, b, g, c, h, d): every two groups g < h of a pair that has at most ``most``."""
    if not len(a):
        return
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    size = np.diff(np.append(first, len(a)))
    at, size = np.arange(len(a)) - np.repeat(first, size), np.repeat(size, size)
    many = size > most
    if many.any():
        none = pa.nulls(int(many.sum()))
        yield a[many], b[many], g[many], c[many], none.cast(pa.int64()), none.cast(pa.float64())
    left = np.flatnonzero(~many)
    after = (size - at - 1)[left]
    # so many rows that about ELEMENTS pairs are held at a time
    cuts = np.searchsorted(np.cumsum(after), np.arange(ELEMENTS, int(after.sum()), ELEMENTS), "right")
    for of, n in zip(np.split(left, cuts), np.split(after, cuts), strict=True):
        x = np.repeat(of, n)
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
        yield a[x], b[x], g[x], c[x], g[y], c[y]
