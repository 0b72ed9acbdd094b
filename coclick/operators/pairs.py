"""Pair generators shared by item-CF, Swing, user-CF and the session graph.

All of them are equi-joins plus filters, never cross joins, and every one
splits a large group into bounded join keys, so that a single hot user, item
or session cannot pin its whole quadratic fan-out on one task:

* :func:`window_pairs`   positional sliding window inside a ranked list (WN1)
* :func:`group_pairs`    all unordered member pairs of a group (JN12)
* :func:`next_pairs`     consecutive elements (lead 1, WN2) as a join on rn+1

Positions come from :func:`coclick.operators.positions.numbered`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coclick.operators.skew import split_join

# Rows per block.  A join key then holds at most about BLOCK x BLOCK candidate
# pairs, whatever the size of the group it came from.
DEFAULT_BLOCK = 2048


def canonical_pair(a, b) -> tuple[Column, Column]:
    """FLT7: (min, max) so each unordered pair has one key."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.least(a, b), F.greatest(a, b)


def _exploding(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """An inner join that makes far more rows than it reads.

    Adaptive execution sizes its tasks by the bytes they read and would leave a
    few with all the pairs; the session's number of partitions is kept instead.
    """
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return left.repartition(parts, *on).join(right.repartition(parts, *on), on)


def window_pairs(ranked: DataFrame, group_cols: list[str], pos_col: str, size_col: str,
                 value_cols: list[str], window: int, block: int = DEFAULT_BLOCK) -> DataFrame:
    """WN1: pair every row with the next ``window`` positions of its group.

    ``ranked`` has a dense 1-based position ``pos_col`` and the group size
    ``size_col``.  Rows are cut into position blocks of ``block``; a left row
    is sent to every block its window reaches, so the join key is
    ``(group, block)`` and holds at most ``window + block`` left rows and
    ``block`` right rows.  Output columns: group cols, ``<v>_a``, ``<v>_b`` for
    each value col, plus ``pos_a``/``pos_b``.
    """
    pos = F.col(pos_col)
    blk = F.floor((pos - 1) / block).cast("bigint")
    last_blk = F.floor((F.col(size_col) - 1) / block).cast("bigint")
    reach = F.least(F.floor((pos - 1 + window) / block).cast("bigint"), last_blk)
    left = ranked.select(*group_cols, pos.alias("pos_a"),
                         *[F.col(v).alias(f"{v}_a") for v in value_cols],
                         F.explode(F.sequence(blk, reach)).alias("__blk"))
    right = ranked.select(*group_cols, pos.alias("pos_b"),
                          *[F.col(v).alias(f"{v}_b") for v in value_cols], blk.alias("__blk"))
    joined = _exploding(left, right, [*group_cols, "__blk"])
    return joined.where((F.col("pos_b") > F.col("pos_a")) & (F.col("pos_b") <= F.col("pos_a") + window)).drop("__blk")


def group_pairs(members: DataFrame, group_cols: list[str], member_col: str,
                min_size: int = 2, max_size: int | None = None, block: int = DEFAULT_BLOCK,
                carry: list[str] | None = None, rows_per_piece: int | None = None) -> DataFrame:
    """JN12: every unordered pair ``a < b`` of distinct members of each group.

    ``members`` must be distinct on (group, member).  Groups outside
    ``[min_size, max_size]`` are skipped (FLT2).  A group of n members is split
    into ``s = ceil(n / block)`` hash blocks; the pair (a, b) is produced under
    the key (group, block(a), block(b)) exactly once, so each join key holds at
    most ~block x block pairs.  Small groups (s = 1) are a plain self-join.
    Group sizes come from a partial (map-side combined) count;
    groups of more than ``rows_per_piece`` members meet theirs in several tasks.
    """
    carry = carry or []
    sizes = members.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("__n"))
    cond = F.col("__n") >= min_size
    if max_size is not None:
        cond = cond & (F.col("__n") <= max_size)
    sizes = sizes.where(cond).select(*group_cols, F.ceil(F.col("__n") / block).cast("bigint").alias("__s"))
    # one size row per group; the members of a heavy group are dealt to several tasks
    m = split_join(members, sizes, group_cols, rows_per_piece=rows_per_piece, split_right=False) \
        .withColumn("__b", F.pmod(F.xxhash64(F.col(member_col)), F.col("__s")))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__s") - 1))
    left = m.select(*group_cols, F.col(member_col).alias("a"), *[F.col(c).alias(f"{c}_a") for c in carry],
                    F.col("__b").alias("__ba"), other.alias("__bb"))
    right = m.select(*group_cols, F.col(member_col).alias("b"), *[F.col(c).alias(f"{c}_b") for c in carry],
                     F.col("__b").alias("__bb"), other.alias("__ba"))
    return _exploding(left, right, [*group_cols, "__ba", "__bb"]) \
        .where(F.col("a") < F.col("b")).drop("__ba", "__bb")


def next_pairs(indexed: DataFrame, group_cols: list[str], value_col: str, pos_col: str = "pos") -> DataFrame:
    """WN2: (value at pos, value at pos+1) inside each group, as an equi-join."""
    a = indexed.select(*group_cols, (F.col(pos_col) + 1).alias("__p"), F.col(value_col).alias("a"))
    b = indexed.select(*group_cols, F.col(pos_col).alias("__p"), F.col(value_col).alias("b"))
    return a.join(b, on=[*group_cols, "__p"], how="inner").drop("__p")


def symmetrise(df: DataFrame, a_cols: list[str], b_cols: list[str], out_a: list[str], out_b: list[str],
               keep: list[str] | None = None) -> DataFrame:
    """SET3: emit each row in both directions (a->b and b->a), one pass, no union."""
    keep = keep or []
    fwd = F.struct(*[F.col(c).alias(o) for c, o in zip(a_cols, out_a)],
                   *[F.col(c).alias(o) for c, o in zip(b_cols, out_b)])
    rev = F.struct(*[F.col(c).alias(o) for c, o in zip(b_cols, out_a)],
                   *[F.col(c).alias(o) for c, o in zip(a_cols, out_b)])
    return df.select(*keep, F.explode(F.array(fwd, rev)).alias("__d")).select(*keep, "__d.*")
