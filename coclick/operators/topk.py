"""Ranking, bounded top-k and list building (AG4, WN3-WN9, FLT8, FLT9).

``row_number() <= k`` with a literal k is planned by Spark as a
WindowGroupLimit: each map task keeps only its local top k per key before the
shuffle, so a hot key sends at most k rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_by_key(df: DataFrame, key_cols: list[str], order_cols: list, k: int | None,
                 rank_col: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows per key by ``order_cols``; adds a 1-based bigint rank.

    ``k=None`` ranks without a limit.
    """
    w = Window.partitionBy(*key_cols).orderBy(*order_cols)
    out = df.withColumn(rank_col, F.row_number().over(w))
    if k is not None:
        out = out.where(F.col(rank_col) <= k)
    return out.withColumn(rank_col, F.col(rank_col).cast("bigint"))


# Scores that are sums of doubles differ in the last bits with the order of
# summation (partitioning, engine).  Rankings order by the score rounded to
# RANK_DIGITS places, then by id, so ties are decided the same way everywhere.
RANK_DIGITS = 9


def rank_key(score) -> Column:
    score = F.col(score) if isinstance(score, str) else score
    return F.round(score, RANK_DIGITS).desc()


def floor_filter(rank: Column, score: Column, min_keep: int = 50, floor: float = 0.001,
                 max_len: int = 200) -> Column:
    """FLT8: the first ``min_keep`` always, later ones only while score > floor.

    The reference walks a score-sorted list and stops at the first failure;
    with a descending order that equals this row predicate.
    """
    return (rank <= max_len) & ((rank <= min_keep) | (score > floor))


def clamp(score: Column, hi: float = 1.0) -> Column:
    """FLT9: scores above ``hi`` become ``hi``."""
    return F.least(score, F.lit(hi))


def collect_ranked(df: DataFrame, key_cols: list[str], rank_col: str, fields: list[str],
                   out_col: str = "items") -> DataFrame:
    """Per key, an array of structs ordered by ``rank_col`` (bounded by the preceding top-k)."""
    s = F.struct(F.col(rank_col).alias("__r"), *[F.col(f) for f in fields])
    arr = F.array_sort(F.collect_list(s))
    return df.groupBy(*key_cols).agg(
        F.transform(arr, lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias(out_col))


def cap_per_group(df: DataFrame, key_cols: list[str], group_expr: Column, order_cols: list,
                  per_group: int = 5, total: int = 500, rank_col: str = "rank") -> DataFrame:
    """WN9: walk a ranked list, keep at most ``per_group`` rows per group value,
    then at most ``total`` rows; ``rank_col`` is the position in the kept list.

    (The reference groups neighbour ids by their low 32 bits: pass
    ``F.col('item').bitwiseAND(0xFFFFFFFF)``.)
    """
    g = df.withColumn("__g", group_expr)
    w_g = Window.partitionBy(*key_cols, "__g").orderBy(*order_cols)
    kept = g.withColumn("__gr", F.row_number().over(w_g)).where(F.col("__gr") <= per_group)
    return top_k_by_key(kept.drop("__g", "__gr"), key_cols, order_cols, total, rank_col)
