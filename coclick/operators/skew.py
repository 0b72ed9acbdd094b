"""Joins whose heavy keys are split by their measured size (JN4, JN7, JN8, JN10, JN12).

One pass over each side's keys builds a mergeable frequent-items summary
(``approx_top_k``); a key whose rows exceed an average task's share is named
there.  Only named keys are salted: their rows are dealt to as many pieces as
their size asks for, and the other side's rows of that key are sent to each
piece.  If both sides are heavy in a key, the pieces form a grid.  All other keys
join as they are, without a salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Frequent items kept by the summary: a key with more than about 1/TRACKED of the rows is always named.
TRACKED = 4096
#: No key with fewer rows is split.
LEAST_ROWS = 10_000


def heavy_keys(df: DataFrame, on: list[str], rows_per_piece: int | None = None, tracked: int = TRACKED,
               least_rows: int = LEAST_ROWS) -> dict[int, int]:
    """{hash of the key: pieces} of the keys with more than ``rows_per_piece`` rows.

    The default share is the rows of an average task (``least_rows`` at least).
    A single aggregate with map-side summaries; the driver gets at most
    ``tracked`` counts.  Summary counts never fall short by more than the
    sketch's error, so a named key's pieces are about ``rows_per_piece`` long.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    summary = df.select(F.xxhash64(*on).alias("h")).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(h, {tracked // 4}, {tracked})").alias("top")).first()
    share = rows_per_piece or max(least_rows, -(-summary["n"] // tasks))
    return {r["item"]: -(-r["count"] // share) for r in summary["top"] or [] if r["count"] > share}


def heavy_from_sizes(sizes: DataFrame, on: list[str], size_col: str, rows_per_piece: int,
                     tracked: int = TRACKED) -> dict[int, int]:
    """{hash of the key: pieces} where a table already holds one row per key with its (expected) number of rows."""
    top = sizes.where(F.col(size_col) > rows_per_piece).select(F.xxhash64(*on).alias("h"), F.col(size_col).alias("n")) \
        .orderBy(F.desc("n"), "h").limit(tracked // 4).collect()
    return {r["h"]: int(-(-r["n"] // rows_per_piece)) for r in top}


def split_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner",
               rows_per_piece: int | None = None, split_right: bool = True, least_rows: int = LEAST_ROWS,
               heavy_left: dict[int, int] | None = None, by: list[str] | None = None) -> DataFrame:
    """``left.join(right, on, how)`` with heavy keys split; ``how`` is inner, left or left_semi.

    Rows of a heavy key are dealt by a hash of all their columns, so a repeated
    task deals them the same way.  Only in inner joins is the right side split as
    well (``split_right``); in the others a left row meets all its partners in one task.
    ``heavy_left`` gives the left side's pieces if they are known; ``by`` names the
    columns of ``on`` that those keys are of.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"how is inner, left or left_semi, not {how}")
    if heavy_left is None:
        heavy_left = heavy_keys(left, by or on, rows_per_piece, least_rows=least_rows)
    heavy_right = heavy_keys(right, by or on, rows_per_piece, least_rows=least_rows) if split_right and how == "inner" else {}
    named = sorted({*heavy_left, *heavy_right})
    if not named:
        return left.join(right, on, how)
    spark = left.sparkSession
    pieces = F.broadcast(spark.createDataFrame(
        [(h, heavy_left.get(h, 1), heavy_right.get(h, 1)) for h in named], "__h long, __l long, __r long"))

    def dealt(df: DataFrame, own: str, other: str, own_salt: str, other_salt: str) -> DataFrame:
        d = df.withColumn("__h", F.xxhash64(*(by or on))).join(pieces, "__h", "left")
        many = F.coalesce(F.col(other), F.lit(1).cast("long"))
        return d.withColumns({
            own_salt: F.pmod(F.xxhash64(*[F.col(c) for c in df.columns], F.lit("deal")),
                             F.coalesce(F.col(own), F.lit(1).cast("long"))),
            other_salt: F.explode(F.sequence(F.lit(0).cast("long"), many - 1))}).drop("__h", "__l", "__r")

    return dealt(left, "__l", "__r", "__a", "__b").join(
        dealt(right, "__r", "__l", "__b", "__a"), [*on, "__a", "__b"], how).drop("__a", "__b")
