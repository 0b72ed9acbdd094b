"""Text and vector inputs (SRC11, SRC12, SRC13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_sentences(spark: SparkSession, path: str) -> DataFrame:
    """SRC11: one sentence per line, tokens separated by one space -> ``tokens array<string>``."""
    return spark.read.text(path).select(F.split("value", " ").alias("tokens"))


def read_user_lists(spark: SparkSession, path: str) -> DataFrame:
    """SRC12: ``user\\titem,item,...`` lines -> (user bigint, items array<bigint>)."""
    df = spark.read.option("sep", "\t").schema("user string, items string").csv(path)
    return df.select(F.col("user").try_cast("bigint").alias("user"),
                     F.transform(F.split("items", ","), lambda x: x.try_cast("bigint")).alias("items"))


def read_vectors(spark: SparkSession, path: str, id_col: str | None = None,
                 vec_col: str | None = None) -> DataFrame:
    """SRC13: Parquet (id, vector) -> (id bigint, vec array<float>).

    Without names the first two columns are used, like the index builder.
    """
    df = spark.read.parquet(path)
    id_col = id_col or df.columns[0]
    vec_col = vec_col or df.columns[1]
    return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<float>").alias("vec"))


def parse_score_lists(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """SC8: ``key<TAB>id:score;id:score`` lines -> rows (key, pos, item, score)."""
    parts = F.split(F.col(line_col), "\t")
    rows = lines.select(parts.getItem(0).cast("bigint").alias("key"),
                        F.posexplode(F.split(parts.getItem(1), ";")).alias("pos", "entry"))
    entry = F.split("entry", ":")
    return rows.select("key", (F.col("pos") + 1).cast("bigint").alias("pos"), entry.getItem(0).cast("bigint").alias("item"),
                       entry.getItem(1).cast("double").alias("score"))
