import os
import tempfile

from pyspark.sql import functions as F

from coclick.operators import itemcf
from coclick.sources import testdata as T
from coclick.streaming import daily_cooccurrence_stream
from support import SF_SMALL, rows


def test_incremental_daily_counts_equal_batch(spark, scratch):
    root = tempfile.mkdtemp(prefix="stream-", dir=scratch)
    src, out, ck = (os.path.join(root, x) for x in ("src", "out", "ck"))
    clicks = T.event_clicks(spark, SF_SMALL).select("user", "item", "ts", "day")
    first = clicks.where(F.col("day") < F.lit("2024-01-15").cast("date"))
    rest = clicks.where(F.col("day") >= F.lit("2024-01-14").cast("date"))   # overlaps one day
    first.where(F.col("day") < F.lit("2024-01-14").cast("date")).write.partitionBy("day").parquet(src)
    schema = spark.read.parquet(src).schema
    q = daily_cooccurrence_stream(spark, src, schema, out, ck)
    q.awaitTermination()
    rest.write.mode("append").partitionBy("day").parquet(src)
    q = daily_cooccurrence_stream(spark, src, schema, out, ck)
    q.awaitTermination()
    got = spark.read.parquet(out).withColumn("day", F.col("day").cast("string"))
    want = itemcf.daily_cooccurrence(clicks, day_col="day").withColumn("day", F.col("day").cast("string"))
    assert rows(got, "day", "vi", "vj", "weight") == rows(want, "day", "vi", "vj", "weight")


def test_incremental_daily_edges_equal_batch(spark, scratch):
    from coclick.operators import graph
    from coclick.streaming import daily_edges_stream
    root = tempfile.mkdtemp(prefix="gstream-", dir=scratch)
    src, out, ck = (os.path.join(root, x) for x in ("src", "out", "ck"))
    ev = T.event_clicks(spark, SF_SMALL, event_type=None, strict_ids=False).select("user", "item", "ts", "eid", "day")
    ev.where(F.col("day") < F.lit("2024-01-10").cast("date")).write.partitionBy("day").parquet(src)
    schema = spark.read.parquet(src).schema
    daily_edges_stream(spark, src, schema, out, ck, ["user", "day"], tiebreak="eid").awaitTermination()
    ev.where(F.col("day") >= F.lit("2024-01-10").cast("date")).write.mode("append").partitionBy("day").parquet(src)
    daily_edges_stream(spark, src, schema, out, ck, ["user", "day"], tiebreak="eid").awaitTermination()
    got = spark.read.parquet(out).withColumn("day", F.col("day").cast("string"))
    want = graph.session_edges(ev, ["user", "day"], tiebreak="eid", day_col="day").withColumn("day", F.col("day").cast("string"))
    assert rows(got, "day", "va", "vb", "w") == rows(want, "day", "va", "vb", "w")
