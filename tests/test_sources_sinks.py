import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from coclick import sinks
from coclick.sources import clicks as C
from support import rows


def test_f9_local_day_partitions(spark):
    hours = [(d, h) for d in ("2024-01-09", "2024-01-10", "2024-01-11") for h in range(24)]
    df = spark.createDataFrame(hours, "utc_date string, hour int").withColumn("utc_date", F.to_date("utc_date"))
    got = rows(df.where(C.local_day_filter("utc_date", "hour", "2024-01-10", 7)))
    want = [(dt.date(2024, 1, 9), h) for h in range(17, 24)] + [(dt.date(2024, 1, 10), h) for h in range(0, 17)]
    assert got == sorted(want)
    # negative offset: UTC-5 -> D 05:00 .. D+1 04:59
    got = rows(df.where(C.local_day_filter("utc_date", "hour", "2024-01-10", -5)))
    assert got == sorted([(dt.date(2024, 1, 10), h) for h in range(5, 24)] + [(dt.date(2024, 1, 11), h) for h in range(5)])


def test_read_clicks_filters(spark):
    data = [(1, "s", 1, "click", "item", "home", ["daily_discover"], '{"itemid":5}', "ID"),
            (2, "s", 2, "view", "item", "home", ["daily_discover"], '{"itemid":6}', "ID"),
            (3, "s", 3, "click", "item", "home", ["other"], '{"itemid":7}', "ID"),
            (0, "s", 4, "click", "item", "home", ["daily_discover"], '{"itemid":8}', "ID"),
            (5, "s", 5, "click", "item", "home", ["daily_discover"], '{"itemid":"x"}', "ID"),
            (6, "s", 6, "click", "item", "home", ["daily_discover"], '{"itemid":9}', "BR")]
    log = spark.createDataFrame(data, "userid bigint, session_id string, event_timestamp bigint, operation string, "
                                      "target_type string, page_type string, page_section array<string>, data string, "
                                      "region string")
    out = C.read_clicks(log, region="ID", placement=("home", "daily_discover"))
    assert rows(out, "user", "item") == [(1, 5)]


def test_latest_partition(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "c"), (5, "c")], "x int, dt string")
    assert rows(C.latest_partition(df, "dt"), "x") == [(4,), (5,)]
    g = spark.createDataFrame([(1, "a", "g1"), (2, "b", "g1"), (3, "a", "g2")], "x int, dt string, g string")
    assert rows(C.latest_partition(g, "dt", ["g"]), "x") == [(2,), (3,)]


def test_f20_retention_and_markers(spark, scratch):
    base = tempfile.mkdtemp(prefix="snap-", dir=scratch)
    df = spark.range(3)
    for i in range(12):
        sinks.write_snapshot(df, base, f"2024-01-{i + 1:02d}")
    os.makedirs(os.path.join(base, "2024-02-01"))          # no _SUCCESS: never listed
    assert C.latest_snapshot(spark, base).endswith("2024-01-12")
    removed = sinks.keep_latest(spark, base, 10)
    assert sorted(p.rsplit("/", 1)[-1] for p in removed) == ["2024-01-01", "2024-01-02"]
    assert sorted(os.listdir(base))[0] == "2024-01-03" and "2024-02-01" in os.listdir(base)


def test_if_missing_and_text(spark, scratch):
    out = os.path.join(tempfile.mkdtemp(prefix="sink-", dir=scratch), "t")
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([("1\t2:0.5",)], "line string")

    assert sinks.if_missing(spark, out, build, sinks.write_lines) is True
    assert sinks.if_missing(spark, out, build, sinks.write_lines) is False
    assert len(calls) == 1
    assert [r.value for r in spark.read.text(out).collect()] == ["1\t2:0.5"]
    tsv = os.path.join(os.path.dirname(out), "tsv")
    sinks.write_tsv(spark.createDataFrame([(1, "[1,2]")], "a int, b string"), tsv)
    assert [r.value for r in spark.read.text(tsv).collect()] == ["1\t[1,2]"]


def test_text_and_vector_readers_round_trip(spark, scratch):
    from coclick.operators import usercf
    from coclick.sources import read_sentences, read_user_lists, read_vectors
    root = tempfile.mkdtemp(prefix="readers-", dir=scratch)
    s_path, u_path, v_path = (os.path.join(root, x) for x in ("sent", "lists", "vec"))
    sinks.write_lines(spark.createDataFrame([("1 2 3",), ("4 5",)], "line string"), s_path)
    assert sorted(r.tokens for r in read_sentences(spark, s_path).collect()) == [["1", "2", "3"], ["4", "5"]]
    sinks.write_lines(spark.createDataFrame([("7\t2,4,9",), ("8\t1",)], "line string"), u_path)
    lists = read_user_lists(spark, u_path)
    assert rows(lists, "user", "items") == [(7, [2, 4, 9]), (8, [1])]
    preds = lists.select("user", F.explode("items").alias("item"))
    labels = spark.createDataFrame([(7, 1), (7, 2), (7, 3), (7, 4)], "user bigint, item bigint")
    assert rows(usercf.hit_ratio(labels, preds), "user", "score") == [(7, 0.5)]          # F14 via text lists
    spark.createDataFrame([(3, [0.5, 1.5])], "k bigint, v array<double>").write.parquet(v_path)
    assert [(r.id, r.vec) for r in read_vectors(spark, v_path).collect()] == [(3, [0.5, 1.5])]


def test_convert_if_absent(spark, scratch):
    root = tempfile.mkdtemp(prefix="conv-", dir=scratch)
    pq, tsv = os.path.join(root, "rows"), os.path.join(root, "tsv")
    sinks.write_parquet(spark.createDataFrame([(1, "[1,2]")], "a int, b string"), pq)
    assert sinks.convert_if_absent(spark, pq, tsv) is True
    assert sinks.convert_if_absent(spark, pq, tsv) is False
    assert [r.value for r in spark.read.text(tsv).collect()] == ["1\t[1,2]"]


def test_reference_click_log_schema_end_to_end(spark):
    """A click log in the reference's layout (JSON payload, epoch-second bigint
    timestamps, utc_date/hour partitions, placement fields) through read_clicks
    and item-CF equals the direct path over the same local day."""
    from coclick.operators import itemcf
    from coclick.sources import testdata as T
    from support import SF_SMALL
    ev = T.table(spark, SF_SMALL, "events")
    log = ev.select(
        F.col("user_id").alias("userid"), F.concat_ws("-", "user_id", F.to_date("ts").cast("string")).alias("session_id"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("event_timestamp"), F.col("event_type").alias("operation"),
        F.lit("item").alias("target_type"), F.lit("home").alias("page_type"),
        F.array(F.lit("daily_discover")).alias("page_section"),
        F.regexp_replace("props", '"k"', '"itemid"').alias("data"), F.lit("ID").alias("region"),
        F.to_date("ts").alias("utc_date"), F.hour("ts").alias("hour"))
    clicks = C.read_clicks(log, region="ID", day="2024-01-20", tz_hours=7, placement=("home", "daily_discover"))
    got = itemcf.daily_cooccurrence(clicks)
    direct = T.event_clicks(spark, SF_SMALL).where(C.local_day_ts_filter("ts", "2024-01-20", 7))
    want = itemcf.daily_cooccurrence(direct)
    assert clicks.count() == direct.count() > 0
    assert rows(got) == rows(want)
