import os
import tempfile

from pyspark.sql import functions as F

from coclick.operators import graph, itemcf
from coclick.plans import jobs
from coclick.sources import testdata as T
from support import SF_SMALL, rows

DAYS = ["2024-01-0%d" % d for d in range(1, 6)]


def test_itemcf_jobs_equal_in_memory_plan(spark, scratch):
    base = tempfile.mkdtemp(prefix="jobs-", dir=scratch)
    clicks = T.event_clicks(spark, SF_SMALL)
    wl = T.part_whitelist(spark, SF_SMALL)
    for d in DAYS:
        jobs.itemcf_gen_day(spark, clicks.where(F.col("day") == F.lit(d).cast("date")), base, "ID", d)
    jobs.itemcf_merge(spark, base, "ID", DAYS[-1], 3, wl)          # days 2..5
    out = jobs.itemcf_join_group(spark, base, "ID", 3)
    assert os.path.exists(os.path.join(out, "_SUCCESS"))
    daily = itemcf.daily_cooccurrence(clicks, day_col="day")
    want = itemcf.neighbour_text(itemcf.neighbour_lists(itemcf.cosine_scores(
        itemcf.merge_counts(daily, whitelist=wl, day_col="day", day=DAYS[-1], n_days=3))))
    assert sorted(r.value for r in spark.read.text(out).collect()) == sorted(r.line for r in want.collect())


def test_graph_jobs_write_training_rows(spark, scratch):
    base = tempfile.mkdtemp(prefix="gjobs-", dir=scratch)
    ev = T.event_clicks(spark, SF_SMALL, event_type=None, strict_ids=False)
    for d in DAYS:
        jobs.graph_gen_day(spark, ev.where(F.col("day") == F.lit(d).cast("date")), base, "ID", d, ["user", "day"], "eid")
    jobs.graph_merge(spark, base, "ID", DAYS[-1], 4, None)
    out = jobs.graph_train_rows(spark, base, "ID", DAYS[-1], os.path.join(base, "csv"), edge_thre=0, k1=3, k2=2,
                                merge_days=4)
    t = spark.read.option("sep", "\t").csv(out)
    assert len(t.columns) == 7
    merged = graph.merge_edges(graph.session_edges(ev, ["user", "day"], tiebreak="eid", day_col="day"),
                               day_col="day", day=DAYS[-1], n_days=4)
    labels = graph.session_edges(ev.where(F.col("day") == F.lit(DAYS[-1]).cast("date")), ["user", "day"], tiebreak="eid")
    want = graph.training_rows(labels, graph.adjacency(merged, 0), k1=3, k2=2)
    assert sorted(tuple(r) for r in t.collect()) == sorted(tuple(str(x) for x in r) for r in want.collect())


def test_swing_jobs_equal_in_memory_plan(spark, scratch):
    from coclick.operators import swing
    base = tempfile.mkdtemp(prefix="sjobs-", dir=scratch)
    clicks = T.event_clicks(spark, SF_SMALL, strict_ids=False)
    wl = T.part_whitelist(spark, SF_SMALL)
    for d in DAYS:
        out = jobs.swing_gen_day(spark, clicks.where(F.col("day") == F.lit(d).cast("date")), base, "ID", d)
        assert jobs.swing_gen_day(spark, clicks.limit(0), base, "ID", d) == out      # complete days are skipped
    jobs.swing_merge(spark, base, "ID", DAYS[-1], 4, wl)
    path = jobs.swing_join(spark, base, "ID", wl, T.part_shops(spark, SF_SMALL))
    prof = jobs.swing_group(spark, base, "ID", T.part_features(spark, SF_SMALL)).collect()
    ui = swing.user_item(clicks.select("day", "user", "item"), day_col="day")
    want = swing.swing_from_clicks(ui, whitelist=wl, day_col="day")
    assert rows(spark.read.parquet(path), "itemi", "itemj") == rows(want, "itemi", "itemj")
    assert {r.list for r in prof} == {"final_data", "final_data_ctr_cr"}


def test_usercf_jobs(spark, scratch):
    base = tempfile.mkdtemp(prefix="ujobs-", dir=scratch)
    clicks = T.event_clicks(spark, SF_SMALL)
    out = jobs.usercf_lists(spark, clicks.where(F.col("day") < F.lit("2024-01-30").cast("date")), base, "ID")
    lines = [r.value for r in spark.read.text(out).collect()]
    assert lines and all("\t" in ln for ln in lines)
    ev = jobs.usercf_eval(spark, clicks.where(F.col("day") == F.lit("2024-01-30").cast("date")), base, "ID")
    vals = [float(r.value.split("\t")[1]) for r in spark.read.text(ev).collect()]
    assert all(0.0 <= v <= 1.0 for v in vals)


def test_merge_needs_every_day_and_keeps_horizons_apart(spark, scratch):
    import pytest
    base = tempfile.mkdtemp(prefix="hjobs-", dir=scratch)
    clicks = T.event_clicks(spark, SF_SMALL)
    for d in DAYS[:3]:
        jobs.itemcf_gen_day(spark, clicks.where(F.col("day") == F.lit(d).cast("date")), base, "ID", d)
    with pytest.raises(FileNotFoundError, match=DAYS[3]):
        jobs.itemcf_merge(spark, base, "ID", DAYS[4], 4, None)
    os.remove(os.path.join(base, "ID", "day_data", f"day={DAYS[0]}", "_SUCCESS"))
    with pytest.raises(FileNotFoundError, match=DAYS[0]):
        jobs.itemcf_merge(spark, base, "ID", DAYS[2], 2, None)
    assert "merge_data_2/" in jobs.itemcf_merge(spark, base, "ID", DAYS[2], 2, None, strict=False)
    assert "merge_data_1/" in jobs.itemcf_merge(spark, base, "ID", DAYS[2], 1, None)
    with pytest.raises(FileNotFoundError):
        jobs.itemcf_join_group(spark, base, "ID")
