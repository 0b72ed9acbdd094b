"""Persisted jobs: the reference's actions as Spark applications.

Layout under ``base/<region>/``:

* ``<dataset>/day=YYYY-MM-DD``  daily outputs, one complete directory per day,
  read back as one table whose ``day`` partition column prunes the range scan;
* ``<dataset>/<epoch>``          versioned merge snapshots (newest complete wins);
* plain directories for joined scores and final lists.

Each job reads its inputs, runs the operator plan and writes; stages hand over
through storage, so a lost executor only re-runs the current stage.
"""

from __future__ import annotations

import datetime as dt
import logging
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coclick import sinks
from coclick.operators import graph, itemcf, swing, usercf, vectors
from coclick.sources.clicks import day_range_filter, latest_snapshot

log = logging.getLogger("coclick.jobs")

# Retention of the reference's jobs (fixed values).
KEEP = {"cf_day": 62, "cf_merge": 10, "swing_day": 200, "swing_merge": 3, "graph_day": 1000, "graph_merge": 10}


def _p(base: str, region: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), region, *parts])


def _counted(df: DataFrame, path: str, write=sinks.write_parquet) -> str:
    """Write with a row-count metric gathered by the write itself (AG9)."""
    df, obs = sinks.observed(df)
    write(df, path)
    log.info("%s: %s rows", path, obs.get.get("rows"))
    return path


def _write_day(df: DataFrame, base: str, region: str, dataset: str, day: str, keep: int) -> str:
    path = _p(base, region, dataset, f"day={day}")
    _counted(df.drop("day") if "day" in df.columns else df, path)
    sinks.keep_latest(df.sparkSession, _p(base, region, dataset), keep)
    return path


def _read_days(spark: SparkSession, base: str, region: str, dataset: str, day: str, n_days: int,
               strict: bool = True) -> DataFrame:
    """Days D-n..D of a daily dataset; ``strict`` raises if one is missing or unfinished."""
    if strict:
        last = dt.date.fromisoformat(day)
        days = [str(last - dt.timedelta(days=i)) for i in range(n_days, -1, -1)]
        lost = [d for d in days if not sinks.is_complete(spark, _p(base, region, dataset, f"day={d}"))]
        if lost:
            raise FileNotFoundError(f"{_p(base, region, dataset)}: missing or unfinished days {', '.join(lost)}")
    return spark.read.option("basePath", _p(base, region, dataset)).parquet(_p(base, region, dataset)) \
        .where(day_range_filter("day", day, n_days))


# The horizon whose snapshots have the plain dataset names (fixed value).
MAIN_HORIZON = 30


def _for_horizon(dataset: str, merge_days: int) -> str:
    """Each merge horizon has its own datasets, so a 7-day merge is never read as the main one."""
    return dataset if merge_days == MAIN_HORIZON else f"{dataset}_{merge_days}"


def _latest(spark: SparkSession, base: str) -> DataFrame:
    path = latest_snapshot(spark, base)
    if path is None:
        raise FileNotFoundError(f"no complete snapshot under {base}")
    return spark.read.parquet(path)


# ------------------------------------------------------------- item-CF ---
def itemcf_gen_day(spark: SparkSession, clicks: DataFrame, base: str, region: str, day: str) -> str:
    """gen_data: one day's clicks (user, item, ts) -> daily counts."""
    return _write_day(itemcf.daily_cooccurrence(clicks), base, region, "day_data", day, KEEP["cf_day"])


def itemcf_merge(spark: SparkSession, base: str, region: str, day: str, merge_days: int,
                 whitelist: DataFrame | None, strict: bool = True) -> str:
    """merge_data: days D-n..D -> whitelisted, thresholded snapshot of this horizon."""
    daily = _read_days(spark, base, region, "day_data", day, merge_days, strict)
    merged = itemcf.merge_counts(daily, whitelist=whitelist)
    into = _p(base, region, _for_horizon("merge_data", merge_days))
    snap = _counted(merged, f"{into}/{int(time.time())}")
    sinks.keep_latest(spark, into, KEEP["cf_merge"])
    return snap


def itemcf_join_group(spark: SparkSession, base: str, region: str, merge_days: int = MAIN_HORIZON) -> str:
    """join + group: the horizon's latest snapshot -> scores -> lists (Parquet rows + gzip text)."""
    at = lambda dataset: _p(base, region, _for_horizon(dataset, merge_days))
    scores = itemcf.cosine_scores(_latest(spark, at("merge_data")))
    sinks.write_parquet(scores, at("join_cnt"))
    lists = itemcf.neighbour_lists(spark.read.parquet(at("join_cnt")))
    sinks.write_parquet(lists, at("group_data"))
    text = itemcf.neighbour_text(spark.read.parquet(at("group_data")))
    return sinks.write_lines(text, at("final_data"))


# --------------------------------------------------------------- Swing ---
def swing_gen_day(spark: SparkSession, clicks: DataFrame, base: str, region: str, day: str) -> list[str]:
    """gen_data: user_item, item-pair users and user-pair counts of one day (skipped when complete)."""
    ui_path = _p(base, region, "user_item_day_data", f"day={day}")
    sinks.if_missing(spark, ui_path, lambda: swing.user_item(clicks))
    ui = spark.read.parquet(ui_path)
    out = [ui_path]
    for dataset, build in (("i2i2u_day_data", lambda: swing.item_pair_users(ui)),
                           ("u2u_day_data", lambda: swing.user_pair_counts(ui))):
        path = _p(base, region, dataset, f"day={day}")
        sinks.if_missing(spark, path, build)
        sinks.keep_latest(spark, _p(base, region, dataset), KEEP["swing_day"])
        out.append(path)
    return out


def swing_merge(spark: SparkSession, base: str, region: str, day: str, merge_days: int,
                whitelist: DataFrame | None = None, strict: bool = True) -> list[str]:
    """merge_u2u / merge_u_weight / merge_i2i2u2u over days D-n..D."""
    ui = _read_days(spark, base, region, "user_item_day_data", day, merge_days, strict)
    u2u = _read_days(spark, base, region, "u2u_day_data", day, merge_days, strict) \
        .groupBy("ui", "uj").agg(F.sum("weight").alias("weight"))
    ipu = _read_days(spark, base, region, "i2i2u_day_data", day, merge_days, strict)
    out = []
    for dataset, df in (("merge_u2u_data", u2u), ("merge_u_weight_data", swing.user_weights(ui)),
                        ("merge_i2i2u2u_data", swing.item_pair_user_pairs(ipu, whitelist))):
        path = _p(base, region, dataset, day)
        sinks.if_missing(spark, path, lambda df=df: df)
        sinks.keep_latest(spark, _p(base, region, dataset), KEEP["swing_merge"])
        out.append(path)
    return out


def swing_join(spark: SparkSession, base: str, region: str, whitelist: DataFrame | None,
               shops: DataFrame | None = None) -> str:
    """join_result: scores (both directions) and the shop case report."""
    paths = _latest(spark, _p(base, region, "merge_i2i2u2u_data"))
    u2u = _latest(spark, _p(base, region, "merge_u2u_data"))
    uw = _latest(spark, _p(base, region, "merge_u_weight_data"))
    path = _counted(swing.swing_scores(paths, u2u, uw, whitelist), _p(base, region, "join_data"))
    if shops is not None:
        sinks.write_lines(swing.case_report(spark.read.parquet(path), shops), _p(base, region, "case_data"))
    return path


def swing_group(spark: SparkSession, base: str, region: str, features: DataFrame | None = None) -> DataFrame:
    """group_result: final lists (+ reweighted lists); returns the length profiles."""
    scores = spark.read.parquet(_p(base, region, "join_data"))
    sinks.write_lines(swing.swing_text(swing.swing_lists(scores)), _p(base, region, "final_data"))
    prof = [swing.length_profile(spark.read.text(_p(base, region, "final_data")), "value")
            .withColumn("list", F.lit("final_data"))]
    if features is not None:
        rw = swing.reweighted_scores(scores, features, region)
        sinks.write_lines(swing.swing_text(swing.swing_lists(rw)), _p(base, region, "final_data_ctr_cr"))
        prof.append(swing.length_profile(spark.read.text(_p(base, region, "final_data_ctr_cr")), "value")
                    .withColumn("list", F.lit("final_data_ctr_cr")))
    out = prof[0]
    for p in prof[1:]:
        out = out.unionByName(p)
    return out


# --------------------------------------------------------------- graph ---
def graph_gen_day(spark: SparkSession, clicks: DataFrame, base: str, region: str, day: str,
                  session_cols: list[str], tiebreak: str | None = None) -> str:
    """gen_data: session edges of one day."""
    return _write_day(graph.session_edges(clicks, session_cols, tiebreak=tiebreak), base, region, "day_data", day,
                      KEEP["graph_day"])


def graph_merge(spark: SparkSession, base: str, region: str, day: str, merge_days: int,
                whitelist: DataFrame | None, min_weight: float = graph.MIN_WEIGHT, strict: bool = True) -> str:
    daily = _read_days(spark, base, region, "day_data", day, merge_days, strict)
    into = _p(base, region, _for_horizon("merge_data", merge_days))
    snap = sinks.write_snapshot(graph.merge_edges(daily, whitelist=whitelist, min_weight=min_weight), into,
                                str(int(time.time())))
    sinks.keep_latest(spark, into, KEEP["graph_merge"])
    return snap


def graph_train_rows(spark: SparkSession, base: str, region: str, day: str, csv_path: str,
                     edge_thre: float = graph.EDGE_THRE, k1: int = graph.HOP1, k2: int = graph.HOP2,
                     seed: str = "coclick", merge_days: int = MAIN_HORIZON) -> str:
    """gen_va_hop + gen_vb_hop + gen_train_data: TSV training rows for one day's label edges."""
    adj_path = _p(base, region, _for_horizon("adjacency", merge_days), day)
    merged = _latest(spark, _p(base, region, _for_horizon("merge_data", merge_days)))
    sinks.write_parquet(graph.adjacency(merged, edge_thre), adj_path)
    adj = spark.read.parquet(adj_path)
    labels = spark.read.parquet(_p(base, region, "day_data", f"day={day}"))
    rows = graph.training_rows(labels, adj, k1=k1, k2=k2, seed=seed)
    return sinks.write_tsv(rows, f"{csv_path.rstrip('/')}/{region}/{day}")


# ---------------------------------------------------- user-CF / vectors ---
def usercf_lists(spark: SparkSession, clicks: DataFrame, base: str, region: str,
                 whitelist: DataFrame | None = None) -> str:
    hist = usercf.user_histories(clicks, whitelist)
    sinks.write_parquet(hist, _p(base, region, "user_history"))
    hist = spark.read.parquet(_p(base, region, "user_history"))
    recs = usercf.recommend_from_histories(hist)
    sinks.write_parquet(recs, _p(base, region, "recommended_rows"))
    return sinks.write_lines(usercf.recommend_text(spark.read.parquet(_p(base, region, "recommended_rows"))),
                             _p(base, region, "recommended_list_test"))


def usercf_eval(spark: SparkSession, labels: DataFrame, base: str, region: str) -> str:
    preds = spark.read.parquet(_p(base, region, "recommended_rows"))
    return sinks.write_tsv(usercf.hit_ratio(labels, preds), _p(base, region, "eval_result"), compression="gzip")


def item2vec_train(spark: SparkSession, sentences: DataFrame, out: str, **kw) -> str:
    model = vectors.item2vec_fit(sentences, **kw)
    sinks.save_model(model, out + "/model")
    sinks.write_parquet(vectors.model_vectors(model), out + "/vectors")
    return out
