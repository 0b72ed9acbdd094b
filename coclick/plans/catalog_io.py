"""Registered queries that go through the sinks and come back through the sources.

Each writes to a new folder below the shared checkpoint folder, reads the files
again and returns what was read, so a row is green only if the round trip is exact.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coclick.operators import graph, itemcf, rolling, vectors
from coclick.plans import params as P
from coclick.session import shared_folder, stored
from coclick.sinks import files
from coclick.sources import clicks as C
from coclick.sources import testdata as T
from coclick.sources import text as X


def _catalog():
    from coclick.plans import catalog
    return catalog


def whitelist_snapshot(spark, sf):
    """SRC6: the ids that are recommendable in a region on a day, out of a log of regions and days."""
    p = T.table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("itemid"), "p_size")
    days = p.withColumn("date", F.to_date(F.lit(P.DAY))).withColumn("region", F.when(F.col("p_size") % 2 == 0, "ID").otherwise("SG"))
    late = p.where("p_size > 40").withColumn("date", F.date_add(F.to_date(F.lit(P.DAY)), 1)).withColumn("region", F.lit("ID"))
    return C.read_whitelist(days.unionByName(days).unionByName(late), region="ID", day=P.DAY)


def snapshot_roundtrip(spark, sf):
    """SNK1, SNK2, SNK4, SRC10, AG9: three snapshots written with row counts, one purged, the newest read back."""
    base = shared_folder(spark, "snapshots")
    nations = T.table(spark, sf, "nation").select("n_nationkey", "n_name")
    counted = 0
    for i, day in enumerate(("2024-01-28", "2024-01-29", "2024-01-30")):
        rows, seen = files.observed(nations.where(F.col("n_nationkey") >= 5 * (2 - i)), f"rows-{i}")
        files.write_snapshot(rows, base, day, files=2)
        counted += seen.get["rows"]
    gone = files.keep_latest(spark, base, 2)
    left = files.complete_snapshots(spark, base)
    newest = C.latest_snapshot(spark, base)
    facts = [F.lit(counted).cast("long").alias("rows_written"), F.lit(len(left)).cast("long").alias("snapshots_left"),
             F.lit(gone[0].rstrip("/").rsplit("/", 1)[-1]).alias("purged")]
    return spark.read.parquet(newest).select("n_nationkey", "n_name", *facts)


def tsv_roundtrip(spark, sf):
    """SNK3, SNK8, SNK9: training rows as Parquet, converted to TSV once, read back as text columns."""
    base = shared_folder(spark, "training")
    rows = _catalog().graph_training_rows(spark, sf)
    built = [files.if_missing(spark, f"{base}/rows", lambda: rows) for _ in range(2)]
    done = [files.convert_if_absent(spark, f"{base}/rows", f"{base}/tsv") for _ in range(2)]
    if built != [True, False] or done != [True, False]:
        raise ValueError(f"stages ran {built}, {done}")
    schema = "tag bigint, va bigint, vb bigint, va_hop1 string, va_hop2 string, vb_hop1 string, vb_hop2 string"
    return spark.read.option("sep", "\t").schema(schema).csv(f"{base}/tsv")


def user_lists_roundtrip(spark, sf):
    """SNK10, SRC12: user lists as gzip text, read back to (user, rank, item)."""
    path = f"{shared_folder(spark, 'user-lists')}/lines"
    files.write_lines(_catalog().usercf_lines(spark, sf), path, files=3)
    return X.read_user_lists(spark, path).select("user", F.posexplode("items").alias("pos", "item")) \
        .select("user", (F.col("pos") + 1).cast("long").alias("rank"), "item")


def eval_roundtrip(spark, sf):
    """SNK11: (user, score) of the evaluation as gzip TSV, read back."""
    path = f"{shared_folder(spark, 'eval')}/tsv"
    files.write_tsv(_catalog().eval_hit_ratio(spark, sf), path, compression="gzip")
    return spark.read.option("sep", "\t").schema("user bigint, score double").csv(path)


def sentences_roundtrip(spark, sf):
    """SRC11: sentences written as text lines, read back to tokens."""
    path = f"{shared_folder(spark, 'sentences')}/lines"
    s = vectors.session_sentences(T.event_clicks(spark, sf), ["user", "day"], tiebreak="eid")
    files.write_lines(s, path, col="sentence")
    tokens = X.read_sentences(spark, path).select(F.explode("tokens").alias("token"))
    return tokens.groupBy("token").agg(F.count("*").alias("n"))


def vectors_roundtrip(spark, sf):
    """SRC13, SNK12 (vectors as Parquet): the embeddings written and read back by position."""
    path = f"{shared_folder(spark, 'vectors')}/vectors"
    files.write_parquet(T.embeddings(spark, sf).select("id", "vec"), path, files=3)
    v = X.read_vectors(spark, path)
    return v.select("id", F.size("vec").cast("long").alias("dim"), F.round(F.aggregate(
        "vec", F.lit(0.0), lambda a, x: a + x.cast("double")), 4).alias("total"))


def model_roundtrip(spark, sf):
    """SNK12: the Word2Vec model saved, loaded, and its vocabulary."""
    from pyspark.ml.feature import Word2VecModel

    path = f"{shared_folder(spark, 'model')}/word2vec"
    files.save_model(vectors.item2vec_fit(_catalog().ev_sentences(spark, sf), iters=1, partitions=1), path)
    return vectors.model_vectors(Word2VecModel.load(path)).select("id", F.size("vec").cast("bigint").alias("dim"))


def itemcf_scores_clustered(spark, sf):
    """JN1 against item counts that are stored clustered."""
    merged = stored(_catalog().cp_merged(spark, sf), "merged")
    return itemcf.cosine_scores(merged, itemcf.clustered_counts(merged)) \
        .select("va", "vb", "weight", "weight_a", "weight_b", (F.round("score", 6) + F.lit(0.0)).alias("score"))


def graph_hop1_clustered(spark, sf):
    """JN7 against an adjacency that is stored clustered."""
    labels, adj = _catalog().g_shared(spark, sf)
    return graph.hop1_samples(graph.label_contexts(labels), graph.clustered_adjacency(adj), P.HOP1, P.SEED)


#: Horizon and number of days rolled by itemcf_rolling.
ROLL_DAYS, ROLLED = 6, 12


def itemcf_rolling(spark, sf) -> DataFrame:
    """CF2: a seven-day merge rolled forward day by day, the last version read with whitelist and threshold."""
    daily = stored(itemcf.daily_cooccurrence(T.event_clicks(spark, sf), day_col="day"), "daily")
    base = shared_folder(spark, "rolling")
    of = lambda day: daily.where(F.col("day") == F.lit(day).cast("date"))
    last = dt.date.fromisoformat(P.DAY)
    for i in range(ROLLED, -1, -1):
        path = rolling.roll(spark, base, str(last - dt.timedelta(days=i)), ROLL_DAYS, of, ["vi", "vj"], "weight", keep=3)
    return rolling.merged(spark, path, "vi", "vj", "weight", 2, T.part_whitelist(spark, sf, P.WHITELIST_MAX_SIZE)) \
        .select(F.col("vi").alias("va"), F.col("vj").alias("vb"), F.round("weight", 6).alias("weight"))


QUERIES = {f.__name__: f for f in (
    whitelist_snapshot, snapshot_roundtrip, tsv_roundtrip, user_lists_roundtrip, eval_roundtrip, sentences_roundtrip,
    vectors_roundtrip, model_roundtrip, itemcf_scores_clustered, graph_hop1_clustered, itemcf_rolling)}
