"""Session click graph and balanced two-hop neighbour sampling (GR1-GR6).

Neighbour sampling never collects a node's neighbour list.  The adjacency is
stored as rows (va, idx, vb, w) with a dense index per node; a sample is a
list of indices computed from the degree alone (Floyd's algorithm on MD5
draws, :func:`coclick.functions.hashing.balanced_draws`), then an equi-join on
(node, idx).  A hub node with millions of neighbours therefore costs k lookups
per sample, and the join key (node, idx) spreads it over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coclick.functions.hashing import balanced_draws
from coclick.functions.text import array_text, nested_array_text
from coclick.operators.pairs import next_pairs
from coclick.operators.positions import numbered
from coclick.operators.skew import heavy_keys, split_join
from coclick.session import stored
from coclick.sinks.files import write_clustered
from coclick.sources.clicks import day_range_filter

# Fixed values of the reference's graph job.
EDGE_THRE = 3        # adjacency keeps merged edges with w > 3 (strict)
MIN_WEIGHT = 0       # merge keeps w >= 0
HOP1 = 10            # hop-1 draws per label edge copy
HOP2 = 10            # hop-2 draws per hop-1 draw
INDEX_BLOCK = 4096   # neighbour ids per numbered range of a node


def session_edges(clicks: DataFrame, session_cols: list[str], item_col: str = "item", ts_col: str = "ts",
                  tiebreak: str | None = None, day_col: str | None = None,
                  rows_per_task: int | None = None) -> DataFrame:
    """GR1: consecutive clicks of a session (ordered by ts, tiebreak), both
    directions, equal items skipped, weight 1 each, summed per (day,) edge.

    Rows with a null session, item or time are dropped first (FLT1).
    Returns ``[day_col,] va, vb, w``.
    """
    # total order up to identical rows, so a retried task numbers ties the same way
    order = [ts_col] + ([tiebreak] if tiebreak else []) + [item_col]
    keep = list(dict.fromkeys(session_cols + ([day_col] if day_col else []) + [item_col] + order))
    d = clicks.select(*keep).na.drop(subset=list(dict.fromkeys(session_cols + [item_col, ts_col])))
    idx = numbered(d, session_cols, list(dict.fromkeys(order)), rows_per_task=rows_per_task)
    if day_col and day_col not in session_cols:
        raise ValueError("day_col must be one of the session columns")
    pairs = next_pairs(idx, session_cols, item_col).where(F.col("a") != F.col("b"))
    dk = [day_col] if day_col else []
    both = pairs.select(*dk, F.explode(F.array(F.struct(F.col("a").alias("va"), F.col("b").alias("vb")),
                                               F.struct(F.col("b").alias("va"), F.col("a").alias("vb")))).alias("e"))
    return both.groupBy(*dk, F.col("e.va").alias("va"), F.col("e.vb").alias("vb")) \
        .agg(F.sum(F.lit(1.0)).alias("w"))


def merge_edges(daily: DataFrame, *, whitelist: DataFrame | None = None, day_col: str | None = None,
                day=None, n_days: int | None = None, min_weight: float = MIN_WEIGHT) -> DataFrame:
    """GR2: edges of days D-n..D, both ends whitelisted, summed, ``w >= min_weight``."""
    d = daily
    if day_col is not None and day is not None:
        d = d.where(day_range_filter(day_col, day, n_days or 0))
    if whitelist is not None:
        wl = whitelist.select(F.col("item").alias("__w"))
        d = d.join(wl, F.col("va") == F.col("__w"), "left_semi").join(wl, F.col("vb") == F.col("__w"), "left_semi")
    return d.groupBy("va", "vb").agg(F.sum("w").alias("w")).where(F.col("w") >= min_weight)


def adjacency(edges: DataFrame, edge_thre: float = EDGE_THRE, block: int = INDEX_BLOCK) -> DataFrame:
    """GR3: edges with ``w > edge_thre`` as rows (va, idx, vb, w, deg).

    ``idx`` is 0..deg-1 in the order of ``vb``, for nodes of any degree.
    Neighbours are numbered inside ranges of ``block`` ids and shifted by the
    counts of the lower ranges (a window over one row per range), so a hub is
    numbered by many tasks.
    """
    e = edges.where(F.col("w") > edge_thre) \
        .select("va", "vb", "w", F.floor(F.col("vb") / block).cast("bigint").alias("__bk"))
    counts = e.groupBy("va", "__bk").agg(F.count(F.lit(1)).alias("__c"))
    node = Window.partitionBy("va")
    below = node.orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("va", "__bk", F.coalesce(F.sum("__c").over(below), F.lit(0)).alias("__off"),
                         F.sum("__c").over(node).alias("deg"))
    within = Window.partitionBy("va", "__bk").orderBy("vb")
    return e.withColumn("__rn", F.row_number().over(within)).join(offs, ["va", "__bk"]) \
        .select("va", (F.col("__off") + F.col("__rn") - 1).cast("bigint").alias("idx"), "vb", "w",
                F.col("deg").cast("bigint").alias("deg"))


def clustered_adjacency(adj: DataFrame, buckets: int | None = None) -> DataFrame:
    """GR3 stored for sampling: rows clustered by (va, idx), so the draws of JN7 and JN8 come to the
    neighbours and the adjacency is not shuffled, however often it is sampled."""
    return write_clustered(adj, ["va", "idx"], "adjacency", buckets)


TAG_CHUNK = 4096     # tags generated per row at a time


def _tasks(df: DataFrame) -> int:
    """The session's number of partitions: adaptive execution goes by the bytes that a task reads, not by the rows it makes."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def label_contexts(labels: DataFrame, centre: str = "va", other: str = "vb", weight: str = "w",
                   chunk: int = TAG_CHUNK) -> DataFrame:
    """GR5 / F8: each label edge repeated int(w) times, tag = 0..int(w)-1.

    Tags are generated in two steps: an edge first becomes ceil(n / chunk)
    chunk rows, which a hash repartition on (edge, chunk) spreads over tasks,
    then each chunk expands to at most ``chunk`` tags.  No edge builds one
    giant array in one task, and every edge takes the same way.
    """
    n = F.floor(F.col(weight)).cast("bigint")
    e = labels.select(F.col(centre).cast("bigint").alias("va"), F.col(other).cast("bigint").alias("vb"),
                      n.alias("__n")).where(F.col("__n") >= 1)
    chunks = e.select("va", "vb", "__n", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                               F.floor((F.col("__n") - 1) / chunk).cast("bigint")))
                      .alias("__c")).repartition(_tasks(labels), "va", "vb", "__c")
    lo = F.col("__c") * chunk
    hi = F.least(lo + chunk, F.col("__n")) - 1
    return chunks.select(F.explode(F.sequence(lo, hi)).alias("tag"), "va", "vb")


def hop1_samples(ctx: DataFrame, adj: DataFrame, k: int = HOP1, seed: str = "coclick",
                 carry: list[str] | None = None, rows_per_piece: int | None = None) -> DataFrame:
    """GR4 at hop 1: for every (tag, va, vb), exactly k neighbours of va.

    Contexts whose centre has no neighbour are dropped (inner join).  ``carry``
    columns ride along as extra keys.  Returns ([carry,] tag, va, vb, pos, hop1).
    """
    carry = carry or []
    deg = adj.where(F.col("idx") == 0).select("va", "deg")
    # centres of very many contexts are split by their measured size in both joins (JN7)
    heavy = heavy_keys(ctx, ["va"], rows_per_piece)
    c = split_join(ctx, deg, ["va"], split_right=False, heavy_left=heavy)
    draws = c.select(*carry, "tag", "va", "vb", F.posexplode(
        balanced_draws("deg", k, seed, F.lit("h1"), "tag", "va", "vb")).alias("pos", "idx"))
    nb = adj.select(F.col("va"), "idx", F.col("vb").alias("hop1"))
    return split_join(draws, nb, ["va", "idx"], split_right=False, heavy_left=heavy, by=["va"]).select(*carry, "tag", "va", "vb", F.col("pos").cast("bigint").alias("pos"),
                                                "hop1")


def hop2_samples(h1: DataFrame, adj: DataFrame, k: int = HOP2, seed: str = "coclick",
                 carry: list[str] | None = None, rows_per_piece: int | None = None) -> DataFrame:
    """GR4 at hop 2: for each hop-1 draw, k neighbours of the hop-1 node other
    than the centre (empty when it has none).  Each draw position samples
    independently.  Hop-1 nodes without any neighbour are dropped, as the
    reference's inner join does.

    Returns ([carry,] tag, va, vb, pos, hop1, n2) joined with rows (pos2, hop2);
    rows with n2 = 0 carry null pos2/hop2.
    """
    carry = carry or []
    deg = adj.where(F.col("idx") == 0).select(F.col("va").alias("hop1"), F.col("deg").alias("deg1"))
    centre_idx = adj.select(F.col("va").alias("hop1"), F.col("vb").alias("va"), F.col("idx").alias("cidx"))
    # written once: measured for nodes that are drawn very often, which are split in all three joins (JN8), and read
    # by many tasks, as every row becomes k draws
    h1 = stored(h1.repartition(_tasks(h1), *carry, "tag", "va", "vb"), "hop1")
    heavy = heavy_keys(h1, ["hop1"], rows_per_piece)
    c = split_join(split_join(h1, deg, ["hop1"], split_right=False, heavy_left=heavy), centre_idx, ["hop1", "va"], "left",
                   heavy_left=heavy, by=["hop1"])
    c = c.withColumn("n2", F.col("deg1") - F.when(F.col("cidx").isNotNull(), 1).otherwise(0))
    draws = c.select(*carry, "tag", "va", "vb", "pos", "hop1", "n2", "cidx", F.posexplode_outer(
        balanced_draws("n2", k, seed, F.lit("h2"), "tag", "va", "vb", "pos")).alias("pos2", "j"))
    draws = draws.withColumn("idx", F.col("j") + F.when(F.col("cidx").isNotNull() & (F.col("j") >= F.col("cidx")), 1)
                             .otherwise(0))
    nb = adj.select(F.col("va").alias("hop1"), "idx", F.col("vb").alias("hop2"))
    return split_join(draws, nb, ["hop1", "idx"], "left", heavy_left=heavy, by=["hop1"]).select(
        *carry, "tag", "va", "vb", "pos", "hop1", "n2", F.col("pos2").cast("bigint").alias("pos2"), "hop2")


def _assemble(h2: DataFrame, carry: list[str]) -> DataFrame:
    """Per sample: hop1s in draw order and the aligned hop2 lists (bounded by k1, k1 x k2)."""
    keys = [*carry, "tag", "va", "vb"]
    per_hop1 = h2.groupBy(*keys, "pos", "hop1").agg(
        F.array_sort(F.collect_list(F.when(F.col("hop2").isNotNull(), F.struct("pos2", "hop2")))).alias("__l"))
    per_hop1 = per_hop1.select(*keys, "pos", "hop1", F.transform("__l", lambda x: x["hop2"]).alias("hop2s"))
    rows = per_hop1.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", "hop1", "hop2s"))).alias("__s"))
    return rows.select(*keys, F.transform("__s", lambda x: x["hop1"]).alias("hop1s"),
                       F.transform("__s", lambda x: x["hop2s"]).alias("hop2s"))


def two_hop_samples(labels: DataFrame, adj: DataFrame, *, centre: str = "va", other: str = "vb",
                    weight: str = "w", k1: int = HOP1, k2: int = HOP2, seed: str = "coclick") -> DataFrame:
    """GR5: (tag, va, vb, hop1s array<bigint>, hop2s array<array<bigint>>), ``va`` = centre.

    Lists are bounded (k1, k1 x k2), so collecting them per sample is safe.
    """
    h1 = hop1_samples(label_contexts(labels, centre, other, weight), adj, k1, seed)
    return _assemble(hop2_samples(h1, adj, k2, seed), [])


def training_rows(labels: DataFrame, adj: DataFrame, *, va: str = "va", vb: str = "vb", weight: str = "w",
                  k1: int = HOP1, k2: int = HOP2, seed: str = "coclick", as_text: bool = True) -> DataFrame:
    """GR6: va-side and vb-side samples joined on (tag, va, vb) (JN9).

    Both sides are sampled in one pass: their contexts are unioned with a
    ``side`` key (draws depend only on (tag, centre, other), so they equal
    two separate passes), which halves the joins against the adjacency.
    Columns tag, va, vb, va_hop1, va_hop2, vb_hop1, vb_hop2; with ``as_text``
    the lists are rendered ``[1,2]`` / ``[[1],[2,3]]`` (SC10) for the TSV sink.
    """
    ctx = label_contexts(labels, va, vb, weight).select("tag", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("va"), F.col("vb")),
        F.struct(F.lit(1).alias("side"), F.col("vb").alias("va"), F.col("va").alias("vb")))).alias("e")) \
        .select("tag", "e.side", "e.va", "e.vb")
    h1 = hop1_samples(ctx, adj, k1, seed, carry=["side"])
    both = _assemble(hop2_samples(h1, adj, k2, seed, carry=["side"]), ["side"])
    a = both.where(F.col("side") == 0).select("tag", "va", "vb", F.col("hop1s").alias("va_hop1"),
                                              F.col("hop2s").alias("va_hop2"))
    b = both.where(F.col("side") == 1).select("tag", F.col("va").alias("vb"), F.col("vb").alias("va"),
                                              F.col("hop1s").alias("vb_hop1"), F.col("hop2s").alias("vb_hop2"))
    j = a.join(b, ["tag", "va", "vb"])
    if not as_text:
        return j
    return j.select("tag", "va", "vb", array_text("va_hop1").alias("va_hop1"),
                    nested_array_text("va_hop2").alias("va_hop2"), array_text("vb_hop1").alias("vb_hop1"),
                    nested_array_text("vb_hop2").alias("vb_hop2"))
