"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame that
reads the test tables in full.  Names match ``coclick.plans.oracle.sql()``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coclick.operators import gnn, graph, itemcf, lookup, metric_knn, neighbour_graph, rerank, selection, simjoin, skipgram, swing, topk, usercf, vectors
from coclick.sources import clicks as C
from coclick.plans import catalog_io
from coclick.plans import params as P
from coclick.session import stored
from coclick.sources import testdata as T

Query = Callable[[SparkSession, str], DataFrame]


def _r(c: str, name: str | None = None):
    # rounded to 6 places; "+ 0.0" turns a rounded -0.0 into 0.0
    return (F.round(F.col(c), 6) + F.lit(0.0)).alias(name or c)


# ------------------------------------------------------------- item-CF ---
def cp_daily(spark, sf):
    return itemcf.daily_cooccurrence(T.copurchase(spark, sf))


def cp_merged(spark, sf):
    # only recommendable clicks are paired
    wl = T.part_whitelist(spark, sf, P.WHITELIST_MAX_SIZE)
    return itemcf.merge_counts(itemcf.daily_cooccurrence(T.copurchase(spark, sf), whitelist=wl))


def cp_scores(spark, sf):
    return itemcf.cosine_scores(cp_merged(spark, sf))


def cp_lists(spark, sf):
    return itemcf.neighbour_lists(cp_scores(spark, sf))


def itemcf_daily(spark, sf):
    return cp_daily(spark, sf).select("vi", "vj", _r("weight"))


def itemcf_capped(spark, sf):
    """CF1 where the caps bind: 20 clicks a user, a window of 3."""
    d = itemcf.daily_cooccurrence(T.copurchase(spark, sf), max_user_items=20, window_size=3, rows_per_task=200)
    return d.select("vi", "vj", _r("weight"))


def itemcf_short_lists(spark, sf):
    """CF4 where the list rules bind: 10 neighbours, 5 kept whatever the score, floor 0.2, clamp 0.3."""
    lists = itemcf.neighbour_lists(cp_scores(spark, sf), k1=1000, k2=10, min_keep=5, floor=0.2, clamp_at=0.3)
    return lists.select("item", "rank", "nbr", _r("score"))


def cp_vectors(spark, sf):
    return simjoin.click_vectors(T.copurchase(spark, sf), T.part_whitelist(spark, sf, P.WHITELIST_MAX_SIZE))


def itemcf_bounded_lists(spark, sf):
    """CF4 without the pairs under the floor: the rows of itemcf_short_lists."""
    lists = simjoin.bounded_lists(cp_vectors(spark, sf), k1=1000, k2=10, min_keep=5, floor=0.2, clamp_at=0.3)
    return lists.select("item", "rank", "nbr", _r("score"))


def itemcf_pairs_over(spark, sf):
    """CF3 for the pairs with a score over 0.15, from candidates that can reach it."""
    return simjoin.similar_pairs(cp_vectors(spark, sf), 0.15).select("va", "vb", "weight", "weight_a", "weight_b", _r("score"))


def itemcf_merged(spark, sf):
    daily = itemcf.daily_cooccurrence(T.event_clicks(spark, sf), day_col="day")
    return itemcf.merge_counts(daily, whitelist=T.part_whitelist(spark, sf, P.WHITELIST_MAX_SIZE),
                               day_col="day", day=P.DAY, n_days=P.MERGE_DAYS, min_weight=P.EVENTS_MIN_WEIGHT) \
        .select("va", "vb", _r("weight"))


def itemcf_scores(spark, sf):
    return cp_scores(spark, sf).select("va", "vb", "weight", "weight_a", "weight_b", _r("score"))


def itemcf_topk(spark, sf):
    return cp_lists(spark, sf).select("item", "rank", "nbr", _r("score"))


def itemcf_lines(spark, sf):
    lists = cp_lists(spark, sf).withColumn("score", F.round("score", 6))
    return itemcf.neighbour_text(lists, fmt="%d:%.6f")


# --------------------------------------------------------------- Swing ---
def cp_ui(spark, sf):
    return swing.user_item(T.copurchase(spark, sf))


def cp_swing(spark, sf):
    return swing.swing_from_clicks(cp_ui(spark, sf),
                                   whitelist=T.part_whitelist(spark, sf, P.WHITELIST_MAX_SIZE))


def swing_daily_scores(spark, sf):
    """Swing with per-day user-pair counts over the 30 days of events (SW3 per day, SW5 across days)."""
    ui = swing.user_item(T.event_clicks(spark, sf, strict_ids=False), day_col="day")
    return swing.swing_from_clicks(ui, whitelist=T.part_whitelist(spark, sf, P.WHITELIST_MAX_SIZE), day_col="day") \
        .select("itemi", "itemj", _r("swing_score"))


def swing_user_weight(spark, sf):
    return swing.user_weights(cp_ui(spark, sf)).select("user", _r("weight"))


def swing_u2u(spark, sf):
    return swing.user_pair_counts(cp_ui(spark, sf))


def swing_u2u_rare_items(spark, sf):
    """SW3 where the item-size bound binds: items of at most 25 users."""
    return swing.user_pair_counts(cp_ui(spark, sf), max_users=25)


def cp_swing_lines(spark, sf):
    lists = swing.swing_lists(cp_swing(spark, sf)).withColumn("swing_score", F.round("swing_score", 6))
    return swing.swing_text(lists, fmt="%d:%.6f")


def swing_lines(spark, sf):
    """The Swing list text."""
    return cp_swing_lines(spark, sf)


def swing_lines_parsed(spark, sf):
    """SC8: list text read back to rows."""
    from coclick.sources.text import parse_score_lists
    return parse_score_lists(cp_swing_lines(spark, sf), "line").select("key", "item", _r("score"))


def swing_i2i_users(spark, sf):
    return swing.item_pair_users(cp_ui(spark, sf))


def swing_paths(spark, sf):
    ui = cp_ui(spark, sf)
    return swing.item_pair_user_pairs(swing.item_pair_users(ui, striped=True), clicks=ui)


def swing_scores(spark, sf):
    return cp_swing(spark, sf).select("itemi", "itemj", _r("swing_score"))


def swing_topk(spark, sf):
    return swing.swing_lists(cp_swing(spark, sf)).select("itemi", "rank", "itemj", _r("swing_score"))


def swing_reweighted(spark, sf):
    rw = swing.reweighted_scores(cp_swing(spark, sf), T.part_features(spark, sf), "ID")
    return swing.swing_lists(rw).select("itemi", "rank", "itemj", _r("swing_score"))


def swing_cases(spark, sf):
    return swing.case_report(cp_swing(spark, sf), T.part_shops(spark, sf))


def list_length_profile(spark, sf):
    lines = swing.swing_text(swing.swing_lists(cp_swing(spark, sf)))
    return swing.length_profile(lines).select(
        "key_size", *[_r(c) for c in ["avg_length"] + [f"per{q}" for q in range(10, 100, 10)]])


# --------------------------------------------------------------- graph ---
def ev_all(spark, sf):
    """All events (any type) with a leniently cast item id: the session graph input."""
    return T.event_clicks(spark, sf, event_type=None, strict_ids=False)


def g_daily(spark, sf):
    return graph.session_edges(ev_all(spark, sf), ["user", "day"], tiebreak="eid", day_col="day")


def g_adj(spark, sf):
    merged = graph.merge_edges(g_daily(spark, sf), whitelist=T.part_whitelist(spark, sf, P.WHITELIST_MAX_SIZE),
                               day_col="day", day=P.DAY, n_days=P.MERGE_DAYS)
    return graph.adjacency(merged, edge_thre=P.EDGE_THRE)


def g_labels(spark, sf):
    return g_daily(spark, sf).where(F.col("day") == F.lit(P.DAY).cast("date")).select("va", "vb", "w")


def graph_session_edges(spark, sf):
    return g_daily(spark, sf).select(F.col("day").cast("string").alias("day"), "va", "vb", "w")


def graph_merged(spark, sf):
    return graph.merge_edges(g_daily(spark, sf), whitelist=T.part_whitelist(spark, sf, P.WHITELIST_MAX_SIZE),
                             day_col="day", day=P.DAY, n_days=P.MERGE_DAYS)


def graph_adjacency(spark, sf):
    return g_adj(spark, sf).select("va", "idx", "vb", "w", "deg")


def graph_adjacency_blocks(spark, sf):
    """GR3 with 4 ids per numbered range: the same order by vb."""
    merged = graph.merge_edges(g_daily(spark, sf), whitelist=T.part_whitelist(spark, sf, P.WHITELIST_MAX_SIZE),
                               day_col="day", day=P.DAY, n_days=P.MERGE_DAYS)
    return graph.adjacency(merged, edge_thre=P.EDGE_THRE, block=4).select("va", "idx", "vb", "w", "deg")


def graph_hop1(spark, sf):
    ctx = graph.label_contexts(g_labels(spark, sf))
    return graph.hop1_samples(ctx, g_adj(spark, sf), P.HOP1, P.SEED)


def graph_hop2(spark, sf):
    adj = g_adj(spark, sf)
    h1 = graph.hop1_samples(graph.label_contexts(g_labels(spark, sf)), adj, P.HOP1, P.SEED)
    return graph.hop2_samples(h1, adj, P.HOP2, P.SEED).where(F.col("hop2").isNotNull()) \
        .select("tag", "va", "vb", "pos", "pos2", "hop2")


def g_shared(spark, sf):
    """(label edges, adjacency): daily edges and adjacency are written once for their several uses."""
    daily = stored(g_daily(spark, sf), "daily-edges")
    merged = graph.merge_edges(daily, whitelist=T.part_whitelist(spark, sf, P.WHITELIST_MAX_SIZE),
                               day_col="day", day=P.DAY, n_days=P.MERGE_DAYS)
    labels = daily.where(F.col("day") == F.lit(P.DAY).cast("date")).select("va", "vb", "w")
    return labels, stored(graph.adjacency(merged, edge_thre=P.EDGE_THRE), "adjacency")


def graph_training_rows(spark, sf):
    labels, adj = g_shared(spark, sf)
    return graph.training_rows(labels, adj, k1=P.HOP1, k2=P.HOP2, seed=P.SEED)


# ------------------------------------------------------ user-CF / eval ---
def uc_hist(spark, sf):
    ev = T.event_clicks(spark, sf).where(C.local_days_ts_filter("ts", P.PRED_DAY, P.MERGE_DAYS, P.TZ))
    return usercf.user_histories(ev, whitelist=T.part_whitelist(spark, sf, P.WHITELIST_MAX_SIZE))


def uc_sim(spark, sf):
    return usercf.user_similarity(uc_hist(spark, sf))


def uc_recs(spark, sf):
    return usercf.recommend_from_histories(uc_hist(spark, sf))


def usercf_short(spark, sf):
    """UC1-UC3 where the caps bind: 5 clicks of history, 10 items a list."""
    ev = T.event_clicks(spark, sf).where(C.local_days_ts_filter("ts", P.PRED_DAY, P.MERGE_DAYS, P.TZ))
    hist = usercf.user_histories(ev, whitelist=T.part_whitelist(spark, sf, P.WHITELIST_MAX_SIZE), cap=5)
    return usercf.recommend_from_histories(hist, cap=10).select("user", "rank", "item", _r("value"))


def click_log(spark, sf):
    """SRC1/SRC2/SRC5: the raw click-log scan over ``events`` in the log's schema: payload, region, placement, local day."""
    ev = T.table(spark, sf, "events")
    raw = ev.select(
        F.col("user_id").alias("userid"), F.col("event_id").alias("event_timestamp"), F.col("event_type").alias("operation"),
        F.lit("item").alias("target_type"), F.lit("home").alias("page_type"), F.col("props").alias("data"),
        F.when(F.col("event_id") % 2 == 0, F.array(F.lit("daily"), F.lit("x"))).otherwise(F.array(F.lit("x"), F.lit("daily")))
        .alias("page_section"),
        F.when(F.col("user_id") % 3 == 1, "ID").otherwise("SG").alias("region"),
        F.to_date("ts").alias("utc_date"), F.hour("ts").alias("hour"))
    return C.read_clicks(raw, region="ID", day=P.LABEL_DAY, tz_hours=P.TZ, placement=("home", "daily"), session_col=None,
                         item_path="$.k")


def usercf_history(spark, sf):
    return uc_hist(spark, sf).select("user", "rank", "item")


def usercf_similarity(spark, sf):
    return uc_sim(spark, sf).select("u1", "u2", "weight", "weight_a", "weight_b", _r("score"))


def usercf_recommend(spark, sf):
    return uc_recs(spark, sf).select("user", "rank", "item", _r("value"))


def usercf_lines(spark, sf):
    return usercf.recommend_text(uc_recs(spark, sf))


def usercf_history_lines(spark, sf):
    return usercf.history_text(uc_hist(spark, sf))


def item_ids(spark, sf):
    """SRC3 / SRC4 on every event payload: strict digit parse and lenient cast."""
    from coclick.functions.ids import item_id_cast, item_id_strict
    ev = T.table(spark, sf, "events").select("event_id", "props")
    return ev.select("event_id", item_id_strict("props", "$.k").alias("item_strict"),
                     item_id_cast("props", "$.k").alias("item_cast"))


def item_ids_variant(spark, sf):
    """SRC3 / SRC4 from payloads parsed once."""
    from coclick.functions.ids import parsed_payload, variant_id_cast, variant_id_strict
    ev = T.table(spark, sf, "events").select("event_id", parsed_payload("props").alias("v"))
    return ev.select("event_id", variant_id_strict("v", "$.k").alias("item_strict"), variant_id_cast("v", "$.k").alias("item_cast"))


def price_quantiles(spark, sf):
    """AG7's percentiles as exact distributed selection, over every order line's price and discount."""
    li = T.table(spark, sf, "lineitem")
    parts = [selection.quantiles(li, c, [i / 10 for i in range(11)]).select(F.lit(c).alias("column"), "probability", _r("value"))
             for c in ("l_extendedprice", "l_discount")]
    return parts[0].unionByName(parts[1])


def dictionary_prefixes(spark, sf):
    """DC1: how many distinct words of the documents begin with each word of the benchmark."""
    words = lambda t: lookup.tokens(T.table(spark, sf, t), "doc_id" if t == "documents" else "item_id", "text")
    return lookup.prefix_counts(words("benchmark"), words("documents"))


def dictionary_longest(spark, sf):
    """DC1: the longest benchmark word that each word of the documents begins with."""
    words = lambda t: lookup.tokens(T.table(spark, sf, t), "doc_id" if t == "documents" else "item_id", "text")
    return lookup.longest_matches(words("documents"), words("benchmark"))


def eval_hit_ratio(spark, sf):
    labels = T.event_clicks(spark, sf).where(C.local_day_ts_filter("ts", P.LABEL_DAY, P.TZ))
    return usercf.hit_ratio(labels, uc_recs(spark, sf)).select("user", _r("score"))


def local_day(spark, sf):
    ev = T.event_clicks(spark, sf).where(C.local_day_ts_filter("ts", P.LABEL_DAY, P.TZ))
    return ev.select("eid", "user", "item")


def latest_partition(spark, sf):
    f = C.latest_partition(T.part_features(spark, sf).where(F.col("country") == "ID"), "dt")
    return f.select("itemid", _r("ctcvr30"), "dt")


def group_quota(spark, sf):
    sym = itemcf.symmetric_pairs(cp_scores(spark, sf))
    top = topk.top_k_by_key(sym, ["item"], [topk.rank_key("score"), "nbr"], itemcf.LIST_K1).drop("rank")
    shops = T.part_shops(spark, sf).select(F.col("item_id").alias("nbr"), "shop_id")
    capped = topk.cap_per_group(top.join(shops, "nbr"), ["item"], F.col("shop_id"),
                                [topk.rank_key("score"), "nbr"], per_group=5, total=500)
    return capped.select("item", "rank", "nbr", _r("score"))


def group_quota_low32(spark, sf):
    """WN9 / SC9: ids whose low 32 bits are the shop; 2 per shop, 10 in all."""
    sym = itemcf.symmetric_pairs(cp_scores(spark, sf))
    shops = T.part_shops(spark, sf).select(F.col("item_id").alias("nbr"), "shop_id")
    wide = sym.join(shops, "nbr").withColumn("nbr", F.shiftleft("nbr", 32).bitwiseOR(F.col("shop_id")))
    capped = topk.cap_per_group(wide, ["item"], F.col("nbr").bitwiseAND(F.lit(0xFFFFFFFF)),
                                [topk.rank_key("score"), "nbr"], per_group=2, total=10)
    return capped.select("item", "rank", "nbr", _r("score"))


# ------------------------------------------------------------- vectors ---
def ev_sentences(spark, sf):
    # chunks of a long session overlap by the model's window
    return vectors.session_sentences(T.event_clicks(spark, sf), ["user", "day"], tiebreak="eid", overlap=vectors.W2V_WINDOW)


def sentences_overlap(spark, sf):
    """VEC1b where the cut binds: chunks of 8 items that repeat the last 3 of the chunk before."""
    s = vectors.session_sentences(T.copurchase(spark, sf), ["user"], tiebreak="session", max_len=8, overlap=3)
    return s.select("user", "chunk", "sentence")


def sentences(spark, sf):
    return ev_sentences(spark, sf).select("user", F.col("day").cast("string").alias("day"), "chunk", "sentence")


def item2vec_groups(spark, sf):
    """VEC1 in blocks: whether the nearest item of every supplier with company is of its nation.

    Sessions are a nation's order lines, so suppliers only ever meet those of their nation.
    """
    su = T.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("item"), F.col("s_nationkey").alias("nation"))
    li = T.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("item"), "l_orderkey", F.col("l_shipdate").alias("ts"))
    clicks = li.join(su, "item").select("nation", (F.col("l_orderkey") % 50).alias("part"), "item", "ts")
    vecs = stored(skipgram.item2vec_blocks(clicks, ["nation", "part"], epochs=6, items_per_block=40), "item2vec")
    nation = lambda c: su.select(F.col("item").alias(c), F.col("nation").alias(f"{c}_nation"))
    met = vecs.select(F.col("id").alias("item")).join(su, "item")
    company = met.groupBy("nation").agg(F.count("*").alias("n")).where("n > 1").select(F.col("nation").alias("qid_nation"))
    near = vectors.knn_exact(vecs, vecs, 2, "cosine").where("qid <> cid")
    # itself may come second where two vectors are equal
    near = topk.top_k_by_key(near.drop("rank"), ["qid"], [F.round("dist", 9), "cid"], 1)
    return near.join(nation("qid"), "qid").join(nation("cid"), "cid").join(company, "qid_nation", "left_semi") \
        .select(F.col("qid").alias("id"), (F.col("qid_nation") == F.col("cid_nation")).alias("same_nation"))


def _knn(space):
    def q(spark, sf):
        e = T.embeddings(spark, sf)
        return vectors.knn_exact(e, e, P.KNN_K, space).select("qid", "rank", "cid", _r("dist"))
    q.__name__ = f"knn_{space}"
    return q


def knn_pruned(spark, sf):
    """VEC2 with shells around pivots that the triangle inequality skips."""
    e = T.embeddings(spark, sf)
    return metric_knn.knn_pruned(e, e, P.KNN_K, "l2", pivots=16, block=64).select("qid", "rank", "cid", _r("dist"))


def knn_approx(spark, sf):
    e = T.embeddings(spark, sf)
    return vectors.knn_approx(e, e, P.KNN_K, "cosine", n_lists=P.N_LISTS, n_probe=P.N_PROBE, seed=P.SEED) \
        .select("qid", "rank", "cid", _r("dist"))


def knn_ivf_all_lists(spark, sf):
    """IVF search probing every list: must equal the exact kNN (checks lists, tiles and merge)."""
    e = T.embeddings(spark, sf)
    return vectors.knn_approx(e, e, P.KNN_K, "cosine", n_lists=8, n_probe=8).select("qid", "rank", "cid", _r("dist"))


def knn_ivf_seeded(spark, sf):
    """IVF search with partial probing (8 of 16 lists) over MD5-seeded centroids."""
    e = T.embeddings(spark, sf)
    centres = vectors.seed_centres(e, P.N_LISTS, "cosine", P.SEED)
    return vectors.ivf_search(e, e, centres, P.KNN_K, "cosine", n_probe=P.N_PROBE_WIDE).select("qid", "rank", "cid", _r("dist"))


def knn_recall_seeded(spark, sf):
    """recall@k of the seeded IVF search (8 of 16 lists) against the exact kNN."""
    e = T.embeddings(spark, sf)
    approx = vectors.ivf_search(e, e, vectors.seed_centres(e, P.N_LISTS, "cosine", P.SEED), P.KNN_K, "cosine", n_probe=P.N_PROBE_WIDE)
    return vectors.recall_at_k(approx, vectors.knn_exact(e, e, P.KNN_K, "cosine")).select(_r("recall"), "queries")


def knn_graph(spark, sf):
    """VEC3: queries with an id divisible by 50 through the neighbour graph of all vectors."""
    e = T.embeddings(spark, sf)
    return neighbour_graph.knn_graph(e.where("id % 50 = 0"), e, P.KNN_K, "l2").select("qid", "rank", "cid", _r("dist"))


def knn_graph_recall(spark, sf):
    """Whether the graph search finds at least 0.95 of the true neighbours (VEC2) of those queries."""
    e = T.embeddings(spark, sf)
    q = e.where("id % 50 = 0")
    found = vectors.recall_at_k(neighbour_graph.knn_graph(q, e, P.KNN_K, "cosine"), vectors.knn_exact(q, e, P.KNN_K, "cosine"))
    return found.select("queries", (F.col("recall") >= 0.95).alias("recall_095"))


def knn_recall(spark, sf):
    e = T.embeddings(spark, sf)
    approx = vectors.knn_approx(e, e, P.KNN_K, "cosine", n_lists=P.N_LISTS, n_probe=P.N_PROBE, seed=P.SEED)
    return vectors.recall_at_k(approx, vectors.knn_exact(e, e, P.KNN_K, "cosine")).select(_r("recall"), "queries")


def item2vec(spark, sf):
    model = vectors.item2vec_fit(ev_sentences(spark, sf))
    return vectors.model_vectors(model)


def item2vec_facts(spark, sf):
    """VEC1 by what can be checked: vocabulary, dimension, finite vectors."""
    return item2vec(spark, sf).select("id", F.size("vec").cast("bigint").alias("dim"), F.forall(
        "vec", lambda x: ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))).alias("finite"))


def similar_items(spark, sf):
    model = vectors.item2vec_fit(ev_sentences(spark, sf))
    return vectors.similar_items(model, k=5).select("qid", "rank", "cid", _r("dist"))


# ---------------------------------------------- GNN / in-batch metrics ---
def emb_pairs(spark, sf):
    """Consecutive embedding ids (2p, 2p+1) form pair p; batches of BATCH_SIZE pairs."""
    e = T.embeddings(spark, sf)
    a = e.where(F.col("id") % 2 == 0).select((F.col("id") / 2).cast("bigint").alias("pair"), F.col("vec").alias("a"))
    b = e.where(F.col("id") % 2 == 1).select(((F.col("id") - 1) / 2).cast("bigint").alias("pair"), F.col("vec").alias("b"))
    return a.join(b, "pair").select(F.floor(F.col("pair") / P.BATCH_SIZE).cast("bigint").alias("batch"),
                                    F.pmod(F.col("pair"), F.lit(P.BATCH_SIZE)).cast("bigint").alias("pos"), "a", "b")


def inbatch_loss(spark, sf):
    return gnn.inbatch_softmax_loss(emb_pairs(spark, sf)).select("batch", "pos", _r("loss"), _r("p_pos"))


def inbatch_metrics(spark, sf):
    return gnn.inbatch_metrics(emb_pairs(spark, sf)).select(
        "batch", "n", *[_r(c) for c in ("pos_cos", "neg_cos", "p_at_1", "mrr")])


GNN_DIMS = (64, 32, 16)   # input (embedding) size, hidden size, output size
GNN_SEED = 0


def gnn_embeddings(spark, sf):
    """NN1 on the graph samples with the embeddings as node vectors; one row per output dimension."""
    labels, adj = g_shared(spark, sf)
    samples = graph.two_hop_samples(labels, adj, k1=P.HOP1, k2=P.HOP2, seed=P.SEED)
    W = gnn.init_weights(*GNN_DIMS, seed=GNN_SEED)
    emb = gnn.neighbour_max_pool(samples, T.embeddings(spark, sf), W, P.HOP1, P.HOP2, out_type="double")
    return emb.select("tag", "va", "vb", F.posexplode("emb").alias("dim", "value")) \
        .select("tag", "va", "vb", F.col("dim").cast("bigint").alias("dim"), _r("value"))


def gnn_two_tower_loss(spark, sf):
    """NN1 on both sides of every label edge, NN2 over the pairs of one centre as a batch."""
    labels, adj = g_shared(spark, sf)
    W = gnn.init_weights(*GNN_DIMS, seed=GNN_SEED)
    vec = T.embeddings(spark, sf)

    def tower(centre, other):
        s = graph.two_hop_samples(labels, adj, centre=centre, other=other, k1=P.HOP1, k2=P.HOP2, seed=P.SEED)
        return gnn.neighbour_max_pool(s, vec, W, P.HOP1, P.HOP2, out_type="double")

    b = tower("vb", "va").select("tag", F.col("va").alias("vb"), F.col("vb").alias("va"), F.col("emb").alias("b"))
    pairs = tower("va", "vb").withColumnRenamed("emb", "a").join(b, ["tag", "va", "vb"])
    pos = F.row_number().over(Window.partitionBy("va").orderBy("tag", "vb")) - 1
    pairs = pairs.select(F.col("va").alias("batch"), pos.cast("bigint").alias("pos"), "a", "b")
    return gnn.inbatch_softmax_loss(pairs).select("batch", "pos", _r("loss"), _r("p_pos"))


# ------------------------------------------------------ MMR / dictionary ---
def mmr_candidates(spark, sf):
    """Per embedding: its MMR_K nearest other embeddings, score = cosine similarity."""
    e = T.embeddings(spark, sf)
    nn = vectors.knn_exact(e, e, P.MMR_K + 1, "cosine").where(F.col("qid") != F.col("cid"))
    nn = topk.top_k_by_key(nn.drop("rank"), ["qid"], [F.round("dist", topk.RANK_DIGITS), "cid"], P.MMR_K)
    return nn.select(F.col("qid").alias("query"), F.col("cid").alias("item"), (F.lit(1.0) - F.col("dist")).alias("score"))


def mmr_top2(spark, sf):
    out = rerank.mmr_rerank(mmr_candidates(spark, sf), T.embeddings(spark, sf), lam=0.5, top_n=2)
    return out.select("query", "rank", "item", _r("mmr"))


def mmr_rerank(spark, sf):
    out = rerank.mmr_rerank(mmr_candidates(spark, sf), T.embeddings(spark, sf), lam=0.5, top_n=P.MMR_TOP_N)
    return out.select("query", "rank", "item", _r("mmr"))


def mmr_sim_table(spark, sf):
    # the search is done once for the lists and the table
    cand = stored(mmr_candidates(spark, sf), "mmr-candidates")
    sims = cand.select(F.col("query").alias("item_a"), F.col("item").alias("item_b"), F.col("score").alias("sim"))
    out = rerank.mmr_rerank_pairs(cand, sims, lam=0.5, top_n=P.MMR_TOP_N)
    return out.select("query", "rank", "item", _r("mmr"))


def dictionary_match(spark, sf):
    return lookup.match_counts(T.table(spark, sf, "documents").select("doc_id", "text"),
                               T.table(spark, sf, "benchmark").select("text"))


QUERIES: dict[str, Query] = {
    "itemcf_daily": itemcf_daily,
    "itemcf_merged": itemcf_merged,
    "itemcf_scores": itemcf_scores,
    "itemcf_topk": itemcf_topk,
    "itemcf_lines": itemcf_lines,
    "itemcf_capped": itemcf_capped,
    "itemcf_short_lists": itemcf_short_lists,
    "itemcf_bounded_lists": itemcf_bounded_lists,
    "itemcf_pairs_over": itemcf_pairs_over,
    "swing_user_weight": swing_user_weight,
    "swing_u2u": swing_u2u,
    "swing_u2u_rare_items": swing_u2u_rare_items,
    "swing_i2i_users": swing_i2i_users,
    "swing_paths": swing_paths,
    "swing_scores": swing_scores,
    "swing_daily_scores": swing_daily_scores,
    "swing_topk": swing_topk,
    "swing_reweighted": swing_reweighted,
    "swing_cases": swing_cases,
    "swing_lines": swing_lines,
    "swing_lines_parsed": swing_lines_parsed,
    "list_length_profile": list_length_profile,
    "graph_session_edges": graph_session_edges,
    "graph_merged": graph_merged,
    "graph_adjacency": graph_adjacency,
    "graph_adjacency_blocks": graph_adjacency_blocks,
    "graph_hop1": graph_hop1,
    "graph_hop2": graph_hop2,
    "graph_training_rows": graph_training_rows,
    "usercf_history": usercf_history,
    "usercf_similarity": usercf_similarity,
    "usercf_recommend": usercf_recommend,
    "usercf_lines": usercf_lines,
    "usercf_short": usercf_short,
    "usercf_history_lines": usercf_history_lines,
    "eval_hit_ratio": eval_hit_ratio,
    "item_ids": item_ids,
    "local_day": local_day,
    "click_log": click_log,
    "latest_partition": latest_partition,
    "group_quota": group_quota,
    "group_quota_low32": group_quota_low32,
    "sentences": sentences,
    "item2vec_groups": item2vec_groups,
    "sentences_overlap": sentences_overlap,
    "knn_cosine": _knn("cosine"),
    "knn_l2": _knn("l2"),
    "knn_ip": _knn("ip"),
    "knn_pruned": knn_pruned,
    "knn_approx": knn_approx,
    "knn_ivf_all_lists": knn_ivf_all_lists,
    "knn_ivf_seeded": knn_ivf_seeded,
    "knn_recall_seeded": knn_recall_seeded,
    "knn_recall": knn_recall,
    "knn_graph": knn_graph,
    "knn_graph_recall": knn_graph_recall,
    "item2vec": item2vec,
    "item2vec_facts": item2vec_facts,
    "similar_items": similar_items,
    "inbatch_loss": inbatch_loss,
    "inbatch_metrics": inbatch_metrics,
    "gnn_embeddings": gnn_embeddings,
    "gnn_two_tower_loss": gnn_two_tower_loss,
    "mmr_top2": mmr_top2,
    "mmr_rerank": mmr_rerank,
    "mmr_sim_table": mmr_sim_table,
    "dictionary_match": dictionary_match,
    "dictionary_prefixes": dictionary_prefixes,
    "dictionary_longest": dictionary_longest,
    "item_ids_variant": item_ids_variant,
    "price_quantiles": price_quantiles,
    **catalog_io.QUERIES,
}


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Top similar parts per part from co-purchases (CF1 -> CF4)."""
    return itemcf_topk(spark, sf)
