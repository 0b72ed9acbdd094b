"""User-CF recommendation lists (UC1-UC3) and offline hit ratio (EV1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coclick.operators.overlap import blocks_of, pair_overlaps
from coclick.operators.pairs import DEFAULT_BLOCK, group_pairs, symmetrise
from coclick.operators.skew import split_join
from coclick.operators.stripes import STRIPE, group_stripes, integral, pair_sums
from coclick.operators.topk import rank_key, top_k_by_key
from coclick.session import stored

# Fixed values of the reference's user-CF job.
HISTORY_CAP = 700   # clicks kept per user (most recent first)
LIST_CAP = 700      # recommended items per user


def user_histories(clicks: DataFrame, whitelist: DataFrame | None = None, cap: int = HISTORY_CAP,
                   user_col: str = "user", item_col: str = "item", ts_col: str = "ts") -> DataFrame:
    """UC1 / WN4: per user the ``cap`` most recent clicks by (-ts, item).

    Ids 0 are invalid; with a whitelist only recommendable items stay.
    Returns (user, rank, item, weight=1.0); repeated clicks stay repeated.
    """
    c = clicks.where(F.col(item_col).isNotNull() & (F.col(item_col) != 0)) \
        .select(F.col(user_col).alias("user"), F.col(item_col).cast("bigint").alias("item"), F.col(ts_col).alias("ts"))
    if whitelist is not None:
        c = c.join(whitelist.select("item"), "item", "left_semi")
    return top_k_by_key(c, ["user"], [F.col("ts").desc(), "item"], cap) \
        .select("user", "rank", "item", F.lit(1.0).alias("weight"))


def history_text(hist: DataFrame) -> DataFrame:
    """The reference's history list: ``item:1.0,item:1.0`` in rank order."""
    arr = hist.groupBy("user").agg(F.array_sort(F.collect_list(F.struct("rank", "item", "weight"))).alias("l"))
    return arr.select("user", F.array_join(F.transform(
        "l", lambda x: F.concat(x["item"].cast("string"), F.lit(":"), x["weight"].cast("string"))), ",")
        .alias("itemlist"))


def user_similarity(ui: DataFrame, block: int = DEFAULT_BLOCK) -> DataFrame:
    """UC2: user-user cosine over distinct clicked items, both directions.

    weight = #items both users clicked, weight_a / weight_b = #items of each;
    score = weight / sqrt(weight_a) / sqrt(weight_b).
    Returns (u1, u2, weight, weight_a, weight_b, score).
    """
    d = ui.select("user", "item").distinct()
    if integral(d, "user"):
        # the users' sizes go along with the pairs, which are not joined again
        d = stored(d, "usercf-clicks")
        d = stored(d.join(d.groupBy("user").agg(F.count(F.lit(1)).cast("double").alias("n")), "user"), "usercf-sizes")
        # users of large groups meet as wholes, where that moves less than their pairs
        blocks = blocks_of(d, "item", "user") if integral(d, "item") else 0
        w = pair_overlaps(d, "item", "user", "n", blocks) if blocks else \
            pair_sums(group_stripes(d, ["item"], "user", "n", block=min(block, STRIPE)), d, "user", carried=True)
        j = w.select(F.col("a").alias("ua"), F.col("b").alias("ub"), "weight", F.col("va").cast("bigint").alias("weight_a"),
                     F.col("vb").cast("bigint").alias("weight_b")) \
            .withColumn("score", F.col("weight") / F.sqrt("weight_a") / F.sqrt("weight_b"))
        return symmetrise(j, ["ua", "weight_a"], ["ub", "weight_b"], ["u1", "weight_a"], ["u2", "weight_b"],
                          keep=["weight", "score"]).select("u1", "u2", "weight", "weight_a", "weight_b", "score")
    sizes = d.groupBy("user").agg(F.count(F.lit(1)).alias("n"))
    p = group_pairs(d, ["item"], "user", min_size=2, block=block)
    w = p.groupBy(F.col("a").alias("ua"), F.col("b").alias("ub")).agg(F.count(F.lit(1)).alias("weight"))
    j = w.join(sizes.select(F.col("user").alias("ua"), F.col("n").alias("weight_a")), "ua") \
        .join(sizes.select(F.col("user").alias("ub"), F.col("n").alias("weight_b")), "ub") \
        .withColumn("score", F.col("weight") / F.sqrt("weight_a") / F.sqrt("weight_b"))
    return symmetrise(j, ["ua", "weight_a"], ["ub", "weight_b"], ["u1", "weight_a"], ["u2", "weight_b"],
                      keep=["weight", "score"]).select("u1", "u2", "weight", "weight_a", "weight_b", "score")


def user_cf_recommend(sim: DataFrame, hist: DataFrame, cap: int = LIST_CAP) -> DataFrame:
    """UC3: value(u1, item) = sum over neighbours u2 of score(u1,u2) x (times
    item occurs in u2's history); per u1 the top ``cap`` by value desc, then
    item id as a string (the reference's tie order).

    The history is pre-aggregated to (user, item, count) before the join.
    Returns (user, rank, item, value).
    """
    h = hist.groupBy(F.col("user").alias("u2"), "item").agg(F.sum("weight").alias("cnt"))
    # neighbours of very many users and their histories are split by their size (JN10)
    v = split_join(sim.select("u1", "u2", "score"), h, ["u2"], split_right=False) \
        .groupBy("u1", "item").agg(F.sum(F.col("score") * F.col("cnt")).alias("value"))
    return top_k_by_key(v, ["u1"], [rank_key("value"), F.col("item").cast("string")], cap) \
        .select(F.col("u1").alias("user"), "rank", "item", "value")


def recommend_from_histories(hist: DataFrame, cap: int | None = LIST_CAP) -> DataFrame:
    """UC2 + UC3 without user pairs: the rows of :func:`user_cf_recommend` over the users of ``hist``.

    With I(u) the distinct items of u, the value is
    sum over other users v of |I(u) & I(v)| / sqrt(|I(u)| |I(v)|) * cnt(v, i).
    Summing over the shared items first gives an item matrix
    M[j, i] = sum over users v with j of cnt(v, i) / sqrt(|I(v)|), and
    value(u, i) = (sum over j in I(u) of M[j, i]) / sqrt(|I(u)|) - cnt(u, i).
    The number of (shared item, user) paths, less u's own |I(u)| when u has i,
    tells exactly which rows another user supports.  The fan-out is a user's
    distinct items squared, never users squared.
    """
    own = hist.groupBy("user", "item").agg(F.sum("weight").alias("cnt"))
    sizes = own.groupBy("user").agg(F.count(F.lit(1)).alias("n"))
    h = own.join(sizes, "user")
    matrix = h.select("user", F.col("item").alias("j")) \
        .join(h.select("user", "item", (F.col("cnt") / F.sqrt("n")).alias("part")), "user") \
        .groupBy("j", "item").agg(F.sum("part").alias("m"), F.count(F.lit(1)).alias("paths"))
    # users of a popular item are dealt to several tasks
    reached = split_join(h.select("user", F.col("item").alias("j"), "n"), matrix, ["j"], split_right=False) \
        .groupBy("user", "item", "n").agg(F.sum("m").alias("m"), F.sum("paths").alias("paths"))
    v = reached.join(own, ["user", "item"], "left") \
        .where(F.col("paths") - F.when(F.col("cnt").isNotNull(), F.col("n")).otherwise(0) > 0) \
        .select("user", "item", (F.col("m") / F.sqrt("n") - F.coalesce("cnt", F.lit(0.0))).alias("value"))
    return top_k_by_key(v, ["user"], [rank_key("value"), F.col("item").cast("string")], cap) \
        .select("user", "rank", "item", "value")


def recommend_text(recs: DataFrame) -> DataFrame:
    """SNK10: ``user<TAB>item,item,...`` in rank order (column ``line``)."""
    arr = recs.groupBy("user").agg(F.array_sort(F.collect_list(F.struct("rank", "item"))).alias("l"))
    return arr.select("user", F.concat(F.col("user").cast("string"), F.lit("\t"),
                                       F.array_join(F.transform("l", lambda x: x["item"].cast("string")), ","))
                      .alias("line"))


def hit_ratio(labels: DataFrame, preds: DataFrame) -> DataFrame:
    """EV1: per user (present in both) #predicted items found in the label
    set / size of the label set.  Repeated predictions count each time.

    ``labels``: (user, item) clicks of the evaluation day; ``preds``: (user, item).
    Returns (user, score).
    """
    lab = labels.select("user", "item").distinct()
    lsize = lab.groupBy("user").agg(F.count(F.lit(1)).alias("n_label"))
    p = preds.select("user", "item")
    hits = p.join(lab, ["user", "item"]).groupBy("user").agg(F.count(F.lit(1)).alias("n_hit"))
    users = lsize.join(p.select("user").distinct(), "user")
    return users.join(hits, "user", "left").select(
        "user", (F.coalesce(F.col("n_hit"), F.lit(0)) / F.col("n_label")).alias("score"))
