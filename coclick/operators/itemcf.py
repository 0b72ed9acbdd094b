"""Item-CF: co-click counts, N-day merge, cosine scores, neighbour lists (CF1-CF4).

Daily counts are rows ``(vi, vj, weight)``: ``vi < vj`` for pairs, ``vi = vj`` for
an item's own count (the diagonal, so no id is reserved).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coclick.operators.pairs import (
    DEFAULT_BLOCK,
    canonical_pair,
    symmetrise,
    window_pairs,
)
from coclick.operators.positions import numbered
from coclick.operators.stripes import STRIPE, group_stripes, pair_sums
from coclick.operators.topk import clamp, collect_ranked, floor_filter, rank_key, top_k_by_key
from coclick.session import stored
from coclick.sinks.files import write_clustered
from coclick.sources.clicks import day_range_filter
from coclick.functions.text import score_pairs_text

# Fixed values of the reference's item-CF job.
MAX_USER_ITEMS = 100000   # clicks kept per user
MIN_USER_ITEMS = 2        # users with fewer clicks are skipped
WINDOW_SIZE = 10000       # a click pairs with the next 10000 clicks of the user
MIN_WEIGHT = 3            # merged count threshold
LIST_K1 = 1000            # neighbours kept per item before truncation
LIST_K2 = 200             # final list length
MIN_KEEP = 50             # always kept, whatever the score
SCORE_FLOOR = 0.001       # later neighbours need score > floor


def ranked_clicks(clicks: DataFrame, keys: list[str], *, item_col: str = "item", ts_col: str = "ts",
                  weight_col: str | None = None, max_user_items: int | None = MAX_USER_ITEMS,
                  min_user_items: int = MIN_USER_ITEMS, rows_per_task: int | None = None) -> DataFrame:
    """Clicks that count, numbered per key by (ts, item): ``keys, item, ts, w, n, pos``.

    A key keeps its first ``max_user_items`` clicks by (-weight, item, ts)
    (lowest ids when weights tie -- not the most recent; WN3); keys with fewer
    than ``min_user_items`` clicks are skipped (FLT2).  Users of more than
    ``rows_per_task`` clicks are numbered by many tasks (:func:`numbered`).
    """
    w = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    c = clicks.where(F.col(item_col).isNotNull()) \
        .select(*keys, F.col(item_col).cast("bigint").alias("item"), F.col(ts_col).alias("ts"), w.alias("w"))
    if max_user_items is None:
        return numbered(c, keys, ["ts", "item", "w"], "pos", "n", rows_per_task=rows_per_task) \
            .where(F.col("n") >= min_user_items)
    c = numbered(c.withColumn("__down", -F.col("w")), keys, ["__down", "item", "ts"], "__r", "n",
                 rows_per_task=rows_per_task) \
        .where((F.col("n") >= min_user_items) & (F.col("__r") <= max_user_items)) \
        .withColumn("n", F.least(F.col("n"), F.lit(max_user_items))).where(F.col("n") >= min_user_items) \
        .drop("__r", "__down")
    # a user has at most max_user_items rows here
    return c.withColumn("pos", F.row_number().over(Window.partitionBy(*keys).orderBy("ts", "item", "w")).cast("bigint"))


def daily_cooccurrence(clicks: DataFrame, *, user_col: str = "user", item_col: str = "item",
                       ts_col: str = "ts", day_col: str | None = None, weight_col: str | None = None,
                       max_user_items: int | None = MAX_USER_ITEMS, min_user_items: int = MIN_USER_ITEMS,
                       window_size: int = WINDOW_SIZE, block: int = DEFAULT_BLOCK,
                       rows_per_task: int | None = None, whitelist: DataFrame | None = None) -> DataFrame:
    """CF1: per (day,) user: pair counts inside a sliding window of clicks.

    Clicks are chosen and numbered by :func:`ranked_clicks`; each click pairs
    with the next ``window_size`` clicks of its user, equal items are skipped,
    pairs are keyed by (min, max) with weight w_i * w_j (WN1).  An item's own
    count is the sum of w^2 over its clicks, a plain aggregate, on the diagonal
    (``vi = vj``), so every id is usable.

    With ``whitelist`` only recommendable clicks are paired, at their positions
    among all clicks: the same rows that CF2 would keep, without building the
    others.  Returns ``[day_col,] vi, vj, weight``.
    """
    dkeys = [day_col] if day_col else []
    keys = dkeys + [user_col]
    c = ranked_clicks(clicks, keys, item_col=item_col, ts_col=ts_col, weight_col=weight_col,
                      max_user_items=max_user_items, min_user_items=min_user_items, rows_per_task=rows_per_task)
    if whitelist is not None:
        c = c.join(whitelist.select("item"), "item", "left_semi")
    if day_col is None:
        return _by_stripes(c, user_col, window_size, block)
    own = c.groupBy(*dkeys, F.col("item").alias("vi")).agg(F.sum(F.col("w") * F.col("w")).alias("weight")) \
        .select(*dkeys, "vi", F.col("vi").alias("vj"), "weight")
    return _windowed(c, keys, dkeys, window_size, block).unionByName(own)


def _windowed(c: DataFrame, keys: list[str], dkeys: list[str], window_size: int, block: int) -> DataFrame:
    """Pair weights of numbered clicks inside the window."""
    p = window_pairs(c, keys, "pos", "n", ["item", "w"], window_size, block).where(F.col("item_a") != F.col("item_b"))
    lo, hi = canonical_pair("item_a", "item_b")
    return p.groupBy(*dkeys, lo.alias("vi"), hi.alias("vj")).agg(F.sum(F.col("w_a") * F.col("w_b")).alias("weight"))


def _by_stripes(c: DataFrame, user_col: str, window_size: int, block: int) -> DataFrame:
    """CF1 of numbered clicks: users within the window by item as stripes, the others by position.

    All clicks of a user within the window are paired, so an item counts with the sum of its weights.
    """
    c = stored(c.select(user_col, "item", "w", "n", "pos"), "daily-clicks")
    own = c.groupBy(F.col("item").alias("vi")).agg(F.sum(F.col("w") * F.col("w")).alias("weight")) \
        .select("vi", F.col("vi").alias("vj"), "weight")
    whole = F.col("n") <= window_size + 1
    x = stored(c.where(whole).groupBy(user_col, "item").agg(F.sum("w").alias("x")), "daily-items")
    pairs = pair_sums(group_stripes(x, [user_col], "item", "x", block=min(block, STRIPE)), x, "item") \
        .select(F.col("a").alias("vi"), F.col("b").alias("vj"), "weight")
    if not c.where(~whole).isEmpty():
        pairs = pairs.unionByName(_windowed(c.where(~whole), [user_col], [], window_size, block)) \
            .groupBy("vi", "vj").agg(F.sum("weight").alias("weight"))
    return pairs.unionByName(own)


def merge_counts(daily: DataFrame, *, whitelist: DataFrame | None = None, day_col: str | None = None,
                 day=None, n_days: int | None = None, min_weight: float = MIN_WEIGHT) -> DataFrame:
    """CF2: sum daily counts over days D-n..D, whitelist both ends, threshold.

    The threshold also removes item-count rows, so a pair survives CF3 only if
    both items reach it.  Returns ``va, vb, weight`` (``va = vb``: item count).
    """
    d = daily
    if day_col is not None and day is not None:
        d = d.where(day_range_filter(day_col, day, n_days or 0))
    if whitelist is not None:
        wl = whitelist.select(F.col("item").alias("__w"))
        d = d.join(wl, F.col("vi") == F.col("__w"), "left_semi").join(wl, F.col("vj") == F.col("__w"), "left_semi")
    return d.groupBy("vi", "vj").agg(F.sum("weight").alias("weight")) \
        .where(F.col("weight") >= min_weight) \
        .select(F.col("vi").alias("va"), F.col("vj").alias("vb"), "weight")


def clustered_counts(merged: DataFrame, buckets: int | None = None) -> DataFrame:
    """The items' own counts (va = vb) stored clustered by item, for :func:`attach_counts`."""
    return write_clustered(merged.where(F.col("va") == F.col("vb")).select("va", "weight"), ["va"], "item-counts", buckets)


def attach_counts(merged: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """JN1: pairs joined to both items' counts -> ``va, vb, weight, weight_a, weight_b``.

    ``counts(va, weight)`` are the items' own counts if they are stored apart
    (:func:`clustered_counts`: neither join shuffles them), else those in ``merged``.
    """
    pairs = merged.where(F.col("va") != F.col("vb"))
    own = merged.where(F.col("va") == F.col("vb")) if counts is None else counts
    a = own.select(F.col("va"), F.col("weight").alias("weight_a"))
    b = own.select(F.col("va").alias("vb"), F.col("weight").alias("weight_b"))
    return pairs.join(a, "va").join(b, "vb").select("va", "vb", "weight", "weight_a", "weight_b")


def cosine_scores(merged: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """CF3: ``score = weight / sqrt(weight_a) / sqrt(weight_b)`` per stored pair."""
    j = attach_counts(merged, counts)
    return j.withColumn("score", F.col("weight") / F.sqrt("weight_a") / F.sqrt("weight_b"))


def neighbour_lists(scores: DataFrame, *, k1: int = LIST_K1, k2: int = LIST_K2, min_keep: int = MIN_KEEP,
                    floor: float = SCORE_FLOOR, clamp_at: float = 1.0) -> DataFrame:
    """CF4: both directions, per item by (score desc, id), cut to the final list.

    Rows ``item, rank, nbr, score, weight, weight_a, weight_b``; score is
    clamped to ``clamp_at`` (FLT9); list rule FLT8.
    """
    sym = symmetrise(scores, ["va", "weight_a"], ["vb", "weight_b"], ["item", "weight_a"], ["nbr", "weight_b"],
                     keep=["weight", "score"])
    k = min(k1, k2)
    ranked = top_k_by_key(sym, ["item"], [rank_key("score"), "nbr", "weight", "weight_a", "weight_b"], k)
    ranked = ranked.withColumn("score", clamp(F.col("score"), clamp_at))
    return ranked.where(floor_filter(F.col("rank"), F.col("score"), min_keep, floor, k)) \
        .select("item", "rank", "nbr", "score", "weight", "weight_a", "weight_b")


def neighbour_text(lists: DataFrame, fmt: str | None = "%d:%f") -> DataFrame:
    """SNK5 / SNK6 line: ``item<TAB>id:score;id:score`` in rank order (column ``line``)."""
    arr = collect_ranked(lists.select("item", "rank", F.col("nbr").alias("it"), "score"), ["item"], "rank",
                         ["it", "score"], "items")
    arr = arr.withColumn("items", F.transform("items", lambda s: F.struct(s["it"].alias("item"), s["score"].alias("score"))))
    return arr.select("item", F.concat(F.col("item").cast("string"), F.lit("\t"),
                                       score_pairs_text("items", ";", fmt)).alias("line"))


def symmetric_pairs(scores: DataFrame) -> DataFrame:
    """Both directions of every scored pair (used by invariant tests)."""
    return symmetrise(scores, ["va"], ["vb"], ["item"], ["nbr"], keep=["score"])
