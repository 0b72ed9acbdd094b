"""Cosine pairs over a floor without making the others (CF3, CF4).

Item-CF makes every co-clicked pair and drops those under the score floor at the
end.  Here an item is a vector over users (``x`` = its clicks by the user), the
pair weight is the dot product, and an inverted index over users is filtered
*before* pairs are made.  Users are ordered rarest first, the same for all
items.  An item's suffix are its most active users, as many as cannot lift any
pair over the bar on their own; two items whose shared users all lie in the
suffix of the one whose prefix ends first cannot qualify, so only items that
share a user in both prefixes are candidates.  A suffix ends where all three
bounds are passed:

* norms:   ``|y_suffix| * max_j |y_j| > floor`` with ``y = x / sqrt(count)``;
* maxima:  ``sum over the suffix of y[u] * max_j y_j[u] > floor``;
* overlap: ``sum over the suffix of x[u] * max_j x_j[u] >= min_weight``.

Candidates are verified on whole vectors.  Lists that keep ``min_keep``
neighbours whatever their score need the rest of the pairs for the items with
fewer over the floor, and only for those.

Equal to :func:`coclick.operators.itemcf.daily_cooccurrence` and
:func:`coclick.operators.itemcf.cosine_scores` where no user has more clicks
than the pair window.  Hot users and items are split by the helpers used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coclick.operators.itemcf import (
    LIST_K1,
    LIST_K2,
    MAX_USER_ITEMS,
    MIN_KEEP,
    MIN_USER_ITEMS,
    MIN_WEIGHT,
    SCORE_FLOOR,
    neighbour_lists,
    ranked_clicks,
)
from coclick.operators.pairs import group_pairs
from coclick.operators.positions import numbered
from coclick.operators.skew import split_join
from coclick.operators.stripes import group_stripes, pair_sums
from coclick.session import stored

# Bounds are summed as integers, rounded up, so no order of summation can lower one.
_FINE, _COARSE = 1 << 40, 1 << 20


def click_vectors(clicks: DataFrame, whitelist: DataFrame | None = None, *, user_col: str = "user", item_col: str = "item",
                  ts_col: str = "ts", max_user_items: int | None = MAX_USER_ITEMS,
                  min_user_items: int = MIN_USER_ITEMS) -> DataFrame:
    """(item, user, x, own): clicks of each item by each user that counts, and their share of the item's count."""
    c = ranked_clicks(clicks, [user_col], item_col=item_col, ts_col=ts_col, max_user_items=max_user_items,
                      min_user_items=min_user_items)
    if whitelist is not None:
        c = c.join(whitelist.select("item"), "item", "left_semi")
    return c.groupBy("item", F.col(user_col).alias("user")).agg(F.sum("w").alias("x"), F.sum(F.col("w") * F.col("w")).alias("own"))


def _weighted(vectors: DataFrame, min_weight: float) -> tuple[DataFrame, DataFrame]:
    """(vectors of the items that count, (item, count, users))."""
    counts = stored(vectors.groupBy("item").agg(F.sum("own").alias("count"), F.count(F.lit(1)).alias("users"))
                    .where(F.col("count") >= min_weight), "simjoin-counts")
    joined = split_join(vectors, counts, ["item"], split_right=False)
    return stored(joined.select("item", "user", "x", (F.col("x") / F.sqrt("count")).alias("y")), "simjoin-vectors"), counts


def prefixes(weighted: DataFrame, floor: float, min_weight: float) -> DataFrame:
    """(user, item): the rows of the inverted index from which candidates are made."""
    users = weighted.groupBy("user").agg(F.count(F.lit(1)).alias("size"), F.max("x").alias("max_x"), F.max("y").alias("max_y"))
    norm = weighted.groupBy("item").agg(F.sum(F.col("y") * F.col("y")).alias("n2")).agg(F.max("n2")).first()[0] or 0.0
    up = lambda c, scale: F.ceil(c * scale * (1 + 1e-9)).cast("long")
    rows = split_join(weighted, users, ["user"], split_right=False).select(
        "item", "user", (-F.col("size")).alias("__size"), up(F.col("y") * F.col("y"), _FINE).alias("norm"),
        up(F.col("y") * F.col("max_y"), _FINE).alias("most"), up(F.col("x") * F.col("max_x"), _COARSE).alias("shared"))
    # sums from the most active user on
    summed = numbered(rows, ["item"], ["__size", "user"], sums=["norm", "most", "shared"])
    return summed.where((F.col("norm_upto") / _FINE * norm > floor * floor) & (F.col("most_upto") / _FINE > floor)
                        & (F.col("shared_upto") / _COARSE >= min_weight)).select("user", "item")


def candidate_pairs(weighted: DataFrame, floor: float, min_weight: float) -> DataFrame:
    """(a, b), a < b: items that share a user in both prefixes."""
    return group_pairs(prefixes(weighted, floor, min_weight), ["user"], "item").select("a", "b").distinct()


def _scored(pairs: DataFrame, counts: DataFrame, min_weight: float) -> DataFrame:
    """Pairs (a, b, weight) with both counts and the score."""
    of = lambda x: counts.select(F.col("item").alias(x), F.col("count").alias(f"weight_{x}"))
    return pairs.where(F.col("weight") >= min_weight).join(of("a"), "a").join(of("b"), "b").select(
        F.col("a").alias("va"), F.col("b").alias("vb"), "weight", "weight_a", "weight_b",
        (F.col("weight") / F.sqrt("weight_a") / F.sqrt("weight_b")).alias("score"))


def _verified(candidates: DataFrame, weighted: DataFrame, counts: DataFrame) -> DataFrame:
    """(a, b, weight): whole dot products, from the rows of the item with fewer users."""
    of = lambda x: counts.select(F.col("item").alias(x), F.col("users").alias(f"__{x}"))
    sided = candidates.join(of("a"), "a").join(of("b"), "b")
    fewer = F.col("__a") <= F.col("__b")
    sided = sided.select("a", "b", F.when(fewer, F.col("a")).otherwise(F.col("b")).alias("item"),
                         F.when(fewer, F.col("b")).otherwise(F.col("a")).alias("other"))
    rows = split_join(sided, weighted.select("item", "user", "x"), ["item"]).select("a", "b", "other", "user", "x")
    partner = weighted.select(F.col("item").alias("other"), "user", F.col("x").alias("z"))
    return rows.join(partner, ["other", "user"]).groupBy("a", "b").agg(F.sum(F.col("x") * F.col("z")).alias("weight"))


def similar_pairs(vectors: DataFrame, floor: float, min_weight: float = MIN_WEIGHT) -> DataFrame:
    """(va, vb, weight, weight_a, weight_b, score) of the pairs with a score over ``floor``."""
    weighted, counts = _weighted(vectors, min_weight)
    return _similar(weighted, counts, floor, min_weight)


def _pairs_of(rows: DataFrame, weights: str) -> int:
    """Sum over the users of ``weights``, of their number of rows ``n``."""
    per = rows.groupBy("user").agg(F.count(F.lit(1)).cast("double").alias("n"))
    return int(per.agg(F.sum(F.expr(weights))).first()[0] or 0)


def _similar(weighted: DataFrame, counts: DataFrame, floor: float, min_weight: float) -> DataFrame:
    """Candidates, verified.

    Where the bounds leave most pairs, one pass over all shared clicks sums whole products and keeps those
    of candidates, instead of fetching the vectors of each candidate: the cheaper by the numbers of rows.
    """
    index = stored(prefixes(weighted, floor, min_weight), "simjoin-prefixes")
    each = counts.agg(F.avg("users")).first()[0] or 0.0
    if _pairs_of(weighted, "n * (n - 1) / 2") <= each * _pairs_of(index, "n * (n - 1) / 2"):
        marked = weighted.join(index.select("user", "item", F.lit(True).alias("__in")), ["user", "item"], "left") \
            .select("user", "item", F.when(F.col("__in"), F.col("x")).otherwise(-F.col("x")).alias("x"))
        marked = stored(marked, "simjoin-marked")
        found = pair_sums(group_stripes(marked, ["user"], "item", "x"), marked, "item", least=min_weight, marked=True)
    else:
        found = _verified(group_pairs(index, ["user"], "item").select("a", "b").distinct(), weighted, counts)
    return _scored(found, counts, min_weight).where(F.col("score") > floor)


def bounded_lists(vectors: DataFrame, *, min_weight: float = MIN_WEIGHT, k1: int = LIST_K1, k2: int = LIST_K2,
                  min_keep: int = MIN_KEEP, floor: float = SCORE_FLOOR, clamp_at: float = 1.0) -> DataFrame:
    """CF4 from click vectors: the rows of :func:`coclick.operators.itemcf.neighbour_lists`."""
    # the floor is held against the clamped score
    bar = floor if floor < clamp_at else float("inf")
    weighted, counts = _weighted(vectors, min_weight)
    over = stored(_similar(weighted, counts, floor, min_weight).where(F.col("score") > bar), "simjoin-pairs")
    have = over.select(F.explode(F.array("va", "vb")).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("have"))
    short = counts.select("item").join(have.where(F.col("have") >= min(min_keep, k1, k2)), "item", "left_anti")
    theirs = weighted.join(short, "item", "left_semi").select(F.col("item").alias("s"), "user", "x")
    rest = _scored(_rest(theirs, short, weighted, min_weight), counts, min_weight).join(over, ["va", "vb"], "left_anti")
    return neighbour_lists(over.unionByName(rest), k1=k1, k2=k2, min_keep=min_keep, floor=floor, clamp_at=clamp_at)


def _rest(theirs: DataFrame, short: DataFrame, weighted: DataFrame, min_weight: float) -> DataFrame:
    """(a, b, weight) of all pairs with an item of ``short``; with most items short, out of one pass over all shared clicks."""
    theirs, short = stored(theirs, "simjoin-short"), stored(short, "simjoin-short-items")
    met = theirs.groupBy("user").agg(F.count(F.lit(1)).cast("double").alias("s")) \
        .join(weighted.groupBy("user").agg(F.count(F.lit(1)).alias("n")), "user").agg(F.sum(F.col("s") * F.col("n"))).first()[0] or 0
    if _pairs_of(weighted, "n * (n - 1) / 2") <= met:
        every = stored(pair_sums(group_stripes(weighted.select("user", "item", "x"), ["user"], "item", "x"), weighted, "item",
                                 least=min_weight), "simjoin-every")
        first = every.join(short.select(F.col("item").alias("a")), "a", "left_semi")
        second = every.join(short.select(F.col("item").alias("b")), "b", "left_semi") \
            .join(short.select(F.col("item").alias("a")), "a", "left_anti")
        return first.select("a", "b", "weight").unionByName(second.select("a", "b", "weight"))
    return split_join(theirs, weighted.select("user", "item", F.col("x").alias("z")), ["user"]).where(F.col("s") != F.col("item")) \
        .groupBy("s", "item").agg(F.sum(F.col("x") * F.col("z")).alias("weight")) \
        .select(F.least("s", "item").alias("a"), F.greatest("s", "item").alias("b"), "weight") \
        .groupBy("a", "b").agg(F.max("weight").alias("weight"))
