"""Swing item-item similarity (SW1-SW9) and the list-length profile (AG7).

score(i, j) = sum over user pairs u < v who both clicked i and j of
              w_u * w_v / (alpha + c_uv)
with w_u = 1 / sqrt(#distinct items of u) and c_uv the number of same-day
items u and v share (items with 2..1000 users only).  A user pair without a
c_uv row is dropped (inner join), as in the reference ("approx1").

Plan notes: pairs travel as stripes (:mod:`coclick.operators.stripes`), so a pair that
only one user has is never a row; the item-pair paths are filtered by the whitelist and reduced to
pairs with at least two users *before* the user pairs are generated, which
Catalyst would not do by itself; every pair generation is a blocked equi-join
(:func:`coclick.operators.pairs.group_pairs`).  User weights ride along with the
clicks, so the paths -- the largest table -- are joined once, with the user-pair
counts; user pairs that share very many items are split there by their size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coclick.operators.pairs import DEFAULT_BLOCK, group_pairs, symmetrise
from coclick.operators.stripes import STRIPE, group_stripes, integral, pair_sums, shared_members
from coclick.operators.skew import heavy_from_sizes, split_join
from coclick.operators.topk import rank_key, top_k_by_key
from coclick.session import stored
from coclick.sources.clicks import latest_partition
from coclick.functions.text import score_pairs_text

# Fixed values of the reference's Swing job.
MIN_ITEM_USERS = 2      # items need at least 2 users to give user pairs
MAX_ITEM_USERS = 1000   # ... and at most 1000
ALPHA = 1.0             # smoothing in 1 / (alpha + c_uv)
LIST_K = 200            # list length
CASE_K = 100            # neighbours in the case report
PATHS_PER_PIECE = 1_000_000   # paths of one user pair that meet its count in one task


def user_item(clicks: DataFrame, user_col: str = "user", item_col: str = "item",
              day_col: str | None = None) -> DataFrame:
    """SW1: (day,) user, item rows with a non-null item."""
    keys = [day_col] if day_col else []
    return clicks.where(F.col(item_col).isNotNull()).select(
        *keys, F.col(user_col).alias("user"), F.col(item_col).cast("bigint").alias("item"))


def item_pair_users(ui: DataFrame, day_col: str | None = None, block: int = DEFAULT_BLOCK,
                    assume_distinct: bool = False, striped: bool = False) -> DataFrame:
    """SW2: per (day,) user with >= 2 distinct items, every item pair i < j -> (itemi, itemj, user).

    A ``user_weight`` column of ``ui`` (a function of the user) rides along.  With ``striped`` a
    row holds the pairs of one ``itemi`` and user, ``itemjs`` being an array of items: what
    :func:`item_pair_user_pairs` takes without shuffling a row per pair.
    """
    keys = [day_col] if day_col else []
    carry = [c for c in ("user_weight",) if c in ui.columns]
    d = ui.select(*keys, "user", "item", *carry)
    d = d if assume_distinct else d.distinct()
    if striped and integral(d, "user", "item"):
        d = d if assume_distinct else stored(d, "swing-distinct")
        return group_stripes(d, [*keys, "user", *carry], "item", block=min(block, STRIPE)) \
            .select(*keys, F.col("a").alias("itemi"), F.col("bs").alias("itemjs"), "user", *carry)
    p = group_pairs(d, [*keys, "user"], "item", min_size=2, block=block, carry=carry)
    return p.select(*keys, F.col("a").alias("itemi"), F.col("b").alias("itemj"), "user",
                    *[F.col(f"{c}_a").alias(c) for c in carry])


def user_pair_counts(ui: DataFrame, day_col: str | None = None, min_users: int = MIN_ITEM_USERS,
                     max_users: int | None = MAX_ITEM_USERS, block: int = DEFAULT_BLOCK,
                     assume_distinct: bool = False, asked: DataFrame | None = None) -> DataFrame:
    """SW3: per (day, item) with min..max distinct users, count each user pair;
    summed over days -> (ui, uj, weight bigint).  ``asked(ui, uj)`` names the only pairs that are needed."""
    keys = [day_col] if day_col else []
    d = ui.select(*keys, "item", "user")
    d = d if assume_distinct else d.distinct()
    if integral(d, "user"):
        d = d if assume_distinct else stored(d, "swing-distinct")
        stripes = group_stripes(d, [*keys, "item"], "user", min_size=min_users, max_size=max_users, block=min(block, STRIPE))
        wanted = None if asked is None else asked.select(F.col("ui").alias("a"), F.col("uj").alias("b"))
        return pair_sums(stripes, d, "user", asked=wanted).select(F.col("a").alias("ui"), F.col("b").alias("uj"), "weight")
    p = group_pairs(d, [*keys, "item"], "user", min_size=min_users, max_size=max_users, block=block)
    return p.groupBy(F.col("a").alias("ui"), F.col("b").alias("uj")).agg(F.count(F.lit(1)).alias("weight"))


def user_weights(ui: DataFrame, assume_distinct: bool = False) -> DataFrame:
    """SW4 / AG5: (user, weight = 1 / sqrt(#distinct items over all days))."""
    d = ui.select("user", "item")
    d = d if assume_distinct else d.distinct()
    return d.groupBy("user").agg((F.lit(1.0) / F.sqrt(F.count(F.lit(1)))).alias("weight"))


def item_pair_user_pairs(ipu: DataFrame, whitelist: DataFrame | None = None,
                         block: int = DEFAULT_BLOCK, dedupe: bool = True, clicks: DataFrame | None = None) -> DataFrame:
    """SW5: users of each item pair, over all days; all user pairs ui < uj.

    With ``whitelist`` both items are filtered first (same result as the
    reference's later filter, far fewer paths).  Pairs with one user give
    nothing and are dropped by the size filter before the join.  ``dedupe``
    removes repeats of (pair, user) across days; a single-window input is
    already distinct and can skip that shuffle.  A ``user_weight`` column gives
    each path its two users' weights ``uiw``, ``ujw``.  Striped rows
    (:func:`item_pair_users`) are read by item; ``clicks(item)`` names their hot items.
    """
    carry = [c for c in ("user_weight",) if c in ipu.columns]
    if "itemjs" in ipu.columns:
        # pairs of one user go no further; repeats across days are removed on the way
        # the task that has all users of an item pair pairs them, too, if they are few
        stripes = ipu.withColumnsRenamed({"itemi": "a", "itemjs": "bs"})
        met = stored(shared_members(stripes, stripes if clicks is None else clicks, "a" if clicks is None else "item", "user", *carry, paired=block)
                     .withColumnsRenamed({"a": "itemi", "b": "itemj"}), "swing-shared")
        paths = met.where("user_b is not null").select("itemi", "itemj", F.col("user").alias("ui"), F.col("user_b").alias("uj"), *[
            F.col(c).alias(n) for c, n in (("user_weight", "uiw"), ("user_weight_b", "ujw")) if carry])
        many = met.where("user_b is null")
        if not many.isEmpty():
            paths = paths.unionByName(item_pair_user_pairs(many.select("itemi", "itemj", "user", *carry), block=block, dedupe=False))
        if whitelist is None:
            return paths
        wl = whitelist.select(F.col("item").alias("__w"))
        return paths.join(wl, F.col("itemi") == F.col("__w"), "left_semi").join(wl, F.col("itemj") == F.col("__w"), "left_semi")
    d = ipu.select("itemi", "itemj", "user", *carry)
    if whitelist is not None:
        wl = whitelist.select(F.col("item").alias("__w"))
        d = d.join(wl, F.col("itemi") == F.col("__w"), "left_semi") \
            .join(wl, F.col("itemj") == F.col("__w"), "left_semi")
    if dedupe:
        d = d.distinct()
    p = group_pairs(d, ["itemi", "itemj"], "user", min_size=2, block=block, carry=carry)
    weights = [F.col(f"user_weight_{x}").alias(n) for x, n in (("a", "uiw"), ("b", "ujw"))] if carry else []
    return p.select("itemi", "itemj", F.col("a").alias("ui"), F.col("b").alias("uj"), *weights)


def swing_scores(paths: DataFrame, u2u: DataFrame, uweights: DataFrame | None = None,
                 whitelist: DataFrame | None = None, alpha: float = ALPHA,
                 heavy: dict[int, int] | None = None) -> DataFrame:
    """SW6: (itemi, itemj, swing_score), both directions.

    ``uweights`` is needed unless the paths carry ``uiw`` and ``ujw``; ``heavy``
    are the pieces of the user pairs with very many paths (:func:`heavy_from_sizes`).
    """
    if whitelist is not None:
        wl = whitelist.select(F.col("item").alias("__w"))
        paths = paths.join(wl, F.col("itemi") == F.col("__w"), "left_semi") \
            .join(wl, F.col("itemj") == F.col("__w"), "left_semi")
    # paths meet their user-pair counts first (paths are far fewer than user
    # pairs), then pick up the two user weights; same inner-join result.
    p = split_join(paths, u2u.select("ui", "uj", "weight"), ["ui", "uj"], split_right=False, heavy_left=heavy or {})
    if not {"uiw", "ujw"} <= set(paths.columns):
        uw = uweights.select("user", F.col("weight").alias("__uw"))
        p = p.join(uw.select(F.col("user").alias("ui"), F.col("__uw").alias("uiw")), "ui") \
            .join(uw.select(F.col("user").alias("uj"), F.col("__uw").alias("ujw")), "uj")
    per_path = p.select("itemi", "itemj", (F.col("uiw") * F.col("ujw") / (F.lit(alpha) + F.col("weight"))).alias("s"))
    one_way = per_path.groupBy("itemi", "itemj").agg(F.sum("s").alias("swing_score"))
    return symmetrise(one_way, ["itemi"], ["itemj"], ["itemi"], ["itemj"], keep=["swing_score"])


def swing_from_clicks(ui: DataFrame, whitelist: DataFrame | None = None, day_col: str | None = None,
                      alpha: float = ALPHA, assume_distinct: bool = False) -> DataFrame:
    """SW1..SW6 end to end from (day,) user, item rows.

    Paths only involve whitelisted items, so item pairs are generated from the
    whitelisted clicks alone (exactly the same paths, a fraction of the pairs);
    user weights and user-pair counts still see every item.
    """
    keys = [day_col] if day_col else []
    # three branches read the deduplicated clicks, with their users' weights: written once
    ud = ui.select(*keys, "user", "item")
    ud = ud if assume_distinct else ud.distinct()
    weights = user_weights(ud, assume_distinct=day_col is None)
    ud = stored(split_join(ud, weights.withColumnRenamed("weight", "user_weight"), ["user"], split_right=False),
                "swing-clicks")
    pair_src = ud if whitelist is None else ud.join(whitelist.select("item"), "item", "left_semi")
    ipu = item_pair_users(pair_src, day_col, assume_distinct=True, striped=True)
    paths = item_pair_user_pairs(ipu, dedupe=day_col is not None, clicks=pair_src)
    if integral(ud, "user", "item"):
        # only the user pairs of the (written) paths are counted
        u2u = user_pair_counts(ud, day_col, assume_distinct=True, asked=paths)
    else:
        u2u = user_pair_counts(ud, day_col, assume_distinct=True)
    # two users share at most the items of the smaller: only then can a pair have too many paths for a task
    most = ud.agg(F.min("user_weight")).first()[0]
    heavy = {}
    if most and (1 / most ** 2) ** 2 / 2 > PATHS_PER_PIECE:
        u2u = stored(u2u, "swing-user-pairs")
        heavy = heavy_from_sizes(u2u.withColumn("paths", (F.col("weight") * (F.col("weight") - 1) / 2).cast("bigint")),
                                 ["ui", "uj"], "paths", PATHS_PER_PIECE)
    return swing_scores(paths, u2u, alpha=alpha, heavy=heavy)


def swing_lists(scores: DataFrame, k: int = LIST_K, score_col: str = "swing_score") -> DataFrame:
    """SW7 / WN6: per itemi the top ``k`` by score desc (ties: itemj) -> itemi, rank, itemj, score."""
    return top_k_by_key(scores, ["itemi"], [rank_key(score_col), "itemj"], k) \
        .select("itemi", "rank", "itemj", F.col(score_col).alias("swing_score"))


def swing_text(lists: DataFrame, fmt: str | None = None) -> DataFrame:
    """SNK6: ``itemi<TAB>itemj:score;...``; ``fmt=None`` prints the raw double."""
    arr = lists.groupBy("itemi").agg(F.array_sort(F.collect_list(
        F.struct("rank", F.col("itemj").alias("item"), F.col("swing_score").alias("score")))).alias("items"))
    return arr.select("itemi", F.concat(F.col("itemi").cast("string"), F.lit("\t"),
                                        score_pairs_text("items", ";", fmt)).alias("line"))


def reweighted_scores(scores: DataFrame, features: DataFrame, country: str, feature_col: str = "ctcvr30",
                      date_col: str = "dt", country_col: str = "country") -> DataFrame:
    """SW8: score x feature of the *target* item, from the newest snapshot of the country."""
    f = latest_partition(features.where(F.col(country_col) == country), date_col) \
        .select(F.col("itemid").alias("itemj"), F.col(feature_col).alias("__f"))
    return scores.join(f, "itemj").select("itemi", "itemj", (F.col("__f") * F.col("swing_score")).alias("swing_score"))


def case_report(scores: DataFrame, shops: DataFrame, k: int = CASE_K) -> DataFrame:
    """SW9 / SNK7: ``shop:item`` key then up to k ``shop:item`` neighbours (score desc, id).

    Rows (shopi_itemi, line) with line = key + ' ' + neighbours joined by ' '.
    """
    s = shops.select("item_id", "shop_id")
    j = scores.join(s.select(F.col("item_id").alias("itemi"), F.col("shop_id").alias("shop_i")), "itemi") \
        .join(s.select(F.col("item_id").alias("itemj"), F.col("shop_id").alias("shop_j")), "itemj")
    j = j.select(F.concat_ws(":", F.col("shop_i").cast("string"), F.col("itemi").cast("string")).alias("shopi_itemi"),
                 F.concat_ws(":", F.col("shop_j").cast("string"), F.col("itemj").cast("string")).alias("shopj_itemj"),
                 "itemj", "swing_score")
    top = top_k_by_key(j, ["shopi_itemi"], [rank_key("swing_score"), "itemj"], k)
    arr = top.groupBy("shopi_itemi").agg(F.array_sort(F.collect_list(F.struct("rank", "shopj_itemj"))).alias("l"))
    return arr.select("shopi_itemi", F.concat_ws(" ", F.col("shopi_itemi"),
                                                 F.array_join(F.transform("l", lambda x: x["shopj_itemj"]), " "))
                      .alias("line"))


PROFILE_QUANTILES = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]


def length_profile(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """AG7: number of lists, mean length and exact length percentiles .1-.9
    of ``key<TAB>a;b;c`` lines."""
    n = F.size(F.split(F.split(F.col(line_col), "\t").getItem(1), ";")).alias("length")
    d = lines.select(n)
    pct = F.percentile(F.col("length"), PROFILE_QUANTILES)
    agg = d.agg(F.count("length").alias("key_size"), F.avg("length").alias("avg_length"), pct.alias("__p"))
    return agg.select("key_size", "avg_length",
                      *[F.col("__p")[i].alias(f"per{int(q * 100)}") for i, q in enumerate(PROFILE_QUANTILES)])
