import math

from pyspark.sql import functions as F

from coclick.functions.ids import item_id_strict
from coclick.operators import itemcf, topk
from support import rows


def clicks(spark, data):
    return spark.createDataFrame(data, "user bigint, item bigint, ts bigint")


F1 = [(1, 10, 1), (1, 20, 2), (1, 10, 3), (2, 20, 1), (2, 10, 2), (3, 30, 1)]


def test_f1_daily_counts(spark):
    d = itemcf.daily_cooccurrence(clicks(spark, F1))
    got = {(r.vi, r.vj): r.weight for r in d.collect()}
    # user 3 has one click: skipped; counts over click occurrences
    assert got == {(10, 10): 3.0, (20, 20): 2.0, (10, 20): 3.0}


def test_f1_threshold_3_leaves_no_pair(spark):
    m = itemcf.merge_counts(itemcf.daily_cooccurrence(clicks(spark, F1)), min_weight=3)
    assert itemcf.cosine_scores(m).count() == 0


def test_f1_threshold_2_clamped(spark):
    m = itemcf.merge_counts(itemcf.daily_cooccurrence(clicks(spark, F1)), min_weight=2)
    s = itemcf.cosine_scores(m).collect()
    assert len(s) == 1 and math.isclose(s[0].score, 3 / math.sqrt(3) / math.sqrt(2))
    lists = itemcf.neighbour_lists(itemcf.cosine_scores(m))
    assert rows(lists, "item", "nbr", "score") == [(10, 20, 1.0), (20, 10, 1.0)]


def test_window_and_cap(spark):
    # one user, items clicked in time order 1,2,3,4; window 1 pairs neighbours only
    data = [(1, i, i) for i in (1, 2, 3, 4)]
    d = itemcf.daily_cooccurrence(clicks(spark, data), window_size=1)
    assert rows(d.where("vj != vi"), "vi", "vj") == [(1, 2), (2, 3), (3, 4)]
    # cap keeps the lowest ids (not the most recent clicks)
    d2 = itemcf.daily_cooccurrence(clicks(spark, [(1, 9, 1), (1, 5, 2), (1, 7, 3)]), max_user_items=2)
    assert rows(d2, "vi", "vj") == [(5, 5), (5, 7), (7, 7)]


def test_window_blocks_do_not_change_result(spark):
    data = [(u, (u * 7 + i * 3) % 23 + 1, i) for u in range(1, 4) for i in range(40)]
    a = itemcf.daily_cooccurrence(clicks(spark, data), window_size=5, block=2048)
    b = itemcf.daily_cooccurrence(clicks(spark, data), window_size=5, block=3)
    assert rows(a) == rows(b)


def test_f10_strict_item_id(spark):
    df = spark.createDataFrame([('{"itemid":12}',), ('{"itemid":"12"}',), ('{"itemid":"1.0"}',), ("{}",),
                                ('{"itemid":-5}',)], "data string")
    assert [r.i for r in df.select(item_id_strict("data").alias("i")).collect()] == [12, 12, 0, 0, 0]


def test_f11_list_floor(spark):
    data = [(1, 100 + i, 1.0 - i * 0.001, 1.0, 1.0, 1.0) for i in range(50)] + \
           [(1, 200 + i, 0.0005, 1.0, 1.0, 1.0) for i in range(10)]
    s = spark.createDataFrame(data, "va bigint, vb bigint, score double, weight double, weight_a double, weight_b double")
    lists = itemcf.neighbour_lists(s).where("item = 1")
    assert lists.count() == 50


def test_f12_group_quota(spark):
    base = 1 << 32
    data = [(1, base * (i + 1) + 5, 1.0 - i * 0.01) for i in range(7)]
    df = spark.createDataFrame(data, "item bigint, nbr bigint, score double")
    out = topk.cap_per_group(df, ["item"], F.col("nbr").bitwiseAND(0xFFFFFFFF), [F.col("score").desc(), "nbr"],
                             per_group=5, total=500)
    assert [r.nbr for r in out.orderBy("rank").collect()] == [base * (i + 1) + 5 for i in range(5)]


def test_lists_symmetric_before_topk(spark):
    data = [(u, (u * 5 + i) % 11 + 1, i) for u in range(1, 6) for i in range(6)]
    m = itemcf.merge_counts(itemcf.daily_cooccurrence(clicks(spark, data)), min_weight=1)
    sym = rows(itemcf.symmetric_pairs(itemcf.cosine_scores(m)), "item", "nbr")
    assert sym == sorted((b, a) for a, b in sym)


def test_day_range_merge_sums_days(spark):
    data = [(1, 1, 1, "2024-01-01"), (1, 2, 2, "2024-01-01"), (1, 1, 1, "2024-01-02"), (1, 2, 2, "2024-01-02"),
            (1, 1, 1, "2024-01-05"), (1, 2, 2, "2024-01-05")]
    df = spark.createDataFrame(data, "user bigint, item bigint, ts bigint, day string") \
        .withColumn("day", F.to_date("day"))
    daily = itemcf.daily_cooccurrence(df, day_col="day")
    m = itemcf.merge_counts(daily, day_col="day", day="2024-01-03", n_days=2, min_weight=0)  # 3 days
    assert {(r.va, r.vb): r.weight for r in m.collect()} == {(1, 1): 2.0, (2, 2): 2.0, (1, 2): 2.0}


def test_cap_cut_inside_a_group(spark):
    # item 5 clicked at ts 1, 2, 3 and item 7 at ts 0; cap 2 keeps the two earliest clicks of item 5
    d = itemcf.daily_cooccurrence(clicks(spark, [(1, 5, 3), (1, 7, 0), (1, 5, 1), (1, 5, 2), (2, 7, 1), (2, 8, 2)]),
                                  max_user_items=2)
    assert rows(d, "vi", "vj", "weight") == [(5, 5, 2.0), (7, 7, 1.0), (7, 8, 1.0), (8, 8, 1.0)]


def test_item_zero_counts_like_any_other(spark):
    d = itemcf.daily_cooccurrence(clicks(spark, [(1, 0, 1), (1, 5, 2), (2, 0, 1), (2, 5, 2)]))
    assert rows(d, "vi", "vj", "weight") == [(0, 0, 2.0), (0, 5, 2.0), (5, 5, 2.0)]


def test_whitelist_before_pairing_equals_whitelist_after(spark):
    data = [(u, (u * 7 + i * 3) % 23, i) for u in range(1, 5) for i in range(40)]
    wl = spark.createDataFrame([(i,) for i in range(0, 23, 2)], "item bigint")
    before = itemcf.merge_counts(itemcf.daily_cooccurrence(clicks(spark, data), window_size=5, whitelist=wl), min_weight=0)
    after = itemcf.merge_counts(itemcf.daily_cooccurrence(clicks(spark, data), window_size=5), whitelist=wl, min_weight=0)
    assert rows(before) == rows(after)
