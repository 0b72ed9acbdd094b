import math

from coclick.operators import pairs, swing
from support import rows


def ui(spark, data, day=False):
    if day:
        return spark.createDataFrame(data, "day int, user bigint, item bigint")
    return spark.createDataFrame(data, "user bigint, item bigint")


def test_f2_swing_one_day(spark):
    d = ui(spark, [(1, 10), (1, 20), (2, 10), (2, 20), (3, 10), (3, 30)])
    u2u = {(r.ui, r.uj): r.weight for r in swing.user_pair_counts(d).collect()}
    assert u2u == {(1, 2): 2, (1, 3): 1, (2, 3): 1}
    s = {(r.itemi, r.itemj): r.swing_score for r in swing.swing_from_clicks(d).collect()}
    w = 1 / math.sqrt(2)
    assert set(s) == {(10, 20), (20, 10)}
    assert math.isclose(s[(10, 20)], w * w / 3) and math.isclose(s[(20, 10)], w * w / 3)


def test_f3_cross_day_pair_dropped(spark):
    d = ui(spark, [(1, 1, 10), (1, 1, 20), (2, 2, 10), (2, 2, 20)], day=True)
    assert swing.item_pair_user_pairs(swing.item_pair_users(d, "day")).count() == 1
    assert swing.swing_from_clicks(d, day_col="day").count() == 0


def test_item_user_cap(spark):
    d = ui(spark, [(u, 10) for u in range(1, 6)])
    assert swing.user_pair_counts(d, max_users=4).count() == 0
    assert swing.user_pair_counts(d, max_users=5).count() == 10


def test_salted_pairs_equal_plain(spark):
    data = [(g, m) for g in range(3) for m in range(g * 7, g * 7 + 9 + g)]
    df = spark.createDataFrame(data, "g bigint, m bigint")
    plain = rows(pairs.group_pairs(df, ["g"], "m", block=10_000))
    salted = rows(pairs.group_pairs(df, ["g"], "m", block=2))
    assert plain == salted
    n = [9, 10, 11]
    assert len(plain) == sum(k * (k - 1) // 2 for k in n)


def test_scores_positive(spark):
    data = [(u, (u * 3 + i) % 7) for u in range(12) for i in range(4)]
    s = swing.swing_from_clicks(ui(spark, data))
    assert s.where("swing_score <= 0").count() == 0


def test_length_profile(spark):
    lines = spark.createDataFrame([("1\ta;b",), ("2\ta",), ("3\ta;b;c;d",)], "line string")
    r = swing.length_profile(lines).collect()[0]
    assert r.key_size == 3 and math.isclose(r.avg_length, 7 / 3) and math.isclose(r.per50, 2.0)


def test_users_are_paired_where_they_meet(spark):
    import random
    random.seed(3)
    data = sorted({(u, random.randint(1, 9)) for u in range(40) for _ in range(6)})
    clicks = ui(spark, data)
    striped = swing.item_pair_users(clicks, striped=True)
    of = {u: {i for v, i in data if v == u} for u in range(40)}
    want = sorted((i, j, u, v) for u in of for v in of if u < v for i in of[u] & of[v] for j in of[u] & of[v] if i < j)
    for block in (2048, 12, 2):                    # no pair, some pairs, almost all pairs of items with more users than a block
        out = swing.item_pair_user_pairs(striped, block=block, clicks=clicks)
        assert rows(out, "itemi", "itemj", "ui", "uj") == want
        assert ("Join" in out._jdf.queryExecution().toString()) == (block < 2048)
    listed = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "item bigint")
    out = swing.item_pair_user_pairs(striped, whitelist=listed, clicks=clicks)
    assert rows(out, "itemi", "itemj", "ui", "uj") == [r for r in want if r[1] <= 4]


def test_two_by_two_holds_few_pairs_at_a_time(monkeypatch):
    import numpy as np
    from coclick.operators import stripes
    monkeypatch.setattr(stripes, "ELEMENTS", 10)
    a, b, g = (np.array(x) for x in zip(*[(p, p + 1, u) for p, n in ((1, 5), (2, 2), (3, 30), (4, 7)) for u in range(n)], strict=True))
    parts = list(stripes._two_by_two(a, b, g, g * 0.5, 10))
    assert sum(len(p[0]) for p in parts) == 30 + 10 + 1 + 21 and max(len(p[0]) for p in parts[1:]) <= 10 + 6
    pairs_ = sorted((int(x), int(u), int(v), float(d)) for p in parts[1:] for x, u, v, d in zip(p[0], p[2], p[4], p[5]))
    assert pairs_ == [(x, u, v, v * 0.5) for x, n in ((1, 5), (2, 2), (4, 7)) for u in range(n) for v in range(u + 1, n)]
