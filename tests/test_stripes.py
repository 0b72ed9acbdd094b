"""Pair sums from stripes against brute force, and that no row per pair is shuffled."""

import itertools
from collections import defaultdict

import numpy as np
import pytest

from coclick.operators import itemcf, simjoin, skipgram, stripes, swing, usercf


def members(spark, wide=False):
    rng = np.random.default_rng(5)
    big = 1 << 40 if wide else 0
    data = sorted({(g, int(m) - 10 + big * int(m % 2)) for g in range(12) for m in rng.integers(0, 40, 3 + 4 * g)})
    return data, spark.createDataFrame([(g, m, float(1 + (g + m) % 3)) for g, m in data], "g long, m long, x double")


def brute(data, value):
    out = defaultdict(float)
    of = defaultdict(list)
    for g, m in data:
        of[g].append(m)
    for g, ms in of.items():
        for a, b in itertools.combinations(sorted(ms), 2):
            out[a, b] += value(g, a) * value(g, b)
    return dict(out)


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("block", [5, 256])
@pytest.mark.parametrize("piece", [3, 50_000])
def test_pair_sums_equal_brute_force(spark, monkeypatch, wide, block, piece):
    monkeypatch.setattr(stripes, "STRIPES_PER_PIECE", piece)
    data, df = members(spark, wide)
    counts = brute(data, lambda g, m: 1)
    plain = stripes.group_stripes(df, ["g"], "m", block=block)
    assert {(r.a, r.b): r.weight for r in stripes.pair_sums(plain, df, "m").collect()} == counts
    valued = stripes.group_stripes(df, ["g"], "m", "x", block=block)
    sums = {(r.a, r.b): r.weight for r in stripes.pair_sums(valued, df, "m", least=6.0).collect()}
    assert sums == {k: w for k, w in brute(data, lambda g, m: 1 + (g + m) % 3).items() if w >= 6}
    asked = [*list(counts)[::7], (-500, 3), (1, 1 << 50)]
    wanted = stripes.pair_sums(plain, df, "m", asked=spark.createDataFrame(asked, "a long, b long")).collect()
    assert {(r.a, r.b): r.weight for r in wanted} == {k: counts[k] for k in asked if k in counts}
    shared = sorted((r.a, r.b, r.g) for r in stripes.shared_members(plain, df, "m", "g").collect())
    of = defaultdict(set)
    for g, m in data:
        of[g].add(m)
    assert shared == sorted((a, b, g) for (a, b), n in counts.items() if n > 1 for g in of if {a, b} <= of[g])


def test_a_member_goes_on_over_buffers(monkeypatch):
    monkeypatch.setattr(stripes, "ELEMENTS", 4)

    class Batch:
        def __init__(self, a):
            self.a, self.num_rows = np.array(a), len(a)

    def reduce(rows):
        a, at = np.unique(rows[0], return_index=True)
        return a, np.add.reduceat(rows[1], at)

    got = list(stripes._by_member(reduce)(map(Batch, [[1, 1], [1, 1, 1], [1, 2, 2, 2, 2, 3], [], [3]]),
                                          lambda b: (b.a, np.ones(len(b.a), int))))
    assert [tuple(map(int, r)) for part in got for r in zip(*part, strict=True)] == [(1, 6), (2, 4), (3, 2)]


def joined_by(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_one_user_are_never_rows(spark):
    ui = spark.createDataFrame([(u, i) for u in range(40) for i in range(u, u + 12)], "user long, item long")
    plain = swing.item_pair_user_pairs(swing.item_pair_users(ui))
    striped = swing.item_pair_user_pairs(swing.item_pair_users(ui, striped=True), clicks=ui)
    assert sorted(map(tuple, striped.collect())) == sorted(map(tuple, plain.collect()))
    for df in (swing.user_pair_counts(ui), usercf.user_similarity(ui),
               itemcf.daily_cooccurrence(ui.selectExpr("user", "item", "timestamp'2024-01-01' AS ts"))):
        assert "Join" not in joined_by(df) and "MapInArrow" in joined_by(df)


def test_users_past_the_window_and_within(spark):
    clicks = spark.createDataFrame([(u, (i * 7) % 11, i) for u, n in ((1, 30), (2, 6), (3, 5)) for i in range(n)],
                                   "user long, item long, ts long")
    want = defaultdict(float)
    for u in (1, 2, 3):
        of = sorted((r.ts, r.item) for r in clicks.where(f"user = {u}").collect())
        for x, y in itertools.combinations(range(len(of)), 2):
            if y - x <= 5 and of[x][1] != of[y][1]:
                want[tuple(sorted((of[x][1], of[y][1])))] += 1
    got = itemcf.daily_cooccurrence(clicks, window_size=5).where("vi <> vj").collect()
    assert {(r.vi, r.vj): r.weight for r in got} == dict(want)


def test_similar_pairs_by_either_plan(spark, monkeypatch):
    rng = np.random.default_rng(2)
    data = sorted({(int(u), int(i)) for u in range(60) for i in rng.integers(0, 25, 9)})
    v = simjoin.click_vectors(spark.createDataFrame([(u, i, 0) for u, i in data], "user long, item long, ts long"))
    rows = lambda df: sorted(tuple(round(x, 9) for x in r) for r in df.collect())
    lists = lambda: rows(simjoin.bounded_lists(v, k2=10, min_keep=5, floor=0.3))
    monkeypatch.setattr(simjoin, "_pairs_of", lambda df, weights: 0)
    passed, near = rows(simjoin.similar_pairs(v, 0.3)), lists()
    monkeypatch.setattr(simjoin, "_pairs_of", lambda df, weights: 1e18 if "x" in df.columns else 0)
    assert passed and passed == rows(simjoin.similar_pairs(v, 0.3)) and near == lists()


def test_rounds_do_not_grow_with_a_small_vocabulary():
    assert [skipgram._blocks(n, 40) for n in (0, 40, 1000, 6000, 60_000)] == [1, 1, 25, 32, 32]
    assert skipgram._blocks(50_000_000, 40) == 500 and skipgram._blocks(50_000_000, 200_000) == 250
