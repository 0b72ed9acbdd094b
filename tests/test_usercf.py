import itertools
import math
from collections import Counter

import pyarrow as pa
import pytest

from coclick.operators import overlap, usercf
from support import rows


def test_f14_hit_ratio(spark):
    labels = spark.createDataFrame([(1, i) for i in (1, 2, 3, 4)], "user bigint, item bigint")
    preds = spark.createDataFrame([(1, 2), (1, 4), (1, 9), (2, 1)], "user bigint, item bigint")
    assert rows(usercf.hit_ratio(labels, preds), "user", "score") == [(1, 0.5)]


def test_f17_user_cf_repeats_count(spark):
    sim = spark.createDataFrame([(1, 2, 0.5)], "u1 bigint, u2 bigint, score double")
    hist = spark.createDataFrame([(2, 1, 10, 1.0), (2, 2, 20, 1.0), (2, 3, 10, 1.0)],
                                 "user bigint, rank bigint, item bigint, weight double")
    recs = usercf.user_cf_recommend(sim, hist)
    assert rows(recs, "user", "rank", "item", "value") == [(1, 1, 10, 1.0), (1, 2, 20, 0.5)]


def test_history_most_recent_first(spark):
    clicks = spark.createDataFrame([(1, 5, 1), (1, 6, 3), (1, 7, 2), (1, 0, 4)], "user bigint, item bigint, ts bigint")
    h = usercf.user_histories(clicks, cap=2)
    assert rows(h, "rank", "item") == [(1, 6), (2, 7)]


def test_user_similarity_cosine(spark):
    ui = spark.createDataFrame([(1, 10), (1, 20), (2, 10), (3, 30)], "user bigint, item bigint")
    s = {(r.u1, r.u2): r.score for r in usercf.user_similarity(ui).collect()}
    assert set(s) == {(1, 2), (2, 1)} and math.isclose(s[(1, 2)], 1 / math.sqrt(2))


def test_recommendation_without_user_pairs_is_the_same(spark):
    data = [(u, r, (u * u * 3 + r * 5) % 17, 1.0) for u in range(1, 15) for r in range(1, 2 + u % 6)]
    hist = spark.createDataFrame(data, "user bigint, rank bigint, item bigint, weight double")
    a = usercf.user_cf_recommend(usercf.user_similarity(hist), hist)
    b = usercf.recommend_from_histories(hist)
    assert [(r[:3], round(r[3], 9)) for r in rows(a)] == [(r[:3], round(r[3], 9)) for r in rows(b)]


def user_items():
    """31 users of 1 to 9 items, some alone, ids of both signs: (user, item) and (a, b, common, of a, of b)."""
    data = sorted({(u * (-1) ** u * (1 << 33), (u * u * 7 + i * 3) % (4 + 2 * u)) for u in range(31) for i in range(1 + u % 9)})
    own = Counter(u for u, _ in data)
    of = {u: {i for x, i in data if x == u} for u in own}
    return data, own, sorted((a, b, len(of[a] & of[b]), own[a], own[b]) for a, b in itertools.combinations(sorted(own), 2)
                             if of[a] & of[b])


@pytest.mark.parametrize("blocks", [1, 4])
def test_overlaps_equal_brute_force(spark, blocks):
    data, own, want = user_items()
    members = spark.createDataFrame([(u, i, own[u]) for u, i in data] + [(None, 1, 1), (5, None, 1)], "user long, item long, n long")
    assert sorted(map(tuple, overlap.pair_overlaps(members, "item", "user", "n", blocks).collect())) == want


@pytest.mark.parametrize("elements", [1, 9, 2_000_000])
@pytest.mark.parametrize("batch", [1, 3, 1000])
def test_overlaps_over_buffers(monkeypatch, elements, batch):
    monkeypatch.setattr(overlap, "ELEMENTS", elements)
    data, own, want = user_items()
    sent = []
    for u in own:
        items = [i for x, i in data if x == u]
        for other, piece in itertools.product(range(3), range(0, len(items), 2)):
            mine = u % 3
            sent.append((min(mine, other), max(mine, other), int(mine > other), u, own[u], items[piece:piece + 2]))
    sent.sort()
    columns = [pa.array(c, t) for c, t in zip(zip(*sent, strict=True), (pa.int32(),) * 3 + (pa.int64(),) * 2 + (pa.list_(pa.int64()),),
                                              strict=True)]
    table = pa.table(columns, names=["i", "j", "kind", "member", "value", "groups"])
    got = [r for b in overlap._met(iter(table.to_batches(max_chunksize=batch))) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert sorted(got) == want


def test_users_of_popular_items_meet_as_wholes(spark, monkeypatch):
    dense = spark.createDataFrame([(u, i) for u in range(120) for i in range(u % 5, 12, 2)], "user long, item long")
    sparse = spark.createDataFrame([(u, u // 2) for u in range(120)], "user long, item long")
    of = lambda df: sorted(map(tuple, df.collect()))
    with monkeypatch.context() as m:
        m.setattr(usercf, "blocks_of", lambda *a: 0)
        want = of(usercf.user_similarity(dense))
    assert overlap.blocks_of(dense, "item", "user") and overlap.blocks_of(sparse, "item", "user") == 0
    monkeypatch.setattr(usercf, "group_stripes", None)
    assert of(usercf.user_similarity(dense)) == want
