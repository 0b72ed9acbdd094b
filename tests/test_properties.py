"""Property tests: blocked kernels against brute force on random inputs."""

from collections import Counter
from itertools import combinations

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st
from pyspark.sql import functions as F

from coclick.functions.hashing import balanced_draws
from coclick.operators import pairs

SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

groups = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 30)), min_size=0, max_size=60)


@settings(**SETTINGS)
@given(data=groups, block=st.integers(1, 5))
def test_group_pairs_equal_brute_force(spark, data, block):
    data = sorted(set(data))
    df = spark.createDataFrame(data or [(0, 0)], "g bigint, m bigint")
    if not data:
        df = df.limit(0)
    got = sorted((r.g, r.a, r.b) for r in pairs.group_pairs(df, ["g"], "m", block=block).collect())
    members = {}
    for g, m in data:
        members.setdefault(g, []).append(m)
    want = sorted((g, a, b) for g, ms in members.items() for a, b in combinations(sorted(ms), 2))
    assert got == want


@settings(**SETTINGS)
@given(sizes=st.lists(st.integers(1, 25), min_size=1, max_size=4), window=st.integers(1, 8),
       block=st.integers(1, 6))
def test_window_pairs_equal_brute_force(spark, sizes, window, block):
    data = [(g, pos, n) for g, n in enumerate(sizes) for pos in range(1, n + 1)]
    df = spark.createDataFrame(data, "g bigint, pos bigint, n bigint").withColumn("v", F.col("pos") * 10)
    got = sorted((r.g, r.pos_a, r.pos_b) for r in pairs.window_pairs(df, ["g"], "pos", "n", ["v"], window, block).collect())
    want = sorted((g, a, b) for g, n in enumerate(sizes) for a in range(1, n + 1)
                  for b in range(a + 1, min(n, a + window) + 1))
    assert got == want


@settings(**SETTINGS)
@given(n=st.integers(1, 40), k=st.integers(1, 25))
def test_balanced_draws_shape(spark, n, k):
    df = spark.range(5).select(balanced_draws(F.lit(n), k, "s", F.col("id")).alias("d"))
    for r in df.collect():
        c = Counter(r.d)
        assert len(r.d) == k and all(0 <= x < n for x in r.d)
        # every index k div n or k div n + 1 times; with n > k that is k distinct indices
        counts = [c.get(i, 0) for i in range(n)]
        assert all(v in (k // n, k // n + 1) for v in counts)
        assert sum(v == k // n + 1 for v in counts) == k % n
