"""Exact selection against numpy, prefixes and longest matches, variant ids."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from coclick.functions.ids import item_id_cast, item_id_strict, parsed_payload, variant_id_cast, variant_id_strict
from coclick.operators import lookup, selection
from support import rows

PROBS = [0.0, 0.01, 0.25, 1 / 3, 0.5, 0.9, 0.999, 1.0]


@pytest.mark.parametrize("values", [
    np.random.default_rng(1).normal(size=5000).tolist(),
    [7.25] * 1700 + np.random.default_rng(2).exponential(size=3300).tolist(),      # one value on a third of the rows
    [-1e308, 1e308, 0.0, 5e-324, -5e-324, 1.0, 1.0 + 2 ** -52] * 9,
    (np.random.default_rng(4).integers(0, 3, 2000) * 1.0).tolist(), [4.0], [1.0, 2.0]])
@pytest.mark.parametrize("few", [2, 4096])
def test_quantiles_equal_numpy(spark, values, few):
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    got = {r["probability"]: r["value"] for r in selection.quantiles(df, "v", PROBS, buckets=16, few=few).collect()}
    order = sorted(values)
    for p in PROBS:
        x = p * (len(order) - 1)
        a, b = order[int(np.floor(x))], order[int(np.ceil(x))]
        assert got[p] == a + (b - a) * (x - np.floor(x))


def test_no_values(spark):
    assert selection.quantiles(spark.createDataFrame([(None,)], "v double"), "v", [0.5]).collect() == []


def test_prefixes_and_longest_matches(spark):
    d = spark.createDataFrame([("car",), ("card",), ("care",), ("dog",), ("car",), ("",), (None,)], "word string")
    p = spark.createDataFrame([("car",), ("ca",), ("cards",), ("d",), ("x",), ("",), (None,)], "word string")
    assert rows(lookup.prefix_counts(p, d)) == [("ca", 3), ("car", 3), ("cards", 0), ("d", 1), ("x", 0)]
    w = spark.createDataFrame([("cards",), ("carbon",), ("ca",), ("dogs",), ("dogs",), (None,), ("",)], "word string")
    assert rows(lookup.longest_matches(w, d)) == [("carbon", "car"), ("cards", "card"), ("dogs", "dog")]


def test_variant_ids_equal_text_ids(spark):
    payloads = ['{"itemid":12}', '{"itemid":"12"}', '{"itemid":"1.0"}', "{}", '{"itemid":-5}', '{"itemid":null}', "", None,
                '{"itemid":99999999999999999999}', '{"itemid":true}', '{"itemid":"0012"}', "broken", '{"a":{"itemid":3}}']
    df = spark.createDataFrame([(p,) for p in payloads], "p string").withColumn("v", parsed_payload("p"))
    out = df.select(item_id_strict("p").alias("a"), variant_id_strict("v").alias("b"), item_id_cast("p").alias("c"),
                    variant_id_cast("v").alias("d")).collect()
    assert [(r["a"], r["c"]) for r in out] == [(r["b"], r["d"]) for r in out]
