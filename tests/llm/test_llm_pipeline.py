"""The pipeline stage by stage, and the registered queries."""
from collections import Counter

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from coclick.llm import catalog, linededup, ordinal, packing, toxicity

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted({int(n[2:].split("_")[0]) for n in names}) == list(range(1, 14)) and len(names) == 13
    assert "pipeline" in E.queries() and [n for n, _ in P.STAGES] == ["quality", "line_dedup", "near_dedup", "mix", "pack"]


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(catalog.ORACLE[name]).df()
    got = catalog.QUERIES[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    by = sorted(got.columns)
    pd.testing.assert_frame_equal(got[by].sort_values(by).reset_index(drop=True),
                                  want[by].sort_values(by).reset_index(drop=True), check_dtype=False)


def test_stages_take_effect(spark, documents):
    docs, seen = documents, {}
    for name, stage in P.STAGES:
        seen[name] = docs
        docs = stage(spark, docs, SF)
        if name != "pack":
            assert docs.dtypes == documents.dtypes
            docs = spark.createDataFrame(docs.collect(), documents.schema)
    ids = lambda d: sorted(r["doc_id"] for r in d.select("doc_id").collect())
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = ordinal.rate_documents(documents, labels).where("kept")
    assert ids(seen["line_dedup"]) == ids(kept) != ids(documents)
    assert ids(seen["near_dedup"]) == ids(seen["line_dedup"])
    text = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(seen["line_dedup"]).collect()}
    assert {r["doc_id"]: r["text"] for r in seen["near_dedup"].collect()} == text
    assert len(ids(seen["mix"])) == len(set(ids(seen["mix"]))) < len(text)
    assert set(ids(seen["pack"])) <= set(ids(seen["mix"]))
    assert sum(r["length"] for r in docs.collect()) == \
        sum(r["length"] for r in packing.pieces(seen["pack"]).collect())
    whole = P.run(spark, SF)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, docs.collect()))


def test_stages_take_messy_tables(spark, messy, nothing):
    rows = Counter(map(str, messy.collect()))
    for name, stage in P.STAGES:
        assert stage(spark, nothing, SF).count() == 0
        out = stage(spark, messy, SF)
        if name == "pack":
            # every row is packed, whole
            assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in messy.collect()}
            assert out.where("start = 0").count() == messy.count()
            continue
        assert out.columns == messy.columns
        got = Counter(map(str, out.collect()))
        if name == "line_dedup":
            assert sum(got.values()) == messy.count()
        elif name == "mix":
            assert set(got) <= set(rows)
        else:
            # rows as they were, none twice as often as before
            assert got and not got - rows


def test_models_do_not_read_other_columns(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    other = documents.selectExpr("doc_id", "text", "'zz' lang", "'zz' source", "0L n_chars")
    pick = lambda d: sorted(map(tuple, toxicity.toxicity_scores(d, labels).collect()))
    assert pick(documents) == pick(other)
