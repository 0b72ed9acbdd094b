"""Registered queries of the text-corpus operators; each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coclick.llm import (
    extract,
    fingerprint,
    linededup,
    mixing,
    neardup,
    ordinal,
    packing,
    perplexity,
    prefixtrie,
    repeats,
    search,
    tokenfile,
    toxicity,
)
from coclick.llm.store import table


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_probe(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.quality_rules(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_pages(table(spark, sf_dir, "pages"))


def op6_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal.rate_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.read_token_files(tokenfile.write_token_files(table(spark, sf_dir, "documents")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op13_nra_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_order_minhash, op2_toxicity, op3_line_dedup, op4_quality_rules, op5_html_extraction, op6_ordinal_quality,
        op7_circulant_minhash, op8_poisson_mixing, op9_best_fit_packing, op10_token_files, op11_prefix_trie,
        op12_suffix_dedup, op13_nra_search)
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE: dict[str, str] = {
    "op3_line_dedup": f"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (
    SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split),
keyed AS (
    SELECT doc_id, line, pos, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        '{_UPPER}', '{_LOWER}') AS key FROM line),
repeated AS (
    SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= {linededup.LEAST_CHARS}
    GROUP BY key HAVING count(DISTINCT doc_id) >= {linededup.LEAST_DOCS}),
marked AS (
    SELECT k.doc_id, k.line, k.pos, coalesce(r.last_doc <> k.doc_id, false) AS gone
    FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INTEGER)) AS BIGINT) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op8_poisson_mixing": mixing.SQL,
    "op11_prefix_trie": prefixtrie.SQL,
    "op12_suffix_dedup": repeats.SQL,
    "op13_nra_search": search.SQL,
}
