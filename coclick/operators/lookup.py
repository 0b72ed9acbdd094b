"""Dictionary lookups (DC1): the reference's Trie insert / search as joins against the
distinct dictionary -- exact words, prefixes and longest matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coclick.operators.skew import split_join

#: Largest dictionary that is sent to all tasks.
BROADCAST_BYTES = 64 << 20
TOKEN_PATTERN = "[ \\t\\n\\r]+"


def tokens(docs: DataFrame, id_col: str, text_col: str, pattern: str = TOKEN_PATTERN) -> DataFrame:
    """Whole texts split on whitespace -> (id, pos, word); empty tokens dropped."""
    return docs.select(F.col(id_col).alias("id"), F.posexplode(F.split(F.col(text_col), pattern)).alias("pos", "word")) \
        .where(F.length("word") > 0)


def dictionary_match(words: DataFrame, dictionary: DataFrame, word_col: str = "word",
                     dict_col: str = "word") -> DataFrame:
    """Rows of ``words`` whose word is in the dictionary (exact, case-sensitive)."""
    d = dictionary.select(F.col(dict_col).alias(word_col)).distinct()
    return words.join(d, word_col, "left_semi")


def _beginnings(df: DataFrame, word_col: str, least: int = 1) -> DataFrame:
    """One row per non-empty beginning of each word: (all columns, begin)."""
    return df.where(F.length(word_col) >= least).withColumn("begin", F.explode(F.transform(
        F.sequence(F.lit(least), F.length(word_col)), lambda n: F.substring(F.col(word_col), F.lit(1), n))))


def prefix_counts(prefixes: DataFrame, dictionary: DataFrame, prefix_col: str = "word", dict_col: str = "word") -> DataFrame:
    """Prefix search: for each distinct prefix, how many dictionary words begin with it (0: none) -> (prefix, n_words).

    Dictionary words meet the prefixes as rows (beginning, word); beginnings
    that many words share are counted before the join, so no beginning is hot.
    """
    counts = _beginnings(dictionary.select(F.col(dict_col).alias("w")).distinct(), "w").groupBy("begin").agg(F.count("*").alias("n"))
    asked = prefixes.select(F.col(prefix_col).alias("prefix")).where(F.length("prefix") > 0).distinct()
    return asked.join(counts.withColumnRenamed("begin", "prefix"), "prefix", "left") \
        .select("prefix", F.coalesce("n", F.lit(0).cast("long")).alias("n_words"))


def longest_matches(words: DataFrame, dictionary: DataFrame, word_col: str = "word", dict_col: str = "word") -> DataFrame:
    """For each distinct word the longest dictionary word that it begins with -> (word, match); words with none are left out."""
    d = dictionary.select(F.col(dict_col).alias("begin")).distinct()
    begun = _beginnings(words.select(F.col(word_col).alias("word")).distinct(), "word")
    # a beginning that very many words share is split
    return split_join(begun, d, ["begin"], split_right=False).groupBy("word") \
        .agg(F.max_by("begin", F.length("begin")).alias("match"))


def match_counts(docs: DataFrame, dict_docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 dict_text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per document: number of tokens and number found in the dictionary
    built from the tokens of ``dict_docs``.  Returns (doc_id, n_words, n_matched).

    The token stream meets the distinct dictionary and is summed per document
    inside each task.  Dictionaries of at most ``broadcast_bytes`` travel to the
    tokens; for larger ones each document's distinct words travel, with their counts.
    """
    t = tokens(docs, id_col, text_col)
    dwords = dict_docs.select(F.explode(F.split(F.col(dict_text_col), TOKEN_PATTERN)).alias("word")) \
        .where(F.length("word") > 0).distinct().withColumn("known", F.lit(1))
    size = dwords.agg(F.coalesce(F.sum(F.octet_length("word") + 64), F.lit(0))).first()[0]
    if size <= broadcast_bytes:
        counted = t.select("id", "word", F.lit(1).alias("n")).join(F.broadcast(dwords), "word", "left")
    else:
        counted = split_join(t.groupBy("id", "word").agg(F.count(F.lit(1)).alias("n")), dwords, ["word"], "left")
    return counted.groupBy("id").agg(
        F.sum("n").alias("n_words"), F.sum(F.when(F.col("known") == 1, F.col("n")).otherwise(0)).alias("n_matched")) \
        .select(F.col("id").alias(id_col), "n_words", "n_matched")
