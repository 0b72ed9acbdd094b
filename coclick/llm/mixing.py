"""Mixing sources to target weights by Poisson replication.

A source of weight w gets the mean repetition rate w * total / size (sizes in
code points + 1 per document, weights normalised), so that its expected share
of the mixed corpus is its weight.  Each document's number of copies is the
inverse of the Poisson distribution function of its source's rate at a uniform
number hashed from (seed, doc_id); copies are exploded and the whole corpus is
shuffled by a hash of (seed, doc_id, copy).  DataFrame functions only.

The distribution function is tabulated per source up to rate + 12 sqrt(rate) +
30, beyond which less than 2**-52 is left.  Tables are broadcast up to
``BROADCAST_ENTRIES`` numbers in all; more are joined with the documents salted.

Defined cases: null text counts as empty; a null source is a source; rows
repeating an id get equal numbers of copies; sources without a given weight have
weight 0; sources whose weight is 0 vanish; an empty table gives an empty
result; other columns pass through (columns named like the added ones are
replaced when they are asked for).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEED = 42
TEMPERATURE = 0.5
#: Entries of all distribution functions together (8 bytes each).
BROADCAST_ENTRIES = 2_000_000
SALTS = 32
ADDED = ("copy", "n_copies", "rate", "shuffle_key")


def source_rates(docs: DataFrame, weights: DataFrame | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """(source, rate, cdf): rate per source and its Poisson distribution function at 0, 1, 2, ...

    ``weights(source, weight)`` are targets; without them weights are sizes to
    the power ``temperature``.
    """
    sizes = docs.groupBy("source").agg(
        F.sum(F.length(F.coalesce(F.col("text").cast("string"), F.lit(""))) + 1).cast("double").alias("size"))
    if weights is None:
        wanted = sizes.withColumn("weight", F.pow("size", F.lit(float(temperature))))
    else:
        w = weights.groupBy(F.col("source").alias("__source")).agg(F.sum("weight").cast("double").alias("weight"))
        wanted = sizes.join(w, F.col("source").eqNullSafe(F.col("__source")), "left") \
            .select("source", "size", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    total = wanted.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"))
    rates = wanted.crossJoin(F.broadcast(total)) \
        .withColumn("rate", F.when(F.col("all_weight") > 0, F.col("weight") / F.col("all_weight")
                                   * F.col("all_size") / F.col("size")).otherwise(F.lit(0.0))) \
        .select("source", "rate")
    # ln of the probability of k is -rate + sum of ln(rate / i) for i up to k
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int")
    upto = Window.partitionBy("source").orderBy("k")
    steps = rates.select("source", "rate", F.explode(F.sequence(F.lit(0), last)).alias("k")) \
        .withColumn("step", F.when(F.col("k") == 0, F.lit(0.0)).otherwise(F.ln(F.col("rate") / F.col("k")))) \
        .withColumn("chance", F.when(F.col("rate") > 0, F.exp(F.sum("step").over(upto) - F.col("rate")))
                    .otherwise(F.when(F.col("k") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))) \
        .withColumn("below", F.sum("chance").over(upto))
    return steps.groupBy("source", "rate").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "below"))), lambda s: s["below"]).alias("cdf"))


def _uniform(*parts) -> F.Column:
    """A number in [0, 1) from the first 52 bits of a hash of the parts."""
    text = F.concat_ws("|", *[F.coalesce(F.col(p).cast("string"), F.lit("null")) if isinstance(p, str) else p
                              for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, temperature: float = TEMPERATURE,
                seed: int = SEED, counted: bool = True) -> DataFrame:
    """``docs`` replicated to the target weights and shuffled; with (copy, n_copies, rate, shuffle_key) if ``counted``."""
    docs = docs.drop(*ADDED) if counted else docs
    rates = source_rates(docs, weights, temperature) \
        .select(F.col("source").alias("__source"), F.col("rate").alias("__rate"), F.col("cdf").alias("__cdf"))
    entries = rates.agg(F.sum(F.size("__cdf") + 8)).first()[0] or 0
    if entries <= BROADCAST_ENTRIES:
        rated = docs.join(F.broadcast(rates), F.col("source").eqNullSafe(F.col("__source")))
    else:
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
        salted = rates.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rated = docs.withColumn("__own", salt).join(
            salted, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__own") == F.col("__salt"))) \
            .drop("__own", "__salt")
    u = _uniform(F.lit(str(seed)), "doc_id")
    copies = rated.withColumn("__u", u) \
        .withColumn("__n", F.expr("size(filter(__cdf, c -> c <= __u))")).where("__n > 0") \
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n")))) \
        .withColumn("__key", F.substring(F.md5(F.concat_ws(
            "|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
            F.col("__copy").cast("string"))), 1, 16))
    shuffled = copies.drop("__cdf", "__source", "__u").repartition("__key").sortWithinPartitions("__key")
    if not counted:
        return shuffled.select(*docs.columns)
    return shuffled.select(*docs.columns, F.col("__copy").cast("long").alias("copy"),
                           F.col("__n").cast("long").alias("n_copies"),
                           F.round("__rate", 6).alias("rate"), F.col("__key").alias("shuffle_key"))


#: DuckDB SQL of ``mix_sources(documents)``.
SQL = f"""
WITH sizes AS (
    SELECT source, CAST(sum(length(coalesce(text, '')) + 1) AS DOUBLE) AS size FROM documents GROUP BY source),
rates AS (
    SELECT source, pow(size, {TEMPERATURE}) / (SELECT sum(pow(size, {TEMPERATURE})) FROM sizes)
        * (SELECT sum(size) FROM sizes) / size AS rate FROM sizes),
steps AS (
    SELECT source, rate, k, CASE WHEN k = 0 THEN 0.0 ELSE ln(rate / k) END AS step
    FROM (SELECT source, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) + 1)) AS k FROM rates)),
chances AS (
    SELECT source, rate, k, exp(sum(step) OVER (PARTITION BY source ORDER BY k) - rate) AS chance FROM steps),
below AS (
    SELECT source, rate, k, sum(chance) OVER (PARTITION BY source ORDER BY k) AS p FROM chances),
cdfs AS (
    SELECT source, rate, list(p ORDER BY k) AS cdf FROM below GROUP BY source, rate),
counted AS (
    SELECT d.*, r.rate, len(list_filter(r.cdf, lambda c: c <=
        CAST(CAST('0x' || substr(md5('{SEED}|' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)
             AS DOUBLE) / 4503599627370496.0)) AS n
    FROM documents d JOIN cdfs r ON d.source IS NOT DISTINCT FROM r.source),
copied AS (
    SELECT *, unnest(range(1, n + 1)) AS copy FROM counted WHERE n > 0)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS BIGINT) AS copy, CAST(n AS BIGINT) AS n_copies,
    round(rate, 6) AS rate,
    substr(md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || CAST(copy AS VARCHAR)), 1, 16)
        AS shuffle_key
FROM copied
"""
