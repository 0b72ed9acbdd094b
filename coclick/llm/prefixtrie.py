"""Prefix trie of rebuilt conversations: members, children, leaves and saved tokens per node.

Conversation c is rebuilt from the first h turns of conversation ``c - c % 5``
(all if it has fewer, none if it is absent) and its own turns after the first h,
with h = crc32 of c in decimal, modulo 9.  A node is a distinct sequence of the
first d rebuilt turns; its name is 128 bits: the sum, modulo 2**64, of two
hashes of (depth, role, text) over its turns, so a prefix's name is a running
sum and the name of its parent the sum without the last turn.

Subtree totals go by depth bands of height H = ``BAND``: a node explodes only to
its ancestors down to its band's root, so at most H - 1 of them.  Band roots are
the nodes of a trie H times less deep, which is treated alike, band over band,
until one band holds all (log_H of the depth rounds).  Then completed totals
come back down: a band root hands its total to its ancestors inside the band
above.  Each node takes part in at most H rows a level, and a level has 1/H of
the nodes of the one before.

A conversation of any length is numbered by many tasks
(:func:`coclick.operators.positions.running`); a node with very many children is
split where they look up their parent; the ids that end at a node are joined
to chunks by many tasks, and one task only feeds the chunks to the hash, in order.

Defined cases: null role or text = empty; null turn numbers come first, turns with
equal numbers are ordered by the hash of role and text; rows without a conv_id
belong to no conversation; ``c - c % 5`` is the multiple of five at or below c,
also for negative ids; repeated rows are turns of their own; an empty table has no
node, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coclick.llm.store import materialise, shipped
from coclick.operators.positions import running, wrapping_sub
from coclick.operators.skew import split_join

#: Height of a depth band.
BAND = 8
FAMILY, SHARED = 5, 9
#: Conversation ids joined to one piece of text before hashing.
IDS_PER_CHUNK = 20_000

_KEY = ["depth", "k1", "k2"]


def _shared_turns(conv: Column) -> Column:
    return F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(SHARED)).cast("long")


def rebuilt_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, g1, g2, n_bytes): the turns of every rebuilt conversation, hashed."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    conv = F.col("conv_id").cast("long")
    turns = conversations.where(conv.isNotNull()).select(
        (conv - F.pmod(conv, F.lit(FAMILY))).alias("base"), conv.alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("g1"), F.xxhash64(F.lit(2), text, role).alias("g2"),
        F.octet_length(text).cast("long").alias("n_bytes"))
    # running counts of each member of the family of five: the row's own position, and the base's length
    member = F.col("conv_id") - F.col("base")
    counted = turns.withColumns({f"of_{i}": (member == i).cast("long") for i in range(FAMILY)})
    placed = running(counted, ["base"], ["conv_id", "turn", "g1", "g2", "n_bytes"], [f"of_{i}" for i in range(FAMILY)])
    pos = F.coalesce(*[F.when(member == i, F.col(f"of_{i}_upto")) for i in range(FAMILY)])
    placed = placed.withColumns({"pos": pos, "h": _shared_turns(F.col("conv_id"))})
    # own turns: all of a base, those after the first h of the others, which follow the base's turns
    own = placed.where((member == 0) | (F.col("pos") > F.col("h"))).select(
        "conv_id", F.when(member == 0, F.col("pos"))
        .otherwise(F.col("pos") - F.col("h") + F.least("h", "of_0_upto")).alias("depth"), "g1", "g2", "n_bytes")
    heir = F.explode(F.array(*[F.try_add(F.col("conv_id"), F.lit(i).cast("long")) for i in range(1, FAMILY)]))
    lent = placed.where((member == 0) & (F.col("pos") < SHARED)) \
        .select(heir.alias("heir"), F.col("pos").alias("depth"), "g1", "g2", "n_bytes") \
        .withColumnRenamed("heir", "conv_id").where(F.col("depth") <= _shared_turns(F.col("conv_id")))
    present = conversations.where(conv.isNotNull()).select(conv.alias("conv_id")).distinct()
    return own.unionByName(lent.join(present, "conv_id", "left_semi"))


def prefixes(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, n_bytes, last): every prefix of every rebuilt conversation."""
    turns = rebuilt_turns(conversations).select(
        "conv_id", "depth", "n_bytes", F.xxhash64("depth", "g1", "g2").alias("l1"),
        F.xxhash64("g2", "depth", "g1").alias("l2"))
    summed = running(turns, ["conv_id"], ["depth"], ["l1", "l2"])
    return summed.select("conv_id", "depth", F.col("l1_upto").alias("k1"), F.col("l2_upto").alias("k2"),
                         wrapping_sub(F.col("l1_upto"), F.col("l1")).alias("p1"),
                         wrapping_sub(F.col("l2_upto"), F.col("l2")).alias("p2"), "n_bytes",
                         (F.col("shared_next") == 0).alias("last"))


def _chunks(ids_per_chunk: int):
    """Sorted (depth, k1, k2, conv_id) to (depth, k1, k2, part, no, ids): at most so many ids a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no = TaskContext.get().partitionId(), 0
        node, ids = None, []

        def row():
            return pa.RecordBatch.from_arrays(
                [*[pa.array([x], pa.int64()) for x in node], pa.array([part], pa.int32()), pa.array([no], pa.int64()),
                 pa.array([",".join(map(str, ids))])], names=[*_KEY, "part", "no", "ids"])

        for batch in batches:
            depth, k1, k2, conv = (batch.column(i).to_pylist() for i in range(4))
            rows = []
            for of, c in zip(zip(depth, k1, k2, strict=True), conv, strict=True):
                if of != node or len(ids) == ids_per_chunk:
                    if node is not None:
                        rows.append(row())
                        no += 1
                    node, ids = of, []
                ids.append(c)
            if rows:
                yield from pa.Table.from_batches(rows).combine_chunks().to_batches()
        if node is not None:
            yield row()
    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks to one SHA-256 per node, fed chunk by chunk."""
    node, sha = None, None
    for batch in batches:
        out = []
        columns = [batch.column(i).to_pylist() for i in (0, 1, 2, 5)]
        for *of, ids in zip(*columns, strict=True):
            if of == node:
                sha.update(b",")
            else:
                if node is not None:
                    out.append((*node, sha.hexdigest()))
                node, sha = of, hashlib.sha256()
            sha.update(ids.encode())
        if out:
            yield _digest_rows(out)
    if node is not None:
        yield _digest_rows([(*node, sha.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 3 + [pa.string()], strict=True)],
        names=[*_KEY, "ends_sha256"])


def _end_digests(ends: DataFrame, ids_per_chunk: int = IDS_PER_CHUNK) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of the nodes at which conversations end: ``ends(depth, k1, k2, conv_id)``."""
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = ends.repartitionByRange(parts, *_KEY, "conv_id").sortWithinPartitions(*_KEY, "conv_id") \
        .mapInArrow(_chunks(ids_per_chunk), "depth long, k1 long, k2 long, part int, no long, ids string")
    return chunks.repartition(*_KEY).sortWithinPartitions(*_KEY, "part", "no") \
        .mapInArrow(_digests, "depth long, k1 long, k2 long, ends_sha256 string")


def _summed(values: DataFrame) -> DataFrame:
    return values.groupBy(*_KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def rollup(nodes: DataFrame, paths: DataFrame, band: int = BAND) -> DataFrame:
    """(depth, k1, k2, leaves, saved): the values of ``nodes`` summed over their subtrees.

    ``nodes(depth, k1, k2, conv_id, leaves, saved)`` with a root at depth 0 named
    (0, 0); ``paths(conv_id, depth, k1, k2)`` names the nodes on each conversation's path.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    steps = [1]
    while steps[-1] * band <= deepest:
        steps.append(steps[-1] * band)
    # who explodes where: inside the band of each level (up), or from a band's root into the band above (across)
    def ways(level: int, step: int) -> Column:
        inside = F.pmod(F.floor(F.col("depth") / step), F.lit(band)).cast("int")
        far = F.sequence(F.lit(1), F.when(inside > 0, inside).otherwise(F.lit(band - 1)))
        way = F.transform(far, lambda j: F.struct(F.lit(level).alias("level"), (inside > 0).alias("up"),
                                                  (F.col("depth") - j * step).alias("to")))
        return F.when((F.col("depth") % step == 0) & (F.col("depth") > 0), way).otherwise(F.slice(way, 1, 0))

    sent = nodes.select(*_KEY, "conv_id", F.explode(F.flatten(F.array(
        *[ways(level, step) for level, step in enumerate(steps)]))).alias("way")) \
        .select(*[F.col(c).alias(f"x_{c}") for c in _KEY], "conv_id", "way.level", "way.up", F.col("way.to").alias("depth"))
    # the root has no row in the paths
    edges = materialise(sent.join(paths, ["conv_id", "depth"], "left").select(
        "level", "up", *[f"x_{c}" for c in _KEY], "depth", *[F.coalesce(c, F.lit(0).cast("long")).alias(c)
                                                             for c in ("k1", "k2")]), "trie-edges")

    def handed(totals: DataFrame, level: int, up: bool) -> DataFrame:
        from_x = totals.select(*[F.col(c).alias(f"x_{c}") for c in _KEY], "leaves", "saved")
        return edges.where((F.col("level") == level) & (F.col("up") == up)) \
            .join(from_x, [f"x_{c}" for c in _KEY]).select(*_KEY, "leaves", "saved")

    values = nodes.select(*_KEY, "leaves", "saved")
    partial = []
    for level, step in enumerate(steps):
        own = values.where(F.col("depth") % step == 0)
        values = materialise(_summed(own.unionByName(handed(own, level, True))), "trie-up")
        partial.append(values)
    # the top band's totals are complete; each level below completes its own nodes with its band roots' totals
    complete = partial.pop()
    for level in range(len(partial) - 1, -1, -1):
        inner = partial[level].where(F.col("depth") % steps[level + 1] > 0)
        complete = materialise(
            complete.unionByName(_summed(inner.unionByName(handed(complete, level, False)))), "trie-down")
    return complete


def prefix_trie(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = shipped(conversations.sparkSession)
    rows = materialise(prefixes(conversations), "trie-prefixes")
    zero = F.lit(0).cast("long")
    convs = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).where("conv_id is not null").distinct()
    turnless = convs.join(rows.where("last").select("conv_id"), "conv_id", "left_anti")
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0") \
        .select(*[zero.alias(c) for c in _KEY], "conv_id", "n_convs", *[zero.alias(c) for c in ("n_bytes", "p1", "p2")])
    own = rows.groupBy(*_KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
                                  F.max("n_bytes").alias("n_bytes"), F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    nodes = materialise(own.unionByName(root), "trie-nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"),
                                                F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    nodes = materialise(
        nodes.join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", zero)), "trie-nodes")
    valued = nodes.select(*_KEY, "conv_id", (F.col("n_children") == 0).cast("long").alias("leaves"),
                          ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))
    totals = rollup(valued, rows.select("conv_id", *_KEY), band)
    ends = rows.where("last").select(*_KEY, "conv_id").unionByName(
        turnless.select(*[zero.alias(c) for c in _KEY], "conv_id"))
    # children look up their parent's conv_id; the root's is known, other large families are split
    parents = nodes.where("n_children > 0 and depth > 0").select(
        F.col("depth").alias("p0"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    deep = split_join(nodes.where("depth > 1").withColumn("p0", F.col("depth") - 1), parents, ["p0", "p1", "p2"], "left",
                      split_right=False).drop("p0")
    first = spark.createDataFrame([r], "top long") if (r := root.select("conv_id").first()) else \
        spark.createDataFrame([], "top long")
    top = nodes.where("depth = 1").join(F.broadcast(first)).withColumnRenamed("top", "parent_conv_id") \
        .unionByName(nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")))
    return deep.unionByName(top).join(totals, _KEY).join(_end_digests(ends), _KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256))
        .alias("ends_sha256"))


#: DuckDB SQL of ``prefix_trie(conversations)`` where no two turns of a conversation have one number.
SQL = f"""
WITH turns AS (
    SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS own
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hashed AS (
    SELECT *, xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                                                lambda x: CAST(ascii(x) AS BIGINT))),
        lambda crc, byte: list_reduce(
            list_prepend(xor(crc, byte), list_transform(range(8), lambda x: CAST(x AS BIGINT))),
            lambda v, i: xor(v >> 1, 3988292384 * (v & 1))))) % {SHARED} AS h
    FROM turns),
rebuilt AS (
    SELECT a.conv_id, list_concat(list_slice(coalesce(b.own, []), 1, a.h), list_slice(a.own, a.h + 1, len(a.own))) AS path
    FROM hashed a LEFT JOIN hashed b ON b.conv_id = a.conv_id - ((a.conv_id % {FAMILY}) + {FAMILY}) % {FAMILY}),
prefixes AS (
    SELECT conv_id, d, len(path) AS n, list_slice(path, 1, d) AS pre
    FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)),
nodes AS (
    SELECT pre, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
    FROM prefixes GROUP BY pre),
children AS (
    SELECT list_slice(pre, 1, depth - 1) AS pre, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
valued AS (
    SELECT n.*, coalesce(c.n_children, 0) AS n_children, CASE WHEN c.n_children IS NULL THEN 1 ELSE 0 END AS leaf,
        CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(n.pre[depth].text) END AS saved
    FROM nodes n LEFT JOIN children c ON n.pre = c.pre),
totals AS (
    SELECT list_slice(pre, 1, a) AS pre, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT pre, leaf, saved, unnest(range(0, depth + 1)) AS a FROM valued) GROUP BY 1)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children,
    CAST(t.n_leaves AS BIGINT) AS n_leaves, CAST(t.saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM valued v JOIN totals t ON v.pre = t.pre
LEFT JOIN nodes p ON v.depth > 0 AND p.depth = v.depth - 1 AND p.pre = list_slice(v.pre, 1, v.depth - 1)
"""
