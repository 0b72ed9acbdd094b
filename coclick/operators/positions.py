"""Positions and running sums inside keys of any size (WN1-WN3).

``Window.partitionBy(key)`` puts a key's rows in one task.  Here the table is
range-partitioned by (key, order): Spark samples splitters, so every task gets
about the same number of rows and a key with a third of them spans many tasks.
A task numbers its sorted rows in one pass over Arrow batches; what the rows at
the front of a task lack is the total of the tasks before it that end with the
same key.  Those prefix sums are over one row per task, and come back by a
broadcast of at most that many rows.

The numbered rows are written once before the prefix sums are taken, so a
repeated task cannot meet other splitters.

:func:`numbered` is the plain front: keys that fit a task go through one window,
only keys that a frequent-items summary measures as larger take the way above.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coclick.operators.skew import heavy_keys
from coclick.session import ship_package, stored

_HEAD_RUN, _FIRST, _LAST = 1, 2, 4
_LOW = 0xFFFFFFFF


def wrapping_add(a: Column, b: Column) -> Column:
    """64-bit sum modulo 2**64 (ANSI addition raises on overflow)."""
    low = a.bitwiseAND(F.lit(_LOW)) + b.bitwiseAND(F.lit(_LOW))
    high = F.shiftrightunsigned(a, 32) + F.shiftrightunsigned(b, 32) + F.shiftrightunsigned(low, 32)
    return F.shiftleft(high, 32).bitwiseOR(low.bitwiseAND(F.lit(_LOW)))


def wrapping_sub(a: Column, b: Column) -> Column:
    """64-bit difference modulo 2**64."""
    return wrapping_add(wrapping_add(a, F.bitwise_not(b)), F.lit(1).cast("long"))


def _same_as_before(column: pa.Array, before: pa.Array | None) -> np.ndarray:
    """Whether each value equals the one before it; nulls are equal to each other."""
    prev = pa.concat_arrays([column.slice(0, 1) if before is None else before, column.slice(0, len(column) - 1)])
    same = pc.or_(pc.fill_null(pc.equal(column, prev), False), pc.and_(column.is_null(), prev.is_null()))
    out = same.to_numpy(zero_copy_only=False).copy()
    if before is None:
        out[0] = False
    return out


def _numbering(keys: list[int], sums: list[int], names: list[str], drop_alone: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        before: list[pa.Array | None] = [None] * len(keys)
        carry, totals, resets = 0, [np.uint64(0)] * len(sums), 0
        held: tuple | None = None

        def out(batch, pos, upto, shared, following, flags):
            n = len(pos)
            if drop_alone:
                keep = (shared > 0) | (following > 0) | ((flags & (_FIRST | _LAST)) > 0)
                if not keep.all():
                    batch = batch.filter(pa.array(keep))
                    pos, shared, following, flags = (x[keep] for x in (pos, shared, following, flags))
                    upto, n = [u[keep] for u in upto], int(keep.sum())
            return pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pos), *[pa.array(u.view(np.int64)) for u in upto], pa.array(shared),
                 pa.array(following), pa.array(np.full(n, part, np.int32)), pa.array(flags)], names=names)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            alive, shared = np.ones(n, bool), np.zeros(n, np.int32)
            for i, at in enumerate(keys):
                column = batch.column(at)
                alive &= _same_as_before(column, before[i])
                shared += alive
                before[i] = column.slice(n - 1, 1)
            reset = shared < len(keys) if keys else np.zeros(n, bool)
            if held is None:
                reset[0] = True
            run_no = np.cumsum(reset)
            start = np.concatenate([[0], np.flatnonzero(reset)])[run_no]
            goes_on = run_no == 0
            pos = np.arange(n, dtype=np.int64) - start + 1 + np.where(goes_on, carry, 0)
            upto = []
            for j, at in enumerate(sums):
                x = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                total = np.cumsum(x, dtype=np.uint64)
                u = total - (total - x)[start]
                u[goes_on] += totals[j]
                totals[j] = u[-1]
                upto.append(u)
            carry = int(pos[-1])
            flags = np.where(resets + run_no == 1, _HEAD_RUN, 0).astype(np.int32)
            resets += int(run_no[-1])
            if held is None:
                flags[0] |= _FIRST
            else:
                yield out(*held[:-2], np.array([shared[0]], np.int32), held[-1])
            # the last row waits for its successor
            if n > 1:
                yield out(batch.slice(0, n - 1), pos[:-1], [u[:-1] for u in upto], shared[:-1], shared[1:], flags[:-1])
            held = (batch.slice(n - 1, 1), pos[-1:], [u[-1:] for u in upto], shared[-1:], None, flags[-1:])
        if held is not None:
            yield out(*held[:-2], np.zeros(1, np.int32), held[-1] | _LAST)
    return run


def _edge_fixes(edges: list, keys: list[str], sums: list[str]) -> list[tuple]:
    """(part, rows before, sums before, keys shared before the first row, after the last row) per task."""
    ends: dict[int, dict[str, object]] = {}
    for r in edges:
        ends.setdefault(r["__part"], {}).update(
            {end: r for end, bit in (("first", _FIRST), ("last", _LAST)) if r["__flags"] & bit})
    key = lambda r: [r[f"__key_{i}"] for i in range(len(keys))]
    fixes, prior, carry, totals = [], None, 0, [0] * len(sums)
    for part in sorted(ends):
        first, last = ends[part]["first"], ends[part]["last"]
        shared = 0
        if prior is not None:
            for a, b in zip(key(prior), key(first), strict=True):
                if a != b:
                    break
                shared += 1
        if prior is None or shared < len(keys):
            carry, totals = 0, [0] * len(sums)
        fixes.append([part, carry, *totals, shared, 0])
        if prior is not None:
            fixes[-2][-1] = shared
        whole = bool(last["__flags"] & _HEAD_RUN)
        wrap = lambda x: (x + (1 << 63)) % (1 << 64) - (1 << 63)
        totals = [wrap(last[f"{s}_upto"] + (t if whole else 0)) for s, t in zip(sums, totals, strict=True)]
        carry = last["pos"] + (carry if whole else 0)
        prior = last
    return [tuple(f) for f in fixes]


def running(df: DataFrame, keys: list[str], order: list[str], sums: list[str] | None = None, *,
            parts: int | None = None, drop_alone: bool = False) -> DataFrame:
    """``df`` with each row's place in the order (keys, order), whatever the size of a key.

    Adds ``pos`` (1-based position inside the row's key, ``row_number``),
    ``<s>_upto`` for each long column of ``sums`` (running sum inside the key up
    to and with the row, modulo 2**64), ``shared_prev`` and ``shared_next`` (how
    many leading key columns the row shares with the row before and after it in
    the whole order; ``shared_next < len(keys)`` marks a key's last row).  With
    ``drop_alone`` rows that share no key column with either neighbour go.

    ``keys`` and ``order`` are columns; nulls come first and equal each other.
    Order columns should leave ties only among equal rows.  With no keys the
    whole table is one sequence.  ``parts`` tasks (default: the session's shuffle
    partitions) read the sorted rows; the driver gets two rows of keys per task.
    """
    sums = sums or []
    spark = df.sparkSession
    added = ["pos", *[f"{s}_upto" for s in sums], "shared_prev", "shared_next"]
    if clash := sorted({*added, "__part", "__flags"} & set(df.columns)):
        raise ValueError(f"columns {clash} are added here")
    ship_package(spark)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = df.columns
    schema = T.StructType([*df.schema.fields, *[T.StructField(c, T.LongType()) for c in added[:-2]],
                           *[T.StructField(c, T.IntegerType()) for c in [*added[-2:], "__part", "__flags"]]])
    by = [*keys, *order]
    ranged = df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    numbered = stored(ranged.mapInArrow(
        _numbering([columns.index(k) for k in keys], [columns.index(s) for s in sums], schema.names, drop_alone),
        schema), "running")
    edges = numbered.where(F.col("__flags") >= _FIRST).select(
        "__part", "__flags", "pos", *added[1:-2], *[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)]).collect()
    names = ["__part", "__pos", *[f"__sum_{i}" for i in range(len(sums))], "__prev", "__next"]
    fixes = spark.createDataFrame(_edge_fixes(edges, keys, sums), T.StructType(
        [T.StructField(c, T.LongType() if c not in ("__part", "__prev", "__next") else T.IntegerType()) for c in names]))
    flag = lambda bit: F.col("__flags").bitwiseAND(bit) > 0
    fixed = numbered.join(F.broadcast(fixes), "__part", "left").withColumns({
        "pos": F.when(flag(_HEAD_RUN), F.col("pos") + F.col("__pos")).otherwise(F.col("pos")),
        **{f"{s}_upto": F.when(flag(_HEAD_RUN), wrapping_add(F.col(f"{s}_upto"), F.col(f"__sum_{i}")))
           .otherwise(F.col(f"{s}_upto")) for i, s in enumerate(sums)},
        "shared_prev": F.when(flag(_FIRST), F.col("__prev")).otherwise(F.col("shared_prev")),
        "shared_next": F.when(flag(_LAST), F.col("__next")).otherwise(F.col("shared_next"))})
    if drop_alone:
        fixed = fixed.where("shared_prev > 0 or shared_next > 0")
    return fixed.select(*columns, *added)


def numbered(df: DataFrame, keys: list[str], order: list[str], pos_col: str = "pos", size_col: str | None = None, *,
             rows_per_task: int | None = None, parts: int | None = None, sums: list[str] | None = None) -> DataFrame:
    """``df`` with the dense 1-based position of each row inside its key, and the key's size if asked for.

    Long columns of ``sums`` get their running sum ``<s>_upto`` inside the key.

    Keys of more than ``rows_per_task`` rows (default: those of an average task,
    see :func:`heavy_keys`) are numbered by :func:`running`, all others by a
    window; without such a key the plan is that window alone.  ``order`` are
    columns, nulls first; ties should only be left among equal rows.
    """
    key = Window.partitionBy(*keys)
    counted = {pos_col: F.row_number().over(key.orderBy(*order)).cast("bigint")}
    for c in sums or []:
        counted[f"{c}_upto"] = F.sum(c).over(key.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    if size_col:
        counted[size_col] = F.count(F.lit(1)).over(key)
    heavy = heavy_keys(df, keys, rows_per_task)
    if not heavy:
        return df.withColumns(counted)
    spark = df.sparkSession
    named = F.broadcast(spark.createDataFrame([(h,) for h in heavy], "__h long"))
    hashed = df.withColumn("__h", F.xxhash64(*keys))
    light = hashed.join(named, "__h", "left_anti").drop("__h").withColumns(counted)
    ranged = running(hashed.join(named, "__h", "left_semi").drop("__h"), keys, order, sums, parts=parts)
    ranged = ranged.withColumnRenamed("pos", pos_col) if pos_col != "pos" else ranged
    if size_col:
        # one row per heavy key
        last = ranged.where(F.col("shared_next") < len(keys)).select(
            *[F.col(k).alias(f"__{k}") for k in keys], F.col(pos_col).alias(size_col))
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
        ranged = ranged.join(F.broadcast(last), same)
    return light.unionByName(ranged.select(*light.columns))
