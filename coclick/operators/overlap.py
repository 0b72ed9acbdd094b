"""Groups that two members share, counted where whole members meet.

Members are hashed into blocks, and every two blocks meet in a tile: its task holds the
left block's members by their groups and reads the right one's as a stream.  A pair is
counted in the one tile of its blocks and leaves it complete, so what travels is each
member's groups once per block, not a row or an element for each pair and group.

This is less than the stripes of :mod:`coclick.operators.stripes` where groups are large
(:func:`blocks_of` compares both); where pairs are few, stripes travel.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coclick.session import ship_package

#: Rows (member, group) and members of a block, at most on average.
BLOCK_ROWS, BLOCK_MEMBERS = 1_000_000, 65_536
#: Common groups of all pairs that a tile counts, on average; as many tiles as tasks are made from SMALL_TILE on.
TILE, SMALL_TILE = 10_000_000, 500_000
#: Groups of a member in one row, on average.
PIECE = 512
#: Common groups that a task counts at a time.
ELEMENTS = 2_000_000


def blocks_of(members: DataFrame, group_col: str, member_col: str) -> int:
    """Blocks for :func:`pair_overlaps` of ``members``, or 0 where the elements of stripes are fewer."""
    n = F.col("n").cast("double")
    paths, rows = members.where(F.col(member_col).isNotNull()).groupBy(group_col).agg(F.count("*").alias("n")).na.drop() \
        .agg(F.sum(n * (n - 1) / 2), F.sum(n)).first()
    if not paths:
        return 0
    ids = members.select(member_col).distinct().count()
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(math.ceil(rows / BLOCK_ROWS), math.ceil(ids / BLOCK_MEMBERS), math.ceil(math.sqrt(2 * paths / TILE)),
                 math.ceil(min(math.sqrt(2 * parts), math.sqrt(2 * paths / SMALL_TILE))))
    return blocks if blocks * (rows + ids) < paths else 0


class _Held:
    """A block of members: (row, group) by group."""

    def __init__(self, parts: list[tuple]):
        member, value, of, group = (np.concatenate(x) for x in zip(*parts, strict=True))
        self.member, first, row = np.unique(member, return_index=True, return_inverse=True)
        self.value = value[first]
        row = row[of + np.repeat(np.cumsum([0, *(len(p[0]) for p in parts[:-1])]), [len(p[2]) for p in parts])]
        by = np.argsort(group, kind="stable")
        self.row, group = row[by], group[by]
        self.first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
        self.group, self.size = group[self.first], np.diff(np.append(self.first, len(group)))

    def meet(self, member: np.ndarray, value: np.ndarray, row: np.ndarray, group: np.ndarray, own: bool) -> Iterator[tuple]:
        """(a, b, weight, va, vb) of the members given, whose (row, group) are sorted by row, with those held.

        With ``own`` these are the held ones, of which each pair counts once.
        """
        if not len(self.group) or not len(group):
            return
        at = np.minimum(np.searchsorted(self.group, group), len(self.group) - 1)
        known = self.group[at] == group
        row, at = row[known], at[known]
        first, size = self.first[at], self.size[at]
        # whole members, so many that about ELEMENTS common groups are counted at a time
        ends = np.flatnonzero(np.append(row[1:] != row[:-1], True)) + 1 if len(row) else np.zeros(0, np.int64)
        total = np.cumsum(size)[ends - 1] if len(ends) else ends
        a = 0
        while a < len(ends):
            begin, before = (ends[a - 1], total[a - 1]) if a else (0, 0)
            b = max(a + 1, int(np.searchsorted(total, before + ELEMENTS, "right")))
            yield from self._count(member, value, row[begin:ends[b - 1]], first[begin:ends[b - 1]], size[begin:ends[b - 1]], own)
            a = b

    def _count(self, member, value, row, first, size, own: bool) -> Iterator[tuple]:
        low, wide = int(row[0]), len(self.member)
        reach = np.arange(int(size.sum())) + np.repeat(first - np.cumsum(size) + size, size)
        codes = np.repeat((row - low) * wide, size) + self.row[reach]
        cells = (int(row[-1]) - low + 1) * wide
        if cells <= 4 * len(codes):
            count = np.bincount(codes, minlength=cells)
            codes = np.flatnonzero(count)
            count = count[codes]
        else:
            codes, count = np.unique(codes, return_counts=True)
        x, y = np.divmod(codes, wide)
        x += low
        a, b = member[x], self.member[y]
        keep = a < b if own else slice(None)
        x, y, a, b, count = x[keep], y[keep], a[keep], b[keep], count[keep]
        va, vb, less = value[x], self.value[y], a < b
        yield np.where(less, a, b), np.where(less, b, a), count, np.where(less, va, vb), np.where(less, vb, va)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (i, j, kind, member): a tile's left members (0), then its right ones (1), to their pairs."""
    def columns(rows: pa.RecordBatch) -> tuple:
        n = pc.list_value_length(rows.column("groups")).to_numpy(zero_copy_only=False)
        return (rows.column("member").to_numpy(), rows.column("value").to_numpy(), np.repeat(np.arange(len(n)), n),
                rows.column("groups").flatten().to_numpy(zero_copy_only=False))

    def rows(found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        for out in found:
            for a in range(0, len(out[0]), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[a:a + 100_000]) for c in out], names=["a", "b", "weight", "va", "vb"])

    def right(held: _Held, parts: list[tuple]) -> Iterator[tuple]:
        # a member's pieces are one row
        other = _Held(parts)
        row, group = other.row, np.repeat(other.group, other.size)
        by = np.argsort(row, kind="stable")
        yield from held.meet(other.member, other.value, row[by], group[by], False)

    def own(held: _Held) -> Iterator[tuple]:
        row, group = held.row, np.repeat(held.group, held.size)
        by = np.argsort(row, kind="stable")
        yield from held.meet(held.member, held.value, row[by], group[by], True)

    tile, left, parts, count, held = None, [], [], 0, None

    def closed() -> Iterator[tuple]:
        if tile is None or not left and held is None:
            return
        if tile[0] == tile[1]:
            yield from own(held or _Held(left))
        elif parts:
            yield from right(held or _Held(left), parts)

    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.stack([batch.column(c).to_numpy() for c in ("i", "j", "kind")])
        cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if tuple(marks[:2, a]) != tile:
                yield from rows(closed())
                tile, left, parts, count, held = tuple(marks[:2, a]), [], [], 0, None
            part = columns(batch.slice(a, b - a))
            if marks[2, a] == 0:
                left.append(part)
                continue
            if held is None:
                if not left:
                    continue
                held, left = _Held(left), []
            parts.append(part)
            count += len(part[2])
            if count >= ELEMENTS:
                # the last member may go on
                done, parts, count = _split(parts, part[0][-1])
                if done:
                    yield from rows(right(held, done))
    yield from rows(closed())


def _split(parts: list[tuple], last: int) -> tuple[list[tuple], list[tuple], int]:
    """Parts of members sorted by id, cut before the member ``last``; rows of what is kept."""
    done, kept = [], []
    for member, value, of, group in parts:
        cut = int(np.searchsorted(member, last))
        at = int(np.searchsorted(of, cut))
        if cut:
            done.append((member[:cut], value[:cut], of[:at], group[:at]))
        if cut < len(member):
            kept.append((member[cut:], value[cut:], of[at:] - cut, group[at:]))
    return done, kept, sum(len(p[2]) for p in kept)


def pair_overlaps(members: DataFrame, group_col: str, member_col: str, value_col: str, blocks: int) -> DataFrame:
    """(a, b, weight, va, vb): the members ``a < b`` that share a group, their number of common groups and both values.

    ``members`` are distinct whole numbers (group, member); ``value_col`` is a whole number that belongs to the member.
    """
    spark = members.sparkSession
    ship_package(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    m = members.select(F.col(member_col).cast("bigint").alias("member"), F.col(group_col).cast("bigint").alias("group"),
                       F.col(value_col).cast("bigint").alias("value")).na.drop()
    piece = F.pmod(F.xxhash64("group"), F.ceil(F.col("value") / PIECE).cast("bigint"))
    lists = m.groupBy("member", "value", piece.alias("piece")).agg(F.collect_list("group").alias("groups"))
    lists = lists.withColumn("own", F.pmod(F.xxhash64("member"), F.lit(blocks)).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    tiles = lists.select(F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                         (F.col("own") > F.col("other")).cast("int").alias("kind"), "member", "value", "groups")
    # tiles are heavy: not merged by the bytes they read
    n = min(max(parts, blocks * (blocks + 1)), 4 * parts)
    return tiles.repartition(n, "i", "j").sortWithinPartitions("i", "j", "kind", "member") \
        .mapInArrow(_met, "a long, b long, weight long, va long, vb long")
