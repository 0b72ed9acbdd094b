"""Token-id files: flat unsigned integers, 64-bit document offsets, memory-mapped reading.

Layout of a written folder, one set of files per bucket of consecutive ids:

* ``<bucket>-<attempt>.ids``      token ids of the bucket's documents, one after
  another, little-endian ``uint16`` or ``uint32`` (the narrowest that holds the
  vocabulary);
* ``<bucket>-<attempt>.docs``     document ids, ``int64`` (``NULL_ID`` for null);
* ``<bucket>-<attempt>.counts``   ids per document, ``uint64``;
* ``<bucket>-<attempt>.offsets``  position of each document in the whole corpus
  and the bucket's end, ``uint64``: the bucket's base plus local prefix sums.

Bases are prefix sums of the buckets' totals.  The manifest table names the
files of the attempt that succeeded, so files of lost attempts are never read.

Defined cases: null text = empty (one end id); repeated ids are separate
documents, ordered by text; null ids come first; an empty table writes nothing;
other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coclick.llm import order
from coclick.llm.store import materialise, shared_folder, shipped
from coclick.llm.tokens import END_ID, encoder, tokenizer_path

NULL_ID = -(1 << 63)
#: Characters handed to the tokenizer at a time.
CHARS_AT_ONCE = 2_000_000

_MANIFEST = "bucket int, stem string, n_docs long, n_ids long, width int"


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    local = re.match(r"(?:file:/*)?/", uri)
    return fs.FileSystem.from_uri(f"file:///{uri[local.end():]}" if local else uri)


def _put(uri: str, data: bytes | np.ndarray) -> None:
    system, path = _store(uri)
    with system.open_output_stream(path) as f:
        f.write(memoryview(data).cast("B") if isinstance(data, np.ndarray) and len(data) else bytes(data))


def _get(uri: str, dtype: str) -> np.ndarray:
    """The file's integers: memory-mapped where the store is a mounted folder, read otherwise."""
    system, path = _store(uri)
    if isinstance(system, fs.LocalFileSystem):
        with open(path, "rb") as f:
            empty = not f.read(1)
        return np.zeros(0, dtype) if empty else np.memmap(path, dtype=dtype, mode="r")
    with system.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=dtype)


def _writer(folder: str, path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        dtype = "<u2" if max(encode.tokenizer.get_vocab_size() - 1, end_id) < 1 << 16 else "<u4"
        end = np.array([end_id], dtype="<u4").tobytes()
        attempt = uuid.uuid4().hex
        system, base = _store(folder)
        system.create_dir(base)
        bucket, ids, docs, counts, sink = None, 0, [], [], None
        done = []

        def close():
            if bucket is not None:
                sink.close()
                stem = f"{folder}/{bucket:08d}-{attempt}"
                _put(f"{stem}.docs", np.array(docs, dtype="<i8"))
                _put(f"{stem}.counts", np.array(counts, dtype="<u8"))
                done.append((bucket, stem, len(docs), ids, np.dtype(dtype).itemsize))

        for batch in batches:
            of, names, texts = (batch.column(i).to_pylist() for i in range(3))
            i = 0
            while i < len(of):
                j, size = i, 0
                while j < len(of) and of[j] == of[i] and size < CHARS_AT_ONCE:
                    size += len(texts[j] or "")
                    j += 1
                if of[i] != bucket:
                    close()
                    bucket, ids, docs, counts = of[i], 0, [], []
                    sink = system.open_output_stream(f"{base}/{bucket:08d}-{attempt}.ids")
                for name, raw in zip(names[i:j], encode.encode(texts[i:j]), strict=True):
                    one = np.frombuffer(raw + end, "<u4")
                    sink.write(one.astype(dtype).tobytes())
                    docs.append(NULL_ID if name is None else name)
                    counts.append(len(one))
                    ids += len(one)
                i = j
        close()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*done, strict=True), (pa.int32(), pa.string(), pa.int64(),
                                                                         pa.int64(), pa.int32()), strict=True)],
                names=["bucket", "stem", "n_docs", "n_ids", "width"])
    return run


def _offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Writes each bucket's offsets from its base; passes the manifest on."""
    for batch in batches:
        for row in batch.to_pylist():
            counts = _get(f"{row['stem']}.counts", "<u8")
            offsets = np.full(len(counts) + 1, row["base"], dtype="<u8")
            offsets[1:] += np.cumsum(counts, dtype="<u8")
            _put(f"{row['stem']}.offsets", offsets)
        yield batch


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            docs, offsets = _get(f"{row['stem']}.docs", "<i8"), _get(f"{row['stem']}.offsets", "<u8")
            ids = _get(f"{row['stem']}.ids", f"<u{row['width']}")
            local = (offsets - offsets[0]).astype(np.int64)
            for lo in range(0, len(docs), 8192):
                hi = min(lo + 8192, len(docs))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None if d == NULL_ID else d for d in docs[lo:hi].tolist()], pa.int64()),
                     pa.array(offsets[lo:hi].astype(np.int64)),
                     pa.array(np.diff(local[lo:hi + 1])),
                     pa.array([zlib.crc32(ids[s:e].astype("<u4").tobytes())
                               for s, e in zip(local[lo:hi], local[lo + 1:hi + 1], strict=True)], pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])


def write_token_files(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None,
                      end_id: int = END_ID, rows_per_bucket: int = order.ROWS_PER_BUCKET) -> DataFrame:
    """Writes the files in ascending doc_id order; returns the manifest (bucket, stem, n_docs, n_ids, width, base)."""
    spark = shipped(docs.sparkSession)
    folder = folder or shared_folder(spark, "token-files")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bounds = order.id_bounds(docs, rows_per_bucket)
    written = materialise(
        order.in_order(order.with_buckets(docs, bounds)).select("bucket", "doc_id", "text")
        .mapInArrow(_writer(folder, tokenizer or tokenizer_path(), end_id), _MANIFEST), "token-manifest")
    # one row per bucket: the running total is a small window
    base = F.coalesce(F.sum("n_ids").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)),
                      F.lit(0)).cast("long")
    based = written.withColumn("base", base)
    return materialise(based.repartition("bucket").mapInArrow(_offsets, based.schema), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    shipped(manifest.sparkSession)
    # a fixed number of tasks: a bucket's row is small, its files are not
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(tasks, "bucket").mapInArrow(
        _reader, "doc_id long, start long, n_tokens long, ids_crc32 long")
