"""Documents packed into chunks, and exact counting of keys across chunks.

A chunk is one row that holds some whole documents (all their columns) as a
compressed Arrow stream.  Chunks are written once to the shared folder, so
every later pass sees the same chunks, also after an executor was lost.

Counting keys over the corpus then takes one exchange: each chunk sends, per
bucket of the key space, one packed array of its distinct keys with counts;
a bucket adds them up and sends each chunk an array in the same order.  A key
that fills a third of the corpus costs one entry a chunk.  The number of
buckets follows the input's bytes, so a bucket's size doesn't.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.words import returning
from attrition.session import ship_package, write_table

CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20


def squeeze(a: np.ndarray) -> bytes:
    """Byte planes of an array, compressed."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T) if len(a) else b""
    return zstandard.ZstdCompressor(level=1).compress(planes)


def expand(b: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel() if len(raw) else np.zeros(0, dtype)


def pack_batch(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack_batch(payload) -> pa.RecordBatch:
    table = pa.ipc.open_stream(pa.py_buffer(payload)).read_all()
    return table.combine_chunks().to_batches()[0] if table.num_rows else pa.RecordBatch.from_pylist([], table.schema)


def _text_bytes(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc
    return pc.fill_null(pc.binary_length(column.cast(pa.large_string())), 0).to_numpy(zero_copy_only=False)


def pack(docs: DataFrame, text: str = "text", split=None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Written table ``(cid long, split int, n_bytes long, payload binary)``.

    ``split``: an int column expression; documents of different splits go to
    different chunks.  A document longer than ``chunk_bytes`` fills a chunk alone.
    """
    ship_package(docs.sparkSession)
    names = docs.columns
    source = docs.select("*", (split if split is not None else F.lit(0)).cast("int").alias("__split"))

    @returning
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held: dict[int, list] = {}
        size: dict[int, int] = {}

        def emit(key):
            nonlocal seq
            batch = pa.Table.from_batches(held.pop(key)).combine_chunks().to_batches()[0]
            out = pa.RecordBatch.from_pydict({
                "cid": pa.array([(part << 32) + seq], pa.int64()), "split": pa.array([key], pa.int32()),
                "n_bytes": pa.array([size.pop(key)], pa.int64()), "payload": pa.array([pack_batch(batch)], pa.binary())})
            seq += 1
            return out

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("__split").fill_null(0).to_numpy(zero_copy_only=False)
            body = batch.select(names)
            for key in np.unique(keys):
                key = int(key)
                own = body.filter(pa.array(keys == key)) if len(keys) else body
                cum = np.cumsum(_text_bytes(own.column(text)))
                lo = 0
                while lo < own.num_rows:
                    base = cum[lo - 1] if lo else 0
                    room = chunk_bytes - size.get(key, 0)
                    hi = max(lo + 1, int(np.searchsorted(cum, base + room, "right")))
                    held.setdefault(key, []).append(own.slice(lo, hi - lo))
                    size[key] = size.get(key, 0) + int(cum[hi - 1] - base)
                    if size[key] >= chunk_bytes or hi < own.num_rows:
                        yield emit(key)
                    lo = hi
        for key in list(held):
            yield emit(key)

    out = source.mapInArrow(rows, "cid long, split int, n_bytes long, payload binary")
    return write_table(out, "chunks")


def bucket_count(chunks: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    return max(1, -(-int(total) // bucket_bytes))


def cuts(sorted_keys: np.ndarray, n: int) -> np.ndarray:
    """Positions that cut sorted 64-bit keys into ``n`` equal ranges of the key space."""
    edges = np.array([(i << 64) // n for i in range(1, n)], np.uint64)
    return np.concatenate([[0], np.searchsorted(sorted_keys, edges), [len(sorted_keys)]]).astype(np.int64)


def with_answers(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """Chunks with ``answers``: an array of a chunk's answer rows, by (kind, bucket).
    What is gathered for a chunk is bounded by the chunk.  Answers grow with the
    input, so they are never broadcast: the join shuffles at every size."""
    cols = [c for c in answers.columns if c != "cid"]
    own = answers.groupBy("cid").agg(F.sort_array(F.collect_list(F.struct(*cols))).alias("answers"))
    return chunks.join(own.hint("merge"), "cid", "left")
