"""Token-id files in bit or byte planes.

A file holds the ids of some consecutive documents.  The ids are cut into blocks
of a fixed number of ids; each block is transposed into planes (all lowest bytes
first, then the next, or the same for bits) and every plane is compressed with
zstandard.  A chunk index gives each block's place, so a range of ids is read
without the others.  Layout, little-endian:

    b"IDP1"  u8 plane bits (8 or 1)  u32 block length  u64 ids  u64 documents
    u64 blocks  u64 length of the document table
    index: per block u64 place in the body, u32 ids, u32 length of each of the planes
    document table (zstandard): i64 lengths of the documents
    body: compressed planes

Files are rows of a Parquet dataset (part, file number, content), so they are
written and read by Spark in any store.  Documents are range-partitioned by id
and sorted, so parts follow each other; a part's first id number is the sum of
the totals of the parts before it (one row a part, no document passes the driver).

Defined cases: null text is an empty text (only the end id); null ids come
first; rows that repeat an id follow each other, ordered by a hash of their text;
an empty table gives an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attrition.llm.bpe import WordMemo, forget, load, merged, slices, spread, vocabulary
from attrition.llm.bpe_codec import public_path
from attrition.session import scratch_path, ship_package

BLOCK = 1 << 16
FILE_IDS = 2 << 20
MEMO_WORDS = 200_000
SLICE = 6 << 20
_HEAD = struct.Struct("<4sBIQQQQ")


def to_planes(ids: np.ndarray, bits: int = 8) -> list[bytes]:
    """The planes of a block: 4 byte planes or 32 bit planes, lowest first."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits == 8:
        return [np.ascontiguousarray(raw[:, i]).tobytes() for i in range(4)]
    spread = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(np.ascontiguousarray(spread[:, i]), bitorder="little").tobytes() for i in range(32)]


def from_planes(planes: list[bytes], n: int, bits: int = 8) -> np.ndarray:
    if bits == 8:
        return np.stack([np.frombuffer(p, np.uint8) for p in planes], 1).copy().view("<u4").ravel()
    spread = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], 1)
    return np.packbits(spread, axis=1, bitorder="little").view("<u4").ravel()


def write_file(ids: np.ndarray, lengths: np.ndarray, bits: int = 8, block: int = BLOCK) -> bytes:
    pack = zstandard.ZstdCompressor(level=1).compress
    index, body, place = [], [], 0
    for lo in range(0, len(ids), block):
        part = ids[lo:lo + block]
        planes = [pack(p) for p in to_planes(part, bits)]
        index.append(struct.pack(f"<QI{len(planes)}I", place, len(part), *map(len, planes)))
        body += planes
        place += sum(map(len, planes))
    table = pack(np.ascontiguousarray(lengths, "<i8").tobytes())
    return b"".join([_HEAD.pack(b"IDP1", bits, block, len(ids), len(lengths), len(index), len(table)), *index, table, *body])


def read_lengths(content: bytes) -> np.ndarray:
    _, bits, _, _, _, blocks, table = _HEAD.unpack_from(content)
    at = _HEAD.size + blocks * (12 + 4 * (32 // bits))
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(content[at:at + table]), "<i8")


def read_ids(content: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``start:stop`` of a file; only the blocks that hold them are unpacked."""
    _, bits, block, n, _, blocks, table = _HEAD.unpack_from(content)
    stop = n if stop is None else min(stop, n)
    planes = 32 // bits
    entry = struct.Struct(f"<QI{planes}I")
    body = _HEAD.size + blocks * entry.size + table
    unpack = zstandard.ZstdDecompressor().decompress
    out = []
    for b in range(start // block, -(-stop // block) if stop > start else start // block):
        place, count, *sizes = entry.unpack_from(content, _HEAD.size + b * entry.size)
        at, got = body + place, []
        for size in sizes:
            got.append(unpack(content[at:at + size]))
            at += size
        ids = from_planes(got, count, bits)
        out.append(ids[max(0, start - b * block):stop - b * block])
    return np.concatenate(out) if out else np.zeros(0, "<u4")


class _Encoder:
    """The library's encoding, asked for distinct words only."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit
        self.bpe = load(path)
        self.memo = WordMemo(MEMO_WORDS)
        # the library's own model, for pieces that are already normalised, split and spelled
        self.model = Tokenizer(self.bpe.library.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        self.ends = np.zeros(max([*self.bpe.strings, *self.bpe.added.values()]) + 1, bool)
        self.ends[[i for i, t in self.bpe.strings.items() if t.endswith(self.bpe.end)]] = True

    def _ask(self, pieces: list[str]) -> dict[str, bytes]:
        """Pieces joined by spaces are one text for the library; each piece's last
        token carries the word end."""
        spelled = [self.bpe.spelled(p) for p in pieces]
        texts = [" ".join(spelled[lo:lo + 500]) for lo in range(0, len(spelled), 500)]
        got = [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.concatenate([np.array(x, "<u4") for x in got]) if got else np.zeros(0, "<u4")
        cut = np.flatnonzero(self.ends[ids]) + 1
        if len(cut) != len(pieces):
            raise ValueError("pieces and word ends differ")
        raw, at = ids.tobytes(), [0, *(4 * cut).tolist()]
        return {p: raw[a:b] for p, a, b in zip(pieces, at, at[1:])}

    def _make(self, words: list[str]) -> dict[str, bytes]:
        bpe = self.bpe
        pieces = [bpe.pieces(w) for w in words]
        odd = {w for w, own in zip(words, pieces) if any(p[0] == "\x00" for p in own)}
        done = self._ask(list({p for own in pieces for p in own if p[0] != "\x00"}))
        out = {w: done[own[0]] if len(own) == 1 else b"".join([done[p] for p in own]) for w, own in zip(words, pieces) if w not in odd}
        listed = sorted(odd)
        for w, e in zip(listed, bpe.library.encode_batch(listed, add_special_tokens=False) if listed else []):
            out[w] = np.array(e.ids, "<u4").tobytes()
        return out

    def documents(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids (as bytes) of all texts and each one's place."""
        v = vocabulary(column)
        return spread(self.memo.values(v.words, self._make), v.index, v.first)


_encoders: dict[str, _Encoder] = {}


def encoder(path: str) -> _Encoder:
    if path not in _encoders:
        _encoders[path] = _Encoder(path)
    return _encoders[path]


def _part(named: DataFrame, parts: int) -> Column:
    """The range of a row's id among ``parts`` ranges of about as many rows.  The
    bounds come from the ids alone; no text is read for them.  An id that is a bound
    of several ranges has its rows dealt over them by a hash of their text."""
    if parts < 2:
        return F.lit(0)
    share = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    bounds = named.agg(F.percentile_approx("id", share, max(10_000, 10 * parts)).alias("b")).first().b or []
    if not bounds:
        return F.lit(0)
    # at most parts - 1 distinct ids: where each begins and how many bounds it is
    at = np.unique(np.array(bounds, np.int64), return_index=True, return_counts=True)
    table = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(i).alias("i"), F.lit(n).alias("n"))
                      for b, i, n in zip(*(x.tolist() for x in at))])
    below = F.filter(table, lambda r: r.b <= F.col("id"))
    last = F.try_element_at(below, F.lit(-1))
    own = F.when(last.b == F.col("id"), last.i + F.pmod(F.xxhash64("text"), last.n + 1)).otherwise(last.i + last.n)
    return F.coalesce(own, F.lit(0)).cast("int")


def write_token_files(docs: DataFrame, path: str, text: str = "text", id_col: str = "doc_id", tokenizer: str | None = None,
                      end_id: int = 2, bits: int = 8, block: int = BLOCK, file_ids: int = FILE_IDS) -> None:
    """Write the ids of all documents, each with ``end_id`` appended, in ascending
    id order: rows (part, file, start in the part, n_tokens, doc_ids, content)."""
    spark = docs.sparkSession
    ship_package(spark)
    model = tokenizer or public_path()
    end = np.array([end_id], "<u4").tobytes()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    ordered = (named.repartitionById(parts, _part(named, parts)).withColumn("tie", F.xxhash64("text"))
               .sortWithinPartitions("id", "tie"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, start = TaskContext.get().partitionId(), 0, 0
        ids: list[bytes] = []
        names: list[int | None] = []
        held = 0

        def flush():
            nonlocal number, start, ids, names, held
            lengths = np.array([len(x) // 4 for x in ids], np.int64)
            body = write_file(np.frombuffer(b"".join(ids), "<u4"), lengths, bits, block)
            row = pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "file": pa.array([number], pa.int32()), "start": pa.array([start], pa.int64()),
                "n_tokens": pa.array([held], pa.int64()), "doc_ids": pa.array([names], pa.list_(pa.int64())), "content": pa.array([body], pa.binary())})
            number, start, ids, names, held = number + 1, start + held, [], [], 0
            return row

        for batch in merged(batches, "text", SLICE):
            for lo, n in slices(batch.column("text"), SLICE):
                piece = batch.slice(lo, n)
                raw, at = encoder(model).documents(piece.column("text"))
                raw = raw.tobytes()
                for name, a, b in zip(piece.column("id").to_pylist(), at.tolist(), at[1:].tolist()):
                    ids.append(raw[a:b] + end)
                    names.append(name)
                    held += (b - a) // 4 + 1
                    if held >= file_ids:
                        yield flush()
        if ids:
            yield flush()
        forget(_encoders)

    (ordered.select("id", "text").mapInArrow(run, "part int, file int, start long, n_tokens long, doc_ids array<long>, content binary")
     .write.option("compression", "uncompressed").parquet(path))


def read_token_files(spark, path: str) -> DataFrame:
    """One row per document from the files: id, ``start``, ``n_tokens``, ``ids``
    (little-endian unsigned 32-bit) and ``ids_crc32``."""
    files = spark.read.parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # one row a part: as many as the writing job had tasks
    first = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                content = batch.column("content")[i].as_py()
                lengths = read_lengths(content)
                raw = read_ids(content).tobytes()
                at = np.concatenate([[0], np.cumsum(lengths)])
                ids = [raw[4 * a:4 * b] for a, b in zip(at[:-1], at[1:])]
                names = batch.column("doc_ids")[i].values
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(at[:-1] + batch.column("base")[i].as_py() + batch.column("start")[i].as_py(), pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(ids, pa.binary()), pa.array([zlib.crc32(x) for x in ids], pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids", "ids_crc32"])

    return (files.join(F.broadcast(first), "part").select("start", "base", "doc_ids", "content")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary, ids_crc32 long"))


def op5_token_files(spark, sf_dir: str) -> DataFrame:
    """Contract query: whole ``documents``, end id 2, files written and read back."""
    path = scratch_path(spark, "token-files")
    write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
