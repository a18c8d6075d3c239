"""Alignment of two tokenizers' tokens by pointer jumping.

A text is cut before every space that follows a character other than white space.
Neither tokenizer has a token across such a cut, so a text's tokens are those of its
segments, one after the other, and a distinct segment is encoded and aligned once
(a bounded memo keeps those in use).  A document is then put together from its
segments' counts, links and groups.

Alignment of many segments at once: all tokens of both sides lie on one byte line.
Every token points to the farthest-right token of the other side that it overlaps;
doubling the pointers until none changes brings each token to the terminal token of
its component, whose number labels the group (``component_ends``).

Corpus counts of linked id pairs: tasks write chunks of documents, each with its
distinct linked pairs and their number; pairs are summed by Spark, a pair row per
chunk at most (so a pair in every document is no hot key), and each chunk gets the
counts of its own pairs back.  Nothing else is sent between tasks, no text at all.

Defined cases: a text that is null, empty or not reproduced byte for byte by either
side has no tokens: zeros and an empty ``groups_sha256``; it adds no links to the
counts.  Rows that repeat, or have a null id, are documents like others; an empty
table gives an empty result; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attrition.llm.bpe import WordMemo, byte_alphabet, merged, slices, spread
from attrition.llm.chunks import expand, squeeze
from attrition.llm.words import give_back, range_hash, utf8
from attrition.session import ship_package, write_table

MEMO_SEGMENTS = 120_000
CHUNK_BYTES = 8 << 20
#: Unicode white space beyond ASCII, as UTF-8 (fixed values): no cut is made after it.
_WIDE_SPACE = [bytes(s, "utf-8") for s in "\x85\xa0                　"]


def cut_points(data: np.ndarray) -> np.ndarray:
    """Places of the spaces that begin a segment (``data``: UTF-8 bytes)."""
    at = np.flatnonzero(data == 0x20)
    at = at[at > 0]
    before = data[at - 1]
    at, before = at[(before > 0x20) & (before != 0x7F)], before[(before > 0x20) & (before != 0x7F)]
    wide = np.zeros(len(at), bool)
    for space in _WIDE_SPACE:
        n = len(space)
        same = (before == space[-1]) & (at >= n)
        for i in range(2, n + 1):
            same &= data[np.maximum(at - i, 0)] == space[-i]
        wide |= same
    return at[~wide]


def component_ends(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of two sides that tile the same bytes, by their end places: the label of
    each token's component, for both sides (the terminal token's number)."""
    n_a, n_b = len(a_end), len(b_end)
    if not n_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # the token of the other side that holds a token's last byte is its farthest overlap
    to_b = np.searchsorted(b_end, a_end, "left") + n_a
    to_a = np.searchsorted(a_end, b_end, "left")
    jump = np.concatenate([to_b, to_a])
    # two last tokens that end together point to each other: the A side's is terminal
    ends = np.arange(n_a)[b_end[to_b - n_a] == a_end]
    jump[ends] = ends
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            return jump[:n_a], jump[n_a:]
        jump = further


def overlaps(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all overlapping pairs of tokens, in the order of A, then B."""
    first = np.searchsorted(b_end, np.concatenate([[0], a_end[:-1]]), "right")
    n = np.searchsorted(b_end, a_end, "left") - first + 1
    a = np.repeat(np.arange(len(a_end)), n)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(n) - n - first, n)


class Tokenizers:
    """Side A: a byte-level BPE file; side B: a sentencepiece BPE model with byte
    fallback that adds a space before a text."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        byte_of = {c: b for b, c in byte_alphabet().items()}
        vocab = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.cuts = not any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(len(self.b_bytes)))
        self.a_size, self.b_size = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        # a token's number with what follows it in a group's text
        self.a_text, self.b_text = (np.array([str(i).encode() + after for after in (b",", last) for i in range(len(side))], object)
                                    for side, last in ((self.a_bytes, b"|"), (self.b_bytes, b";")))
        self.memo = WordMemo(MEMO_SEGMENTS)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides of a text that begins with the space that side B adds; None
        where a side's bytes differ from the text."""
        a = self.a.encode(text, add_special_tokens=False).ids
        # the library adds no space to nothing
        b = self.b.encode(text[1:]) if text != " " else [self.b.piece_to_id("▁")]
        raw = text.encode()
        if b"".join([self.b_bytes[i] for i in b]) == raw == b"".join([self.a_bytes[i] for i in a]):
            return np.array(a, np.int64), np.array(b, np.int64)
        return None

    def align(self, segments: list[str]) -> dict[str, tuple[bytes, bytes]]:
        """Each segment's links (id pairs, two unsigned 32-bit numbers each, after three
        counts: A tokens, B tokens, groups) and its groups as text; empty where a side's
        bytes differ from the segment.  Segments that end visibly are encoded end to end,
        since both sides cut between them; one that doesn't come back is then alone."""
        out: dict[str, tuple[bytes, bytes]] = {}
        alone = [s for s in segments if s[-1].isspace() or "▁" in s]
        rest = segments
        if alone:
            odd = set(alone)
            rest = [s for s in segments if s not in odd]
        for lo in range(0, len(rest), 5000):
            block = rest[lo:lo + 5000]
            if not self._align(block, out):
                alone += block
        for s in alone:
            if not self._align([s], out):
                out[s] = b"", b""
        return out

    def _align(self, segments: list[str], out: dict) -> bool:
        got = self.encode("".join(segments))
        if got is None:
            return False
        a, b = got
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends = np.cumsum(np.fromiter((len(s.encode()) for s in segments), np.int64, len(segments)))
        at_a, at_b = (np.concatenate([[0], np.searchsorted(e, ends) + 1]) for e in (a_end, b_end))
        if not (np.array_equal(a_end[at_a[1:] - 1], ends) and np.array_equal(b_end[at_b[1:] - 1], ends)):
            return False
        label_a, label_b = component_ends(a_end, b_end)
        left, right = overlaps(a_end, b_end)
        pairs = np.empty((len(left), 2), "<u4")
        pairs[:, 0], pairs[:, 1] = a[left], b[right]
        at_link = (8 * np.searchsorted(left, at_a)).tolist()
        # a group's text: its A tokens, then its B tokens; the last of each is followed by its own mark
        last_a, last_b = (np.concatenate([x[1:] != x[:-1], [True]]) for x in (label_a, label_b))
        shown = np.concatenate([self.a_text[a + last_a * len(self.a_bytes)], self.b_text[b + last_b * len(self.b_bytes)]])
        order = np.argsort(np.concatenate([2 * label_a, 2 * label_b + 1]), kind="stable")
        shown, at_shown = shown[order].tolist(), (at_a + at_b).tolist()
        n_groups = np.concatenate([[0], np.cumsum(last_a)])[at_a]
        counts = np.column_stack([np.diff(at_a), np.diff(at_b), np.diff(n_groups)]).astype("<u4").tobytes()
        links = pairs.tobytes()
        for i, s in enumerate(segments):
            out[s] = counts[12 * i:12 * i + 12] + links[at_link[i]:at_link[i + 1]], b"".join(shown[at_shown[i]:at_shown[i + 1]])
        return True

    def segments(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Segments of space + text (a list without most repetitions), the segment at each
        place, and the range of places of each text (none for an empty text)."""
        data, offsets = utf8(column)
        cuts = cut_points(data) if self.cuts else np.zeros(0, np.int64)
        begins = offsets[:-1][np.diff(offsets) > 0]
        start = np.union1d(begins, cuts).astype(np.int64)
        end = np.append(start[1:], len(data)) if len(start) else start
        begin = np.zeros(len(data) + 1, bool)
        begin[begins] = True
        opens = begin[start]
        _, at, index = np.unique(range_hash(data, start, end) + opens, return_index=True, return_inverse=True)
        raw = data.tobytes()
        names = [(b" " + raw[i:j] if o else raw[i:j]).decode() for i, j, o in zip(start[at].tolist(), end[at].tolist(), opens[at].tolist())]
        return names, index, np.searchsorted(start, offsets)


@dataclass
class Aligned:
    """Documents of a chunk: counts, digests, and their links as numbers of ``pairs``
    (A id << 32 | B id, ascending); document d's links are ``link[at[d]:at[d + 1]]``."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    digest: list[str]
    pairs: np.ndarray
    link: np.ndarray
    at: np.ndarray


def align_texts(column: pa.Array, tok: Tokenizers) -> Aligned:
    names, index, first = tok.segments(column)
    got = tok.memo.values(names, tok.align)
    bad = np.fromiter((not x for x, _ in got), bool, len(got))
    n_docs = len(first) - 1
    size = np.diff(first)
    # a document that holds a segment which doesn't come back has no tokens
    hurt = np.zeros(n_docs, bool)
    doc = np.repeat(np.arange(n_docs), size)
    hurt[doc[bad[index]]] = True
    index, doc = index[~hurt[doc]], doc[~hurt[doc]]
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    head = np.frombuffer(b"".join([x[:12] or bytes(12) for x, _ in got]), "<u4").reshape(-1, 3).astype(np.int64)
    total = np.vstack([np.zeros((1, 3), np.int64), np.cumsum(head[index], axis=0)])[first]
    n = np.ascontiguousarray(np.diff(total, axis=0).T)
    # link codes: distinct pairs of the chunk's segments
    flat = np.frombuffer(b"".join([x[12:] for x, _ in got]), "<u4").reshape(-1, 2).astype(np.uint64)
    pairs, code = np.unique(flat[:, 0] << np.uint64(32) | flat[:, 1], return_inverse=True)
    size = np.fromiter((max(0, len(x) - 12) // 8 for x, _ in got), np.int64, len(got))
    ends = np.cumsum(size)
    code = code.astype("<i4").tobytes()
    link, at = spread([code[4 * (e - s):4 * e] for s, e in zip(size.tolist(), ends.tolist())], index, first)
    text, place = spread([g for _, g in got], index, first)
    text = text.tobytes()
    digest = [hashlib.sha256(text[i:j - 1]).hexdigest() if j > i else "" for i, j in zip(place[:-1].tolist(), place[1:].tolist())]
    return Aligned(*n, digest, pairs, link.view("<i4"), at // 4)


_kept: dict[tuple[str, str], Tokenizers] = {}


def _tokenizers(a_path: str, b_path: str) -> Tokenizers:
    if (a_path, b_path) not in _kept:
        _kept[a_path, b_path] = Tokenizers(a_path, b_path)
    return _kept[a_path, b_path]


CHUNK = "cid long, ids binary, n_a binary, n_b binary, n_groups binary, digest binary, n_links binary, link binary, pairs binary, times binary"


def aligned_chunks(docs: DataFrame, text: str, id_col: str, a_path: str, b_path: str) -> DataFrame:
    """Written table of chunks of documents; arrays as ``squeeze`` packs them."""
    ship_package(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cid = TaskContext.get().partitionId() << 32
        for batch in merged(batches, "text", CHUNK_BYTES):
            for lo, n in slices(batch.column("text"), CHUNK_BYTES):
                part = batch.slice(lo, n)
                x = align_texts(part.column("text"), _tokenizers(a_path, b_path))
                used, link = np.unique(x.link, return_inverse=True)     # pairs of documents without tokens go
                ids = part.column("id")
                packed = [squeeze(ids.fill_null(0).to_numpy()), squeeze(x.n_a), squeeze(x.n_b), squeeze(x.n_groups),
                          squeeze(np.frombuffer(bytes.fromhex("".join(d or "00" * 32 for d in x.digest)), np.uint8)),
                          squeeze(np.diff(x.at)), squeeze(link.astype(np.int32)), squeeze(x.pairs[used]),
                          squeeze(np.bincount(link, minlength=len(used)).astype(np.int64))]
                known = squeeze(np.asarray(ids.is_valid()).astype(np.uint8))
                yield pa.RecordBatch.from_arrays([pa.array([cid], pa.int64()), *(pa.array([p], pa.binary()) for p in packed),
                                                  pa.array([known], pa.binary())], names=[*(c.split()[0] for c in CHUNK.split(", ")), "known"])
                cid += 1
        _kept.clear()
        gc.collect()
        give_back()

    return write_table(source.mapInArrow(run, CHUNK + ", known binary"), "aligned")


def pair_counts(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows ``(a, b, cid, i, n)``: a chunk's distinct pairs; and, once per pair of the
    corpus, ``(a, b, total, best)``: its links and whether no pair of ``b`` has more."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pairs, times = (expand(batch.column(c)[i].as_buffer(), t) for c, t in (("pairs", np.uint64), ("times", np.int64)))
                cid = batch.column("cid")[i].as_py()
                for lo in range(0, len(pairs), 100_000):
                    p = pairs[lo:lo + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((p >> np.uint64(32)).astype(np.int32)), pa.array((p & np.uint64(0xFFFFFFFF)).astype(np.int32)),
                         pa.array(np.full(len(p), cid)), pa.array(np.arange(lo, lo + len(p), dtype=np.int32)), pa.array(times[lo:lo + len(p)])],
                        names=["a", "b", "cid", "i", "n"])

    each = chunks.select("cid", "pairs", "times").mapInArrow(rows, "a int, b int, cid long, i int, n long")
    total = each.groupBy("a", "b").agg(F.sum("n").alias("total"))
    # partners of one B id are at most the vocabulary of A
    total = total.withColumn("best", F.col("total") == F.max("total").over(Window.partitionBy("b")))
    return each, write_table(total, "pair_counts")


def alignment(docs: DataFrame, text: str = "text", id_col: str = "doc_id", byte_bpe: str | None = None, piece_bpe: str | None = None) -> DataFrame:
    """One row per document: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum``, ``groups_sha256``."""
    import public_tokenizers
    a_path, b_path = byte_bpe or public_tokenizers.path("byte_bpe_50k.json"), piece_bpe or public_tokenizers.path("piece_bpe_32k.model")
    chunks = aligned_chunks(docs, text, id_col, a_path, b_path)
    each, total = pair_counts(chunks)
    answers = each.join(total, ["a", "b"]).select("cid", "i", "total", "best")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({f.name: pa.array([], f.type) for f in out}, schema=out)
        row = left.slice(0, 1).to_pydict()
        get = lambda c, t: expand(row[c][0], t)
        n_links, link = get("n_links", np.int64), get("link", np.int32)
        total, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        i = right.column("i").to_numpy()
        total[i], best[i] = right.column("total").to_numpy(), right.column("best").to_numpy()
        at = np.concatenate([[0], np.cumsum(n_links)])
        sums = [np.concatenate([[0], np.cumsum(v[link])]) for v in (best, total)]
        n_best, count_sum = (s[at[1:]] - s[at[:-1]] for s in sums)
        n_a, digest = get("n_a", np.int64), get("digest", np.uint8).tobytes().hex()
        shown = [digest[64 * k:64 * k + 64] if n else "" for k, n in enumerate(n_a.tolist())]
        ids = pa.array(get("ids", np.int64), mask=get("known", np.uint8) == 0)
        return pa.table([ids, *(pa.array(v) for v in (n_a, get("n_b", np.int64), get("n_groups", np.int64), n_links, n_best, count_sum)),
                         pa.array(shown, pa.string())], schema=out)

    out = pa.schema([pa.field(id_col, pa.int64()), *(pa.field(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
                     pa.field("groups_sha256", pa.string())])
    schema = f"`{id_col}` long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return (chunks.drop("pairs", "times").groupBy("cid").cogroup(answers.groupBy("cid")).applyInArrow(finish, schema))


def op13_token_alignment(spark, sf_dir: str) -> DataFrame:
    """Contract query: whole ``documents``, the two public vocabulary files."""
    return alignment(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
