"""Language identification by rank-order n-gram profiles (out-of-place distance).

Letters in lower case; everything else separates words; 1- to 3-grams within
words that are padded by one blank on either side.  A language's profile is its
``profile`` most frequent n-grams in the training documents, by rank.  A
document's own ``profile`` most frequent n-grams are compared to each language's:
the distance is the sum of rank differences, an n-gram that a language doesn't
have counts ``profile``.  The nearest language wins (ties: the smaller name);
``score`` is 1 minus the distance's share of the largest possible.

N-gram counts per language are summed map-side over all training documents; what
reaches the driver is ``profile`` rows a language.  In a document, n-grams outside
every profile still take their rank; they are told apart by a 15-bit hash.

Defined cases: null text or text without a letter is ``und`` with score 0; null
languages are not learned; without any training document everything is ``und``;
repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attrition.llm.bpe import slices
from attrition.llm.words import mix64, returning
from attrition.session import ship_package

PROFILE = 400
UNKNOWN_BITS = 15
SLOT_BITS = 20
COUNT_BITS = 17          # slots for the n-grams of a slice
SLICE = 1 << 18          # bytes of text at a time: a byte takes about 130 while n-grams are placed
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Code point → lower-case code point of a letter, else 0."""
    if not _letters:
        table = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _letters.append(table)
    return _letters[0]


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams (three 21-bit code points, blank 0) of all texts and the
    number of the text each comes from."""
    # three characters between texts: no n-gram with a letter spans two texts
    joined = "\n\n\n".join([t or "" for t in texts]).encode("utf-32-le", "surrogatepass")
    c = _letter_table()[np.frombuffer(joined, "<u4")].astype(np.uint64)
    size = np.fromiter((len(t or "") + 3 for t in texts), np.int64, len(texts))
    doc = np.repeat(np.arange(len(texts)), size)[:len(c)]
    edge = np.concatenate([[np.uint64(0)], c, [np.uint64(0)]])
    before, after = edge[:-2], edge[2:]
    one = np.flatnonzero(c)
    head = np.flatnonzero((c > 0) & (before == 0))
    parts = [
        _pack(1, _BLANK, _BLANK, c[one]),
        _pack(2, _BLANK, c[one], after[one]),               # letter and letter, or letter and blank
        _pack(2, _BLANK, _BLANK, c[head]),                  # blank and letter
        _pack(3, before[one], c[one], after[one]),
    ]
    return np.concatenate(parts), np.concatenate([doc[one], doc[one], doc[head], doc[one]])


_BLANK = np.uint64(0)


def _pack(kind: int, a, b, c) -> np.ndarray:
    """Three code points of 20 bits (letters stay below 0x32000) and the n-gram's size."""
    return np.uint64(kind) << np.uint64(60) | a << np.uint64(40) | b << np.uint64(20) | c


def _count(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and their counts, through a direct table where slots are
    unambiguous (much faster than sorting); the rest is sorted."""
    slot = (mix64(codes) >> np.uint64(64 - COUNT_BITS)).astype(np.int64)
    owner = np.zeros(1 << COUNT_BITS, np.uint64)
    owner[slot] = codes
    mine = owner[slot] == codes
    n = np.bincount(slot[mine], minlength=1 << COUNT_BITS)
    used = np.flatnonzero(n)
    other, m = np.unique(codes[~mine], return_counts=True)
    return np.concatenate([owner[used], other]), np.concatenate([n[used], m])


class Profiles:
    """Language profiles and the document side of the comparison."""

    def __init__(self, rows: list[tuple[str, int, int]], profile: int):
        """``rows``: (language, code, rank)."""
        self.profile = profile
        self.langs = sorted({r[0] for r in rows})
        codes = np.array(sorted({r[1] for r in rows}), np.uint64)
        self.codes = codes
        self.rank = np.full((len(self.langs), len(codes) + (1 << UNKNOWN_BITS)), -1, np.int32)
        for lang, code, rank in rows:
            self.rank[self.langs.index(lang), np.searchsorted(codes, np.uint64(code))] = rank

    def place(self, codes: np.ndarray) -> np.ndarray:
        """Index of each n-gram: its place among the known ones, or a hash beyond them."""
        hashed = mix64(codes)
        at = len(self.codes) + (hashed >> np.uint64(64 - UNKNOWN_BITS)).astype(np.int64)
        if not hasattr(self, "table"):
            own = (mix64(self.codes) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
            self.table = np.full(1 << SLOT_BITS, -1, np.int32)
            self.table[own] = np.arange(len(self.codes))
            lost = np.flatnonzero(self.table[own] != np.arange(len(self.codes)))
            self.lost = lost
        found = self.table[(hashed >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
        known = found >= 0
        known[known] = self.codes[found[known]] == codes[known]
        at[known] = found[known]
        for i in self.lost:
            at[codes == self.codes[i]] = i
        return at

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = [], []
        codes, doc = grams(texts)
        if not len(self.langs) or not len(codes):
            return ["und"] * len(texts), [0.0] * len(texts)
        at = self.place(codes)
        order = np.argsort(doc, kind="stable")
        at, first = at[order], np.searchsorted(doc[order], np.arange(len(texts) + 1))
        for a, b in zip(first[:-1], first[1:]):
            if a == b:
                langs.append("und")
                scores.append(0.0)
                continue
            n = np.bincount(at[a:b], minlength=self.rank.shape[1])
            used = np.flatnonzero(n)
            # most frequent first; ties by index
            top = used[np.argsort(-n[used], kind="stable")][:self.profile]
            theirs = self.rank[:, top]
            apart = np.where(theirs >= 0, np.abs(theirs - np.arange(len(top))), self.profile).sum(axis=1)
            best = int(np.argmin(apart))
            langs.append(self.langs[best])
            scores.append(float(1 - apart[best] / (self.profile * len(top))))
        return langs, scores


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", profile: int = PROFILE) -> list[tuple[str, int, int]]:
    """``(language, n-gram, rank)`` from all rows of ``docs``: ``profile`` rows a language."""
    ship_package(docs.sparkSession)

    @returning
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, n in slices(batch.column("text"), SLICE):
                part = batch.slice(lo, n)
                names = np.array(part.column("lang").to_pylist(), object)
                texts = np.array(part.column("text").to_pylist(), object)
                for name in sorted(set(names.tolist())):
                    codes, _ = grams(texts[names == name].tolist())
                    keys, m = _count(codes)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(m, pa.int64())],
                                                     names=["lang", "code", "n"])

    source = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = source.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    return [(r["lang"], r["code"], r["rank"] - 1) for r in counts.withColumn("rank", rank).where(F.col("rank") <= profile).collect()]


def identify(docs: DataFrame, profiles: list[tuple[str, int, int]], text: str = "text", profile: int = PROFILE) -> DataFrame:
    """All rows of ``docs`` with ``lang_pred`` and ``score``; input columns of these
    names are replaced."""
    from pyspark.sql import types as T
    ship_package(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")
    names = docs.columns
    held = docs.sparkSession.sparkContext.broadcast(profiles)   # profile rows a language

    @returning
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Profiles(held.value, profile)
        for batch in batches:
            for lo, n in slices(batch.column(text), SLICE):
                part = batch.slice(lo, n)
                langs, scores = model.predict(part.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                                 names=[*names, "lang_pred", "score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    """Contract query: learns from documents with crc32(doc_id) mod 4 <> 2."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 4
    profiles = learn_profiles(docs.where(remainder != 2))
    return identify(docs.select("doc_id", "text"), profiles).select("doc_id", (remainder == 2).alias("held_out"), "lang_pred", "score")
