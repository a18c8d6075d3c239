"""BPE encoding and decoding by prefix-sharing trie traversal.

Each task collects the distinct words of a slice of documents, inserts them into
a trie and walks it depth first, propagating the last token of every prefix's
encoding (``bpe.WordBpe.encode_trie``); documents are then put together from
their words.  Words already encoded in this process are taken from a bounded
memo.  No shuffle, no state beyond a task.

Decoding joins the tokens' strings by one space, as the file's library does
where the file names no decoder.

Defined cases: null text is an empty text (no ids, empty decoded text); repeated
rows give repeated results; an empty table gives an empty result; input columns
named like result columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.llm.bpe import WordMemo, forget, load, slices, spread, vocabulary
from attrition.session import ship_package

MEMO_WORDS = 80_000
RESULT = [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()), T.StructField("decoded", T.StringType())]


def public_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class _Codec:
    def __init__(self, path: str):
        self.bpe = load(path)
        self.memo = WordMemo(MEMO_WORDS)

    def _make(self, words: list[str]) -> dict[str, tuple[bytes, bytes]]:
        """Ids and decoded bytes (a space after each token) of white-space words."""
        bpe = self.bpe
        pieces = [bpe.pieces(w) for w in words]
        distinct = set().union(*pieces)
        spelled = {p: bpe.spelled(p) for p in distinct if not p.startswith("\x00\x00")}
        ids = bpe.encode_trie(list(set(spelled.values())))
        strings = bpe.strings
        done = {p: (np.array(ids[s], "<u4").tobytes(), (" ".join([strings[i] for i in ids[s]]) + " ").encode()) for p, s in spelled.items()}
        for p in distinct.difference(spelled):
            done[p] = np.array([bpe.added[p[2:]]], "<u4").tobytes(), (p[2:] + " ").encode()
        return {w: done[own[0]] if len(own) == 1 else (b"".join([done[p][0] for p in own]), b"".join([done[p][1] for p in own]))
                for w, own in zip(words, pieces)}

    def documents(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts and each one's place, decoded bytes and each one's place;
        every token's decoded bytes end with a space."""
        v = vocabulary(column)
        got = self.memo.values(v.words, self._make)
        return (*spread([x for x, _ in got], v.index, v.first), *spread([x for _, x in got], v.index, v.first))


_codecs: dict[str, _Codec] = {}


def codec(path: str) -> _Codec:
    if path not in _codecs:
        _codecs[path] = _Codec(path)
    return _codecs[path]


def encode_decode(docs: DataFrame, text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """All rows of ``docs`` with ``ids`` (little-endian unsigned 32-bit),
    ``n_tokens`` and ``decoded``."""
    path = tokenizer or public_path()
    ship_package(docs.sparkSession)
    docs = docs.drop(*(f.name for f in RESULT))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, n in slices(batch.column(text)):
                part = batch.slice(lo, n)
                ids, at, decoded, place = codec(path).documents(part.column(text))
                ids, decoded = ids.tobytes(), decoded.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array([ids[a:b] for a, b in zip(at[:-1], at[1:])], pa.binary()),
                     pa.array(np.diff(at) // 4, pa.int64()),
                     pa.array([decoded[a:max(a, b - 1)] for a, b in zip(place[:-1], place[1:])], pa.binary()).cast(pa.string())],
                    names=[*names, "ids", "n_tokens", "decoded"])
        forget(_codecs)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *RESULT]))


def op4_bpe_codec(spark, sf_dir: str) -> DataFrame:
    """Contract query: whole ``documents``, the public word BPE file."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode_decode(docs).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
