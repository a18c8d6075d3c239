"""Substring deduplication with repeated-phrase automata.

A window is ``window`` consecutive words of one document.  Every word covered
by a window whose word sequence also starts anywhere else (same document
included) is removed; windows are judged on the input.

1. *Candidates.* Each window names its smallest k-gram hash (equal windows name
   the same one).  Counting the named k-grams over the corpus leaves only the
   windows whose k-gram is named at two places at least.
2. *Confirmed passages.* The candidates' 96-bit sequence hashes are counted over
   the corpus; a maximal run of recurring windows is a passage.
3. *Automata.* Each chunk's distinct passages are compiled into Aho-Corasick
   automata (pyahocorasick, sharded by ``automaton_words``), and the documents of
   the chunk that hold one are streamed through them; the places found are the words
   to remove.  A passage longer than ``PIECE`` windows' words is cut into pieces of that
   length which share all but one word of a window, so that no automaton holds more
   than ``automaton_words`` words and few passages end at one place, however long or
   repetitive a text is.

Both counts are exact exchanges of packed arrays (``chunks.py``).

Defined cases: null text has no words, removes nothing and stays null; a text of
fewer than ``window`` words loses nothing; repeated rows are documents of their
own, so both lose their windows; an empty table gives an empty result; an input
column named like a result column is replaced by the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.llm.chunks import bucket_count, cuts, expand, pack, squeeze, unpack_batch, with_answers
from attrition.llm.words import Words, give_back, returning, sequence_hash, split_words
from attrition.session import write_table

WINDOW = 35
GRAM = 12
PIECE = 4               # windows' words in a piece of a passage
CHUNK_BYTES, BUCKET_BYTES = 2 << 20, 32 << 20
AUTOMATON_WORDS = 500_000
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
RESULT = [T.StructField("kept_text", T.StringType()), T.StructField("n_words", T.LongType()),
          T.StructField("n_removed", T.LongType()),
          T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType())))]


def _sliding(a: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` (minimum or maximum) over every ``width`` consecutive elements."""
    out, have = a, 1
    while have < width:
        step = min(have, width - have)
        out = op(out[:len(out) - step], out[step:])
        have += step
    return out


def _named(w: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Window starts, the k-gram each names, distinct named k-grams and the
    number of places (2 stands for more) at which each is named."""
    none = np.zeros(0, np.uint64)
    left = w.left()
    if len(w.hash) < window:
        return np.zeros(0, np.int64), none, none, np.zeros(0, np.uint8)
    g = sequence_hash(w.hash, gram)
    g[left[:len(g)] < gram] = _TOP
    low = _sliding(g, window - gram + 1, np.minimum)
    valid = left[:len(low)] >= window
    starts = np.flatnonzero(valid)
    pad = np.zeros(window - gram, np.uint64)
    high = _sliding(np.concatenate([pad, np.where(valid, low, np.uint64(0)), pad]), window - gram + 1, np.maximum)
    keys, n = np.unique(g[(high == g) & (g != _TOP)], return_counts=True)
    return starts, low[starts], keys, np.minimum(n, 2).astype(np.uint8)


def _candidates(w: Words, window: int, gram: int, flags: np.ndarray):
    """Candidate window starts and, of the distinct ones, the 96-bit hashes, the
    number of places and each start's index."""
    starts, named, keys, _ = _named(w, window, gram)
    if len(starts):
        starts = starts[flags[np.searchsorted(keys, named)]]
    if not len(starts):
        return starts, np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint8), starts
    a = sequence_hash(w.hash, window)[starts]
    b = (sequence_hash(w.hash, window, seed=1)[starts] >> np.uint64(32)).astype(np.uint32)
    order = np.lexsort((b, a))
    sa, sb = a[order], b[order]
    new = np.concatenate([[True], (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])])
    at = np.flatnonzero(new)
    index = np.empty(len(order), np.int64)
    index[order] = np.cumsum(new) - 1
    n = np.minimum(np.diff(np.append(at, len(order))), 2).astype(np.uint8)
    return starts, sa[at], sb[at], n, index


def _flags(answers, kind: int, n_keys: int) -> np.ndarray:
    """A chunk's recurring flags of one kind, in key order."""
    own = [r for r in (answers if answers is not None else []) if r["kind"] == kind]
    parts = [np.unpackbits(np.frombuffer(r["mask"], np.uint8), count=r["n"]) for r in sorted(own, key=lambda r: r["bucket"])]
    out = np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)
    if len(out) != n_keys:
        raise ValueError(f"{len(out)} answers for {n_keys} keys")
    return out


def _recurring(pdf: pd.DataFrame) -> pd.DataFrame:
    """One bucket: which keys of each chunk are named at two places of the corpus."""
    keys = [expand(x, np.uint64) for x in pdf["keys"]]
    check = [expand(x, np.uint32) for x in pdf["check"]]
    n = np.concatenate([expand(x, np.uint8) for x in pdf["count"]]).astype(np.int64)
    a, b = np.concatenate(keys), np.concatenate(check)
    order = np.lexsort((b, a)) if len(b) else np.argsort(a, kind="stable")
    sa, sb = a[order], (b[order] if len(b) else None)
    new = np.ones(len(sa), bool)
    new[1:] = sa[1:] != sa[:-1] if sb is None else (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])
    group = np.cumsum(new) - 1
    total = np.add.reduceat(n[order], np.flatnonzero(new))
    flag = np.empty(len(sa), bool)
    flag[order] = total[group] > 1
    ends = np.cumsum([len(k) for k in keys])
    return pd.DataFrame({"cid": pdf["cid"], "kind": pdf["kind"], "bucket": pdf["bucket"], "n": [len(k) for k in keys],
                         "mask": [np.packbits(flag[e - len(k):e]).tobytes() for e, k in zip(ends, keys)]})


def _bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    """``_recurring``, giving memory back once its arrays are gone."""
    out = _recurring(pdf)
    give_back()
    return out


_ASK = "cid long, kind int, bucket int, keys binary, check binary, count binary"
_ANSWER = "cid long, kind int, bucket int, n long, mask binary"


def _ask(cid: int, kind: int, keys, check, count, buckets: int) -> pa.RecordBatch:
    at = cuts(keys, buckets)
    own = [(b, i, j) for b, (i, j) in enumerate(zip(at[:-1], at[1:])) if j > i]
    none = np.zeros(0, np.uint32)
    return pa.RecordBatch.from_pydict({
        "cid": pa.array([cid] * len(own), pa.int64()), "kind": pa.array([kind] * len(own), pa.int32()),
        "bucket": pa.array([b for b, _, _ in own], pa.int32()),
        "keys": pa.array([squeeze(keys[i:j]) for _, i, j in own], pa.binary()),
        "check": pa.array([squeeze(none if check is None else check[i:j]) for _, i, j in own], pa.binary()),
        "count": pa.array([squeeze(count[i:j]) for _, i, j in own], pa.binary())})


def _utf32(codes: np.ndarray) -> str:
    """One character a word; the surrogate range is left out."""
    codes = codes.astype(np.uint32)
    return np.where(codes >= 0xD800, codes + 0x800, codes).astype("<u4").tobytes().decode("utf-32-le")


def _pieces(lo: np.ndarray, hi: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Word ranges cut to at most ``PIECE * window`` words; every window stays whole in one."""
    size = PIECE * window
    n = np.maximum(1, -(-(hi - lo - window + 1) // (size - window + 1)))
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = np.repeat(lo, n) + k * (size - window + 1)
    # the last piece of a longer range has full length, too
    start = np.maximum(np.minimum(start, np.repeat(hi, n) - size), np.repeat(lo, n))
    return start, np.minimum(start + size, np.repeat(hi, n))


def _covered(w: Words, starts: np.ndarray, window: int, automaton_words: int) -> np.ndarray:
    """Words covered by an occurrence of a passage.  ``starts``: recurring windows."""
    cover = np.zeros(len(w.hash) + 1, np.int64)
    if not len(starts):
        return cover[:-1] > 0
    doc = np.searchsorted(w.first, starts, "right") - 1
    new = np.concatenate([[True], (np.diff(starts) != 1) | (np.diff(doc) != 0)])
    lo = starts[new]
    hi = starts[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)] + window
    docs = np.unique(doc)
    lo, hi = _pieces(lo, hi, window)
    at = 0
    while at < len(lo):
        # a shard: passages of at most automaton_words words
        stop = max(at + 1, int(np.searchsorted(np.cumsum(hi[at:] - lo[at:]), automaton_words, "right")) + at)
        inside = np.concatenate([w.hash[a:b] for a, b in zip(lo[at:stop], hi[at:stop])])
        vocab = np.unique(inside)
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        whole = _utf32(np.searchsorted(vocab, inside) + 1)
        ends = np.cumsum(hi[at:stop] - lo[at:stop])
        for phrase in {whole[e - n:e] for e, n in zip(ends, hi[at:stop] - lo[at:stop])}:
            automaton.add_word(phrase)
        automaton.make_automaton()
        for d in docs:
            a, b = w.first[d], w.first[d + 1]
            found = np.minimum(np.searchsorted(vocab, w.hash[a:b]), len(vocab) - 1)
            text = _utf32(np.where(vocab[found] == w.hash[a:b], found + 1, 0))
            for end, n in automaton.iter(text):
                cover[a + end + 1 - n] += 1
                cover[a + end + 1] -= 1
        at = stop
    return np.cumsum(cover[:-1]) > 0


def _spans(mask: np.ndarray) -> list[list[int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edge.reshape(-1, 2).tolist()


def remove_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, gram: int = GRAM,
                   automaton_words: int = AUTOMATON_WORDS) -> DataFrame:
    """All rows of ``docs`` with ``kept_text`` (kept words joined by one space,
    null for null), ``n_words``, ``n_removed`` and ``spans`` (removed word ranges
    ``[from, to)``)."""
    gram = min(gram, window)
    taken = {f.name for f in RESULT}
    if text in taken:
        raise ValueError(f"the text column can't be called {text}")
    docs = docs.drop(*taken)
    chunks = pack(docs, text, chunk_bytes=CHUNK_BYTES)
    buckets = bucket_count(chunks, BUCKET_BYTES)
    own_columns = docs.columns
    result_schema = T.StructType([*docs.schema.fields, *RESULT])

    @returning
    def ask_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cid, payload in zip(batch.column("cid").to_pylist(), batch.column("payload")):
                w = split_words(unpack_batch(payload.as_py()).column(text))
                _, _, keys, n = _named(w, window, gram)
                yield _ask(cid, 0, keys, None, n, buckets)

    @returning
    def ask_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cid, payload, answers in zip(batch.column("cid").to_pylist(), batch.column("payload"), batch.column("answers")):
                w = split_words(unpack_batch(payload.as_py()).column(text))
                flags = _flags(answers.as_py(), 0, len(_named(w, window, gram)[2]))
                _, keys, check, n, _ = _candidates(w, window, gram, flags)
                yield _ask(cid, 1, keys, check, n, buckets)

    @returning
    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, answers in zip(batch.column("payload"), batch.column("answers")):
                body = unpack_batch(payload.as_py())
                answers = answers.as_py()
                w = split_words(body.column(text))
                flags = _flags(answers, 0, len(_named(w, window, gram)[2]))
                starts, keys, _, _, index = _candidates(w, window, gram, flags)
                recurring = _flags(answers, 1, len(keys))
                gone = _covered(w, starts[recurring[index]] if len(starts) else starts, window, automaton_words)
                kept, n_removed, spans = [], [], []
                for d, value in enumerate(body.column(text)):
                    mask = gone[w.first[d]:w.first[d + 1]]
                    n = int(mask.sum())
                    own = b"" if not value.is_valid else value.as_buffer().to_pybytes()
                    words = _ascii_split(own)
                    kept.append(None if not value.is_valid else b" ".join(compress(words, ~mask) if n else words).decode())
                    n_removed.append(n)
                    spans.append(_spans(mask) if n else [])
                arrays = [body.column(c) for c in own_columns]
                arrays += [pa.array(kept, pa.string()), pa.array(np.diff(w.first), pa.int64()), pa.array(n_removed, pa.int64()),
                           pa.array(spans, pa.list_(pa.list_(pa.int32())))]
                yield pa.RecordBatch.from_arrays(arrays, names=[*own_columns, *(f.name for f in RESULT)])

    first = write_table(chunks.mapInArrow(ask_grams, _ASK).groupBy("kind", "bucket").applyInPandas(_bucket, _ANSWER), "grams")
    second = write_table(with_answers(chunks, first).select("cid", "payload", "answers").mapInArrow(ask_windows, _ASK)
                         .groupBy("kind", "bucket").applyInPandas(_bucket, _ANSWER), "windows")
    return (with_answers(chunks, first.unionByName(second)).select("payload", "answers")
            .mapInArrow(locate, result_schema))


def _ascii_split(text: bytes) -> list[bytes]:
    """bytes.split() cuts at exactly the six ASCII white space bytes."""
    return text.split()


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: whole ``documents``, windows of 35 words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT rn, i, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS h
  FROM (SELECT rn, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35)),
rec AS (SELECT rn, i FROM (SELECT rn, i, count(*) OVER (PARTITION BY h) AS n FROM win) WHERE n > 1),
words AS (SELECT rn, unnest(generate_series(1, len(w))) AS i, unnest(w) AS word FROM d WHERE len(w) > 0),
gone AS (
  SELECT words.rn, words.i, word, max(CASE WHEN rec.i IS NULL THEN 0 ELSE 1 END) OVER (
    PARTITION BY words.rn ORDER BY words.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
  FROM words LEFT JOIN rec ON rec.rn = words.rn AND rec.i = words.i),
kept AS (SELECT rn, sum(gone) AS n, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS t FROM gone GROUP BY rn)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rn)
"""
