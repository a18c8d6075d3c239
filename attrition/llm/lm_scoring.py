"""LM scoring by deleted interpolation.

A document's tokens are its words and one end token.  Bigram and unigram
maximum-likelihood estimates and the uniform distribution are mixed:

    p(w | h) = a_b c(h, w) / c(h)  +  u_b c(w) / N  +  z_b / (V + 1)

The weights (a, u, z) belong to the context-frequency bucket b, the number of
binary digits of c(h) (0: unseen context, where a = 0).  They are learned by
expectation-maximisation on held-out counts: the training documents are split by
a hash of their id, counts come from the kept part and EM maximises the
likelihood of the held-out part.  The final model uses the counts of all
training documents with these weights.

Counts are exact sums over the corpus (``chunks.py``): unigrams by 64-bit hash,
bigrams by 48-bit fingerprint (a model statistic; a collision adds two counts).
For EM each held-out token is reduced to its bucket and its two estimates
relative to the uniform one, rounded to 1/16 in log2; the table of these cells
has a size fixed by those parameters and is summed by Spark before it goes to
the driver.

Order 2 and not more: with 16 binary digits more a trigram exchange of these
sizes would pass the disk budget, and in the given corpora 70 % of all trigrams
occur once.

Defined cases: null text is an empty text (its only token is the end); null ids
are not training documents; repeated rows count as often as they occur; without
any training document all estimates are 0 except the uniform one; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.chunks import bucket_count, cuts, expand, pack, squeeze, unpack_batch, with_answers
from attrition.llm.words import mix64, split_words
from attrition.session import write_table

END = np.uint64(0x452821E638D01377)
BEGIN = np.uint64(0xBE5466CF34E90C6C)
KEPT, HELD, OTHER = 0, 1, 2
BUCKETS = 40
STEP = 16
SPAN = 64 * STEP
_BIGRAM_MASK = np.uint64(0xFFFFFFFFFFFF0000)

_ASK = "cid long, split int, kind int, bucket int, keys binary, count binary"
_ANSWER = "cid long, kind int, bucket int, kept binary, held binary, v_kept long, v_all long, n_kept long, n_all long"


def _tokens(column: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of all texts, contexts (the token before), first token of each text."""
    w = split_words(column, lower=lower)
    n_docs = len(w.first) - 1
    first = w.first + np.arange(n_docs + 1)
    tokens = np.empty(first[-1], np.uint64)
    tokens[np.arange(len(w.hash)) + w.doc()] = w.hash
    tokens[first[1:] - 1] = END
    context = np.empty_like(tokens)
    context[1:] = tokens[:-1]
    context[first[:-1]] = BEGIN
    return tokens, context, first


def _bigrams(tokens, context):
    return mix64(context * np.uint64(0x9FB21C651E98DF25) + tokens) & _BIGRAM_MASK


def _add(pdf: pd.DataFrame) -> pd.DataFrame:
    """One bucket of one kind: corpus counts for the keys of each chunk."""
    keys = [expand(x, np.uint64) for x in pdf["keys"]]
    n = np.concatenate([expand(x, np.uint32) for x in pdf["count"]]).astype(np.int64)
    split = np.repeat(pdf["split"].to_numpy(), [len(k) for k in keys])
    distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
    kept = np.bincount(where, weights=n * (split == KEPT), minlength=len(distinct)).astype(np.uint64)
    held = np.bincount(where, weights=n * (split == HELD), minlength=len(distinct)).astype(np.uint64)
    ends = np.cumsum([len(k) for k in keys])
    out = pd.DataFrame({
        "cid": pdf["cid"], "kind": pdf["kind"], "bucket": pdf["bucket"],
        "kept": [squeeze(kept[where[e - len(k):e]]) for e, k in zip(ends, keys)],
        "held": [squeeze(held[where[e - len(k):e]]) for e, k in zip(ends, keys)]})
    totals = [int((kept > 0).sum()), int((kept + held > 0).sum()), int(kept.sum()), int((kept + held).sum())]
    for name, v in zip(("v_kept", "v_all", "n_kept", "n_all"), totals):
        out[name] = [v] + [0] * (len(out) - 1)
    return out


def _counts(tokens, context, answers):
    """(kept, held) counts of each token, of each context and of each bigram."""
    out = []
    for kind, values in ((1, tokens), (2, _bigrams(tokens, context))):
        keys, where = np.unique(values, return_inverse=True)
        own = sorted((r for r in answers or [] if r["kind"] == kind), key=lambda r: r["bucket"])
        for part in ("kept", "held"):
            got = np.concatenate([expand(r[part], np.uint64) for r in own]) if own else np.zeros(0, np.uint64)
            if len(got) != len(keys):
                raise ValueError(f"{len(got)} counts for {len(keys)} keys")
            out.append(got[where].astype(np.float64))
    return out


def _of_context(token_counts, context):
    """A context's count is that of the token before, and at a text's start that
    of the end token: each training text has one of either."""
    out = np.empty_like(token_counts)
    out[1:] = token_counts[:-1]
    begin = np.flatnonzero(context == BEGIN)
    ends = np.append(begin[1:], len(context)) - 1
    out[begin] = token_counts[ends]
    return out


def _bucket(context_counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(context_counts)[1], BUCKETS - 1)


def _cell(ratio: np.ndarray) -> np.ndarray:
    """log2 of a ratio in steps; -1 for a ratio of 0."""
    with np.errstate(divide="ignore"):
        q = np.round(np.log2(ratio) * STEP)
    return np.where(ratio > 0, np.clip(q, -SPAN, SPAN) + SPAN, -1).astype(np.int64)


def learn_weights(cells: pd.DataFrame, rounds: int = 200, tolerance: float = 1e-7) -> np.ndarray:
    """EM for each bucket: ``cells`` has bucket, bi, uni (cells), n.  Returns
    (BUCKETS, 3) weights of bigram, unigram and uniform estimates.  A bucket
    without held-out tokens takes those of the next lower one (0: unigram-led)."""
    weights = np.zeros((BUCKETS, 3))
    last = None
    for b in range(BUCKETS):
        own = cells[cells["bucket"] == b]
        start = np.array([0.0, 0.9, 0.1]) if b == 0 else np.array([1.0, 1.0, 1.0]) / 3
        if own.empty:
            weights[b] = start if last is None or (b and last[0] == 0 and b == 1) else last
        else:
            value = lambda q: np.where(q >= 0, np.exp2((np.maximum(q, 0) - SPAN) / STEP), 0.0)
            p = np.stack([value(own["bi"].to_numpy()), value(own["uni"].to_numpy()), np.ones(len(own))], 1)
            n = own["n"].to_numpy().astype(float)
            lam = start
            for _ in range(rounds):
                part = p * lam
                new = (part / part.sum(1, keepdims=True) * n[:, None]).sum(0) / n.sum()
                done = np.abs(new - lam).max() < tolerance
                lam = new
                if done:
                    break
            weights[b] = lam
        if b:
            last = weights[b]
        # the uniform part never vanishes: every text has a finite score
        weights[b] = np.maximum(weights[b], [0, 0, 1e-6])
        weights[b] /= weights[b].sum()
    return weights


def score_documents(docs: DataFrame, train, text: str = "text", id_col: str = "doc_id", held_every: int = 10,
                    lower: bool = False) -> DataFrame:
    """One row per document: id, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``train_types``, ``base_score`` (add-half unigram) and ``score``.  ``train``:
    boolean column of the training documents; one in ``held_every`` of them, by a
    hash of the id, is held out for EM.  ``lower`` takes A-Z as a-z."""
    fold = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("held")), F.lit(held_every))
    split = F.when(F.coalesce(train, F.lit(False)), F.when(fold == 0, HELD).otherwise(KEPT)).otherwise(OTHER)
    chunks = pack(docs.select(id_col, text), text, split)
    buckets = bucket_count(chunks)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cid, split, payload in zip(batch.column("cid").to_pylist(), batch.column("split").to_pylist(), batch.column("payload")):
                tokens, context, _ = _tokens(unpack_batch(payload.as_py()).column(text), lower)
                for kind, values in ((1, tokens), (2, _bigrams(tokens, context))):
                    keys, n = np.unique(values, return_counts=True)
                    at = cuts(keys, buckets)
                    own = [(b, i, j) for b, (i, j) in enumerate(zip(at[:-1], at[1:])) if j > i]
                    yield pa.RecordBatch.from_pydict({
                        "cid": pa.array([cid] * len(own), pa.int64()), "split": pa.array([split] * len(own), pa.int32()),
                        "kind": pa.array([kind] * len(own), pa.int32()), "bucket": pa.array([b for b, _, _ in own], pa.int32()),
                        "keys": pa.array([squeeze(keys[i:j]) for _, i, j in own], pa.binary()),
                        "count": pa.array([squeeze(n[i:j].astype(np.uint32)) for _, i, j in own], pa.binary())})

    answers = write_table(
        chunks.select("cid", "split", "payload")
        .mapInArrow(ask, _ASK)
        .groupBy("kind", "bucket").applyInPandas(_add, _ANSWER), "counts")
    v_kept, v_all, n_kept, n_all = (
        x or 0 for x in answers.where("kind = 1").agg(F.sum("v_kept"), F.sum("v_all"), F.sum("n_kept"), F.sum("n_all")).first())

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, own in zip(batch.column("payload"), batch.column("answers")):
                tokens, context, _ = _tokens(unpack_batch(payload.as_py()).column(text), lower)
                kept, _, pair, _ = _counts(tokens, context, own.as_py())
                before = _of_context(kept, context)
                bi = np.divide(pair, before, out=np.zeros_like(pair), where=before > 0) * (v_kept + 1)
                key = np.stack([_bucket(before), _cell(bi), _cell(kept / max(n_kept, 1) * (v_kept + 1))], 1)
                distinct, n = np.unique(key, axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(distinct[:, i], pa.int64()) for i in range(3)] + [pa.array(n, pa.int64())], names=["bucket", "bi", "uni", "n"])

    asked = answers.select("cid", "kind", "bucket", "kept", "held")
    learned = learn_weights(
        with_answers(chunks.where(F.col("split") == HELD), asked).select("payload", "answers")
        .mapInArrow(cells, "bucket long, bi long, uni long, n long")
        .groupBy("bucket", "bi", "uni").agg(F.sum("n").alias("n")).toPandas())
    id_type = docs.schema[id_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, own in zip(batch.column("payload"), batch.column("answers")):
                body = unpack_batch(payload.as_py())
                tokens, context, first = _tokens(body.column(text), lower)
                kept, held, pair_kept, pair_held = _counts(tokens, context, own.as_py())
                c, pair = kept + held, pair_kept + pair_held
                before = _of_context(c, context)
                lam = learned[_bucket(before)]
                p = np.divide(pair, before, out=np.zeros_like(pair), where=before > 0) * lam[:, 0]
                p += c / max(n_all, 1) * lam[:, 1] + lam[:, 2] / (v_all + 1)
                base = np.log10((c + 0.5) / (n_all + 0.5 * (v_all + 1)))
                add = lambda x: np.add.reduceat(x, first[:-1]) if len(first) > 1 else x[:0]
                yield pa.RecordBatch.from_arrays(
                    [body.column(id_col), pa.array(np.diff(first), pa.int64()), pa.array(add((c > 0).astype(np.int64)), pa.int64()),
                     pa.array(np.full(len(first) - 1, n_all), pa.int64()), pa.array(np.full(len(first) - 1, v_all), pa.int64()),
                     pa.array(add(base), pa.float64()), pa.array(add(np.log10(p)), pa.float64())],
                    names=[id_col, "n_tokens", "n_known", "train_tokens", "train_types", "base_score", "score"])

    return with_answers(chunks, asked).select("payload", "answers").mapInArrow(
        score, f"`{id_col}` {id_type}, n_tokens long, n_known long, train_tokens long, train_types long, base_score double, score double")


def perplexity(score, n_tokens):
    """Column: perplexity a token of a log10 ``score``."""
    return F.pow(F.lit(10.0), -score / n_tokens)


def op1_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """Contract query: lower-cases A-Z, learns from documents with crc32(doc_id) mod 5 <> 1."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 5
    scored = score_documents(docs, remainder != 1, lower=True)
    return scored.select("doc_id", (remainder == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score", perplexity(F.col("score"), F.col("n_tokens")).alias("perplexity"))
