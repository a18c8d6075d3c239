"""Toxicity by non-negative positive-unlabelled learning.

A logistic classifier on distinct hashed words is trained with numpy from
confirmed toxic documents (P) and a sample of all training text, taken as
unlabelled (U, confirmed ones included, so pi holds in it), with the class-prior-corrected risk

    R = pi * E_P[l(+f)] + max(0, E_U[l(-f)] - pi * E_P[l(-f)]),

l the logistic loss.  Where the estimate of the negative part falls below 0, a
step descends on that part alone, the other way round (the non-negative
correction).  pi is the share of toxic among all labelled training rows.  Steps
are Adagrad with a proximal L1 term.  Features seen in fewer than ``min_docs``
sampled documents, or whose document frequencies in P and U differ by fewer than
``min_z`` standard errors, keep weight 0: the many common words of a long text
would otherwise add up to noise.

The classifier is fitted on a bounded sample: at most about ``max_positive`` toxic
and ``max_unlabelled`` unlabelled training documents, chosen by a hash of the id (one text of an id that repeats); the
class prior and the scores cover all rows.  The sample is trained in one task
(its size is fixed by these parameters); the weights are one row of ``1 << bits``
numbers.

Defined cases: null text is an empty text, scored by the bias alone; null labels
and ids are not learned from; without a toxic training row or without training
text, every score is pi; repeated rows get equal scores; an empty table
gives an empty result; input columns named ``score`` or ``predicted`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.llm.bpe import slices
from attrition.llm.words import Words, split_words
from attrition.session import ship_package

BITS = 18
MAX_POSITIVE = 8_000
MAX_UNLABELLED = 24_000
MIN_DOCS = 8
MIN_Z = 4.0
THRESHOLD = 0.3


def features(w: Words, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed words of all texts, text by text, and where each begins."""
    place = (w.hash >> np.uint64(64 - bits)).astype(np.int64)
    distinct = np.unique(w.doc() << bits | place)
    return (distinct & (1 << bits) - 1), np.searchsorted(distinct, np.arange(len(w.first), dtype=np.int64) << bits)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def fit_nnpu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, size: int, min_docs: int = MIN_DOCS, min_z: float = MIN_Z,
             steps: int = 500, rate: float = 0.5, l1: float = 2e-5) -> tuple[np.ndarray, float]:
    """Weights and bias from feature lists of P and U documents (full batches:
    the sign of the negative part is noisy on small ones)."""
    in_p, in_u = (np.bincount(np.concatenate(x), minlength=size) for x in (positive, unlabelled))
    share = (in_p + in_u) / (len(positive) + len(unlabelled))
    error = np.sqrt(share * (1 - share) * (1 / len(positive) + 1 / len(unlabelled)))
    apart = np.abs(in_p / len(positive) - in_u / len(unlabelled))
    used = np.flatnonzero((in_p + in_u >= min_docs) & (apart >= min_z * error))
    column = np.full(size, -1)
    column[used] = np.arange(len(used))

    def pack(docs):
        own = [column[x] for x in docs]
        own = [x[x >= 0] for x in own]
        return np.concatenate(own), np.concatenate([[0], np.cumsum([len(x) for x in own])])

    (ip, fp), (iu, fu) = pack(positive), pack(unlabelled)
    rp, ru = (np.repeat(np.arange(len(f) - 1), np.diff(f)) for f in (fp, fu))
    w, bias = np.zeros(len(used)), float(np.log(prior / (1 - prior)))
    energy, bias_energy = np.full(len(used), 1e-8), 1e-8
    for _ in range(steps):
        sp, su = _sums(w[ip], fp) + bias, _sums(w[iu], fu) + bias
        negative = np.logaddexp(0, su).mean() - prior * np.logaddexp(0, sp).mean()
        # derivatives of the mean losses by the scores
        up, down, other = -_sigmoid(-sp) / len(sp), _sigmoid(sp) / len(sp), _sigmoid(su) / len(su)
        gp, gu = (prior * (up - down), other) if negative >= 0 else (prior * down, -other)
        g = np.bincount(ip, gp[rp], len(used)) + np.bincount(iu, gu[ru], len(used))
        energy += g ** 2
        scale = rate / np.sqrt(energy)
        moved = w - scale * g
        w = np.sign(moved) * np.maximum(np.abs(moved) - scale * l1, 0)
        gb = gp.sum() + gu.sum()
        bias_energy += gb ** 2
        bias -= rate / np.sqrt(bias_energy) * gb
    full = np.zeros(size)
    full[used] = w
    return full, bias


def train(docs: DataFrame, labels: DataFrame, usable, text: str = "text", id_col: str = "doc_id", label: str = "toxic",
          max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, bits: int = BITS) -> tuple[np.ndarray, float, float]:
    """(weights, bias, prior).  ``usable``: boolean column over ``id_col`` of the
    documents and labels that may be learned from."""
    ship_package(docs.sparkSession)
    marks = (labels.where(usable & F.col(label).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label).alias("toxic")))
    n_toxic, n_labelled = marks.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    n_toxic = n_toxic or 0
    prior = min(0.99, max(0.01, n_toxic / n_labelled)) if n_labelled else 0.01
    n_docs = docs.where(usable).count()
    if not n_toxic or not n_docs:
        return np.zeros(1 << bits), float(np.log(prior / (1 - prior))), prior

    def drawn(salt: str, share: float):
        return F.shiftrightunsigned(F.xxhash64(F.col("id"), F.lit(salt)), 11) < share * 2.0 ** 53

    # ids are chosen on narrow columns; text is read only for those, about max_positive + max_unlabelled at most
    positive = marks.where("toxic = 1").where(drawn("positive", max_positive / n_toxic)).select("id", F.lit(True).alias("positive"), F.lit(False).alias("unlabelled"))
    unlabelled = (docs.where(usable).select(F.col(id_col).alias("id")).where("id is not null").where(drawn("unlabelled", max_unlabelled / n_docs)).distinct()
                  .select("id", F.lit(False).alias("positive"), F.lit(True).alias("unlabelled")))
    chosen = positive.unionByName(unlabelled).groupBy("id").agg(F.max("positive").alias("positive"), F.max("unlabelled").alias("unlabelled"))
    sample = docs.where(usable).select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, n in slices(batch.column("text")):
                part = batch.slice(lo, n)
                ids, first = features(split_words(part.column("text"), lower=True, alnum=True), bits)
                ids = ids.astype("<u4")
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("positive"), part.column("unlabelled"),
                                                  pa.array([ids[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())],
                                                 names=["id", "positive", "unlabelled", "ids"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        chosen = {side: [np.frombuffer(x, "<u4").astype(np.int64) for x in sorted(pdf.loc[pdf[side], "ids"])] for side in ("positive", "unlabelled")}
        if not chosen["positive"] or not chosen["unlabelled"]:
            return pd.DataFrame({"weights": [np.zeros(1 << bits, "<f8").tobytes()], "bias": [float(np.log(prior / (1 - prior)))]})
        w, bias = fit_nnpu(chosen["positive"], chosen["unlabelled"], prior, 1 << bits)
        return pd.DataFrame({"weights": [w.astype("<f8").tobytes()], "bias": [bias]})

    # one text of an id that repeats, so that the sample stays bounded
    extracted = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("positive", T.BooleanType()),
                              T.StructField("unlabelled", T.BooleanType()), T.StructField("ids", T.BinaryType())])
    rows = (sample.mapInArrow(extract, extracted)
            .groupBy("id", "positive", "unlabelled").agg(F.min("ids").alias("ids")).drop("id")
            .groupBy(F.lit("sample").alias("all")).applyInPandas(fit, "weights binary, bias double").collect())
    if not rows:
        return np.zeros(1 << bits), float(np.log(prior / (1 - prior))), prior
    return np.frombuffer(rows[0]["weights"], "<f8"), rows[0]["bias"], prior


def score_toxicity(docs: DataFrame, weights: np.ndarray, bias: float, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All rows of ``docs`` with ``score`` and ``predicted``."""
    ship_package(docs.sparkSession)
    docs = docs.drop("score", "predicted")
    names = docs.columns
    bits = len(weights).bit_length() - 1
    held = docs.sparkSession.sparkContext.broadcast(weights)    # 1 << bits numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, n in slices(batch.column(text)):
                part = batch.slice(lo, n)
                ids, first = features(split_words(part.column(text), lower=True, alnum=True), bits)
                score = _sigmoid(_sums(held.value[ids], first) + bias)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32), pa.int32())],
                    names=[*names, "score", "predicted"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """Contract query: learns from rows with crc32(doc_id) mod 4 <> 2."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 4
    weights, bias, _ = train(docs, labels, remainder != 2)
    return score_toxicity(docs, weights, bias).select("doc_id", (remainder == 2).alias("held_out"), "score", "predicted")
