"""Licence scans with a positional rare-token index.

Templates are short licence statements.  Their words get an inverse document
frequency from all scanned documents; the index posts the positions of each
template's highest-IDF words: at least ``rare`` words, and two positions more than
the words that ``coverage`` lets differ.  A file looks up its places of these words;
each place votes for the template start it implies (file position minus template
position).  A start needs as many votes as postings must stand in place at the
coverage (postings minus words that may differ, two or more), so that none at the
coverage is lost.  There all template words are compared at their relative positions; a start is
accepted where at least ``coverage`` of them stand in place and every mandatory
key phrase of the template stands word for word within the aligned text.

Base phrases are found at every place where their words stand consecutively.

Defined cases: null text is an empty text; texts without words have no labels and
score 0; repeated rows get equal results; an empty table gives an empty result;
input columns named like result columns are replaced.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.llm.bpe import slices
from attrition.llm.words import Words, split_words
from attrition.session import ship_package

#: Base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Label → statements; every statement with its mandatory key phrases.
TEMPLATES = {
    "mit": [("released under the mit license", ["mit license"]),
            ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
             ["permission is hereby granted", "free of charge"])],
    "apache-2": [("licensed under the apache license version 2 0", ["apache license version 2"])],
    "cc-by-nc": [("licensed under cc by nc 4 0", ["cc by nc"])],
    "gpl-3": [("this work is licensed under the gnu general public license version 3", ["gnu general public license", "version 3"])],
    "gpl-2": [("this work is licensed under the gnu general public license version 2", ["gnu general public license", "version 2"])],
    "lgpl-3": [("licensed under the gnu lesser general public license version 3", ["gnu lesser general public license", "version 3"])],
    "mpl-2": [("subject to the terms of the mozilla public license v 2 0", ["mozilla public license"])],
    "bsd": [("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
             ["redistribution and use", "source and binary forms"])],
    "proprietary": [("all rights reserved no part may be reproduced without permission", ["all rights reserved"])],
}
RARE = 3
COVERAGE = 0.75
RESULT = [("n_words", T.LongType()), ("n_base", T.LongType()), ("first_word", T.LongType()), ("last_word", T.LongType()),
          ("base_labels", T.StringType()), ("labels", T.StringType()), ("score", T.DoubleType())]


def _hashes(phrase: str) -> np.ndarray:
    return split_words(pa.array([phrase]), lower=True, alnum=True).hash


def template_words() -> list[str]:
    return sorted({w for listed in TEMPLATES.values() for t, _ in listed for w in t.split()})


def document_frequency(docs: DataFrame, text: str = "text") -> dict[str, int]:
    """Documents that hold each template word, over all rows (one number a word)."""
    ship_package(docs.sparkSession)
    words = template_words()
    own = _hashes(" ".join(words))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(own)
        for batch in batches:
            n = np.zeros(len(own), np.int64)
            for lo, size in slices(batch.column("text")):
                w = split_words(batch.column("text").slice(lo, size), lower=True, alnum=True)
                at = np.minimum(np.searchsorted(own[order], w.hash), len(own) - 1)
                hit = np.flatnonzero(own[order][at] == w.hash)
                pairs = np.unique(w.doc()[hit] * len(own) + order[at[hit]])
                n += np.bincount(pairs % len(own), minlength=len(own))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n)], names=["word", "n"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {w: 0 for w in words} | {r["word"]: r["n"] for r in rows}


class LicenceIndex:
    def __init__(self, frequency: dict[str, int], n_docs: int, rare: int = RARE, coverage: float = COVERAGE):
        self.coverage = coverage
        self.base = [(label, _hashes(phrase)) for phrase, label in BASE.items()]
        self.templates: list[tuple[str, np.ndarray, list[np.ndarray]]] = []
        self.postings: dict[int, list[tuple[int, int]]] = {}
        self.needed: list[int] = []          # votes that a start of each template needs
        for label, listed in TEMPLATES.items():
            for text, keys in listed:
                words = text.split()
                number = len(self.templates)
                self.templates.append((label, _hashes(text), [_hashes(k) for k in keys]))
                idf = {w: math.log((n_docs + 1) / (frequency.get(w, 0) + 1)) for w in words}
                differ = len(words) - math.ceil(coverage * len(words))
                chosen: set[str] = set()
                for w in sorted(idf, key=lambda w: (-idf[w], w)):
                    if len(chosen) >= rare and sum(x in chosen for x in words) >= differ + 2:
                        break
                    chosen.add(w)
                self.needed.append(max(1, sum(x in chosen for x in words) - differ))
                for place, (w, h) in enumerate(zip(words, self.templates[-1][1].tolist())):
                    if w in chosen:
                        self.postings.setdefault(h, []).append((number, place))
        self.indexed = np.array(sorted(self.postings), np.uint64)

    def scan(self, w: Words):
        """Per text: (places of base phrases, base labels, method's labels, score)."""
        n_docs = len(w.first) - 1
        places: list[list[int]] = [[] for _ in range(n_docs)]
        base: list[set[str]] = [set() for _ in range(n_docs)]
        found: list[dict[str, float]] = [{} for _ in range(n_docs)]
        left = w.left()
        for label, phrase in self.base:
            at = _standing(w.hash, left, phrase)
            for i, d in zip(at.tolist(), (np.searchsorted(w.first, at, "right") - 1).tolist()):
                places[d].append(i - int(w.first[d]))
                base[d].add(label)
        at = np.minimum(np.searchsorted(self.indexed, w.hash), len(self.indexed) - 1)
        hit = np.flatnonzero(self.indexed[at] == w.hash)
        votes = Counter((number, i - place) for i, h in zip(hit.tolist(), w.hash[hit].tolist()) for number, place in self.postings[h])
        first = w.first
        for (number, start), n in votes.items():
            if n < self.needed[number]:
                continue
            label, words, keys = self.templates[number]
            # the text that the votes come from: the one that holds the template's middle
            middle = start + len(words) // 2
            if not 0 <= middle < len(w.hash):
                continue
            d = int(np.searchsorted(first, middle, "right")) - 1
            lo, hi = max(start, int(first[d])), min(start + len(words), int(first[d + 1]))
            share = float((w.hash[lo:hi] == words[lo - start:hi - start]).sum()) / len(words)
            if share >= self.coverage and all(len(_standing(w.hash[lo:hi], np.arange(hi - lo, 0, -1), k)) for k in keys):
                found[d][label] = max(share, found[d].get(label, 0.0))
        return places, base, found


def _standing(hashes: np.ndarray, left: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Where the phrase's words stand consecutively in one text."""
    at = np.flatnonzero((hashes == phrase[0]) & (left >= len(phrase)))
    for j in range(1, len(phrase)):
        at = at[hashes[at + j] == phrase[j]]
    return at


def scan_licences(docs: DataFrame, frequency: dict[str, int], n_docs: int, text: str = "text", rare: int = RARE, coverage: float = COVERAGE) -> DataFrame:
    """All rows of ``docs`` with the columns of ``RESULT``; labels are distinct,
    sorted and joined by commas; ``score`` is the best accepted coverage, 1 with a
    base phrase, 0 without any label."""
    ship_package(docs.sparkSession)
    docs = docs.drop(*(n for n, _ in RESULT))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = LicenceIndex(frequency, n_docs, rare, coverage)
        for batch in batches:
            for lo, n in slices(batch.column(text)):
                part = batch.slice(lo, n)
                w = split_words(part.column(text), lower=True, alnum=True)
                places, base, found = index.scan(w)
                columns = [
                    pa.array(np.diff(w.first), pa.int64()), pa.array([len(p) for p in places], pa.int64()),
                    pa.array([min(p, default=None) for p in places], pa.int64()), pa.array([max(p, default=None) for p in places], pa.int64()),
                    pa.array([",".join(sorted(b)) for b in base], pa.string()), pa.array([",".join(sorted(b | f.keys())) for b, f in zip(base, found)], pa.string()),
                    pa.array([1.0 if b else max(f.values(), default=0.0) for b, f in zip(base, found)], pa.float64())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), *columns], names=[*names, *(r for r, _ in RESULT)])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *(T.StructField(n, t) for n, t in RESULT)]))


def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    """Contract query: whole ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan_licences(docs, document_frequency(docs), docs.count()).select("doc_id", *(n for n, _ in RESULT))
