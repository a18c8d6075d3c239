"""Near-duplicate documents by circulant MinHash.

A document's set holds its distinct 5-word shingles.  Shingles are folded onto
``UNIVERSE`` places and put through a first permutation; every signature
coordinate k uses the one second permutation, circularly shifted by k.  All
coordinates of a shingle are therefore one contiguous slice of that permutation,
and a signature is the minimum over slices.  The coordinates are banded; two
documents that agree on a band are candidates.  At a Jaccard similarity of 0.75
the defaults (32 bands of 4) miss a pair with probability 5e-6.

Candidates are verified on full sets of 64-bit shingle hashes:

* documents with equal sets collapse to one class first (128-bit set hash), so a
  group of exact copies costs one representative;
* star round: in each band bucket every member is paired with the bucket's
  smallest id, pairs are verified and components formed;
* the rest, exactly: buckets that still hold two components or more are cut into
  blocks, those of its largest component apart from the others; each pair of blocks,
  but for two of that component, tests its members of different components on full
  sets, skips pairs that its own links already connect, and emits at most one
  link a member.  No pair list of a group is ever made and nothing is capped.

Before sets are made or sent, the sizes of a pair's sets must allow the similarity and
it must agree on ``AGREE`` of its signature coordinates, of which one byte each is
kept: at 0.75 a pair has 96 of 128 on the average and fewer than 70 with a probability
below 1e-6.  So texts are read again, and sets sent, only for pairs, and members of
blocks, that are similar by all their coordinates.

Links' connected components are distributed (``components.py``).

Defined cases: null or wordless text has an empty set and is linked with nothing;
a text of fewer words than a shingle is one shingle; rows that repeat a doc_id
are one node; rows with a null id are linked with nothing, have component null
and are kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.components import connected_components
from attrition.llm.words import Words, mix64, returning, sequence_hash, split_words, whole_hash
from attrition.session import drop_table, ship_package, write_table

SHINGLE = 5
BANDS, ROWS = 32, 4
UNIVERSE_BITS = 20
BLOCK = 256
AGREE = 0.55            # share of a signature's coordinates
_tables: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def _permutations(coordinates: int, bits: int = UNIVERSE_BITS) -> tuple[np.ndarray, np.ndarray]:
    """First permutation, and the second one laid out so that row i of its sliding
    view holds its values at i, i - 1, ... (all shifts of place i)."""
    key = (coordinates, bits)
    if key not in _tables:
        rng = np.random.default_rng(20240607)
        first = rng.permutation(1 << bits).astype(np.uint32)
        second = rng.permutation(1 << bits).astype(np.uint32)
        around = np.concatenate([second, second[:coordinates - 1]])
        _tables[key] = first, np.lib.stride_tricks.sliding_window_view(around, coordinates)
    return _tables[key]


def signature(shingles: np.ndarray, coordinates: int = BANDS * ROWS) -> np.ndarray:
    """Circulant MinHash signature of a non-empty set of 64-bit hashes."""
    first, shifted = _permutations(coordinates)
    place = first[(shingles >> np.uint64(64 - UNIVERSE_BITS)).astype(np.int64)]
    best = None
    for i in range(0, len(place), 4096):
        low = shifted[place[i:i + 4096]].min(axis=0)
        best = low if best is None else np.minimum(best, low)
    return best


def shingle_sets(w: Words, width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    every = sequence_hash(w.hash, width)
    out = []
    for a, b in zip(w.first[:-1], w.first[1:]):
        if b - a >= width:
            out.append(np.unique(every[a:b - width + 1]))
        else:
            out.append(whole_hash(w.hash[a:b]) if b > a else np.zeros(0, np.uint64))
    return out


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted distinct arrays."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id", width: int = SHINGLE, percent: int = 75,
                    bands: int = BANDS, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``, ``kept``."""
    spark = docs.sparkSession
    ship_package(spark)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))

    @returning
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                sets = shingle_sets(split_words(part.column("text"), lower=True), width)
                high, low, keys, sketch = [], [], [], []
                for s in sets:
                    if not len(s):
                        high.append(None), low.append(None), keys.append(None), sketch.append(None)
                        continue
                    high.append(int(mix64(s).sum(dtype=np.uint64).view(np.int64)))
                    low.append(int(mix64(s ^ np.uint64(0x5BF0A8B1457695F5)).sum(dtype=np.uint64).view(np.int64)))
                    sig = signature(s, bands * rows)
                    sketch.append(sig.astype(np.uint8).tobytes())
                    sig = sig.reshape(bands, rows).astype(np.uint64)
                    key = mix64(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                    for j in range(rows):
                        key = mix64(key + sig[:, j])
                    keys.append(key.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(high, pa.int64()),
                     pa.array(low, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                    names=["id", "n_shingles", "high", "low", "keys", "sketch"])

    signed = write_table(source.mapInArrow(sign, "id long, n_shingles long, high long, low long, keys array<long>, sketch binary"), "signatures")

    @returning
    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                sets = shingle_sets(split_words(part.column("text"), lower=True), width)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "members"])

    # classes of equal sets; every member links to the smallest id of its class
    usable = signed.where("id is not null and n_shingles > 0")
    classes = write_table(usable.groupBy("high", "low").agg(F.min("id").alias("rep"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"),
                                                            F.first("sketch").alias("sketch")), "classes")
    copies = usable.join(classes.select("high", "low", "rep"), ["high", "low"]).where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    links = verified_links(classes.select("rep", F.explode("keys").alias("key")),
                           lambda wanted: source.join(wanted, "id", "left_semi").mapInArrow(sets_of, "id long, members binary"),
                           percent, block, classes.select("rep", "n", "sketch"))
    final = connected_components(links.unionByName(copies))
    drop_table(links)
    return (signed.select("id", "n_shingles").join(final, "id", "left")
            .select(F.col("id").alias(id_col), "n_shingles",
                    F.coalesce("component", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))


def verified_links(buckets: DataFrame, sets_of, percent: int, block: int = BLOCK, sketches: DataFrame | None = None) -> DataFrame:
    """Written table of links ``(a, b)`` that connect all sets similar to ``percent``
    which share a bucket: a star round, then blocks (see above).

    ``buckets(rep long, key long)``; ``sets_of(wanted)`` gives ``(id, members)``, the
    sorted distinct 64-bit members of every wanted id; ``sketches(rep, n, sketch)``, if
    given, holds set sizes and equally long byte strings of which similar sets share
    ``AGREE``.
    """
    def near(n_a, n_b, x, y):
        """Whether sizes and sketches allow the similarity."""
        return (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)) & ((x == y).mean(axis=1) >= AGREE)

    @returning
    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sketch_a", "sketch_b"))
                yield batch.select(["a", "b"]).filter(pa.array(near(batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), x, y)))

    @returning
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("set_a"), batch.column("set_b")
            ok = [similar(np.frombuffer(x[i].as_buffer(), np.uint64), np.frombuffer(y[i].as_buffer(), np.uint64), percent)
                  for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    heads = buckets.groupBy("key").agg(F.min("rep").alias("head"), F.max("rep").alias("last")).where("head < last")
    pairs = write_table(buckets.join(heads, "key").where("rep <> head").select(F.col("head").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    made, likely = [pairs], pairs
    if sketches is not None:
        side = lambda s: sketches.select(F.col("rep").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
        likely = write_table(pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(agree, "a long, b long"), "likely")
        made.append(likely)
    # the ids are a table of their own, so that Spark knows their bytes before it plans the join with the texts
    wanted = write_table(likely.select(F.col("a").alias("id")).unionByName(likely.select(F.col("b").alias("id"))).distinct(), "wanted")
    sets = write_table(sets_of(wanted), "sets")
    both = (likely.select("a", "b").join(sets.select(F.col("id").alias("b"), F.col("members").alias("set_b")), "b")
            .join(sets.select(F.col("id").alias("a"), F.col("members").alias("set_a")), "a"))
    links = write_table(both.select("a", "b", "set_a", "set_b").mapInArrow(verify, "a long, b long"), "star")
    star = connected_components(links)

    # buckets that the star round left with several components, in blocks
    label = star.withColumnRenamed("id", "rep")
    placed = write_table(buckets.join(heads.select("key"), "key", "left_semi").join(label, "rep", "left")
                         .select("key", "rep", F.coalesce("component", "rep").alias("component")), "placed")
    by_component = (placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("who")))
    open_keys = (by_component.groupBy("key").agg(F.max(F.struct("n", "component")).alias("most"), F.sum("n").alias("n"), F.sum("who").alias("who"),
                                                 F.count(F.lit(1)).alias("components")).where("components > 1"))
    # buckets with the same members are one bucket; members of its largest component ("major") need no test with each other
    open_keys = (open_keys.groupBy("who", "n", "components").agg(F.min(F.struct("key", "most")).alias("first"))
                 .select("first.key", F.col("first.most.component").alias("major"),
                         F.ceil(F.col("first.most.n") / block).cast("int").alias("majors"),
                         F.ceil((F.col("n") - F.col("first.most.n")) / block).cast("int").alias("minors")))
    members = placed.join(open_keys, "key")
    if sketches is not None:
        members = members.join(sketches, "rep")
    is_major = F.col("component") == F.col("major")
    mine = F.when(is_major, F.pmod(F.xxhash64("rep", F.lit(7)), F.col("majors"))).otherwise(F.col("majors") + F.pmod(F.xxhash64("rep", F.lit(7)), F.col("minors")))
    last = F.col("majors") + F.col("minors") - 1
    members = (members.withColumn("mine", mine.cast("int"))
               .withColumn("other", F.explode(F.sequence(F.when(is_major, F.col("majors")).otherwise(F.lit(0)), last)))
               .withColumn("p", F.least("mine", "other")).withColumn("q", F.greatest("mine", "other")))
    columns = ["key", "p", "q", "mine", "rep", "component"]

    def test_sketches(pdf: pd.DataFrame) -> pd.DataFrame:
        p, q = pdf["p"].iloc[0], pdf["q"].iloc[0]
        side, component, n = (pdf[c].to_numpy() for c in ("mine", "component", "n"))
        marks = np.frombuffer(b"".join(pdf["sketch"]), np.uint8).reshape(len(pdf), -1)
        right = np.flatnonzero(side == q)
        active = np.zeros(len(pdf), bool)
        for i in np.flatnonzero(side == p):
            found = right[(component[right] != component[i]) & near(n[right], n[i], marks[right], marks[i])]
            active[found] = True
            active[i] |= len(found) > 0
        return pdf.loc[active, columns]

    if sketches is None:
        members = members.select(*columns)
    else:
        members = write_table(members.select(*columns, "n", "sketch").groupBy("key", "p", "q")
                              .applyInPandas(test_sketches, "key long, p int, q int, mine int, rep long, component long"), "active")
        made.append(members)
    more = write_table(members.select(F.col("rep").alias("id")).distinct().join(wanted, "id", "left_anti"), "wanted")
    others = write_table(sets_of(more), "sets")

    def test_block(pdf: pd.DataFrame) -> pd.DataFrame:
        p, q = pdf["p"].iloc[0], pdf["q"].iloc[0]
        ids, side = pdf["rep"].to_numpy(), pdf["mine"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in pdf["members"]]
        component, index = np.unique(pdf["component"].to_numpy(), return_inverse=True)
        union, found = _Union(len(component)), []
        left, right = np.flatnonzero(side == p), np.flatnonzero(side == q)
        for i in left:
            for j in right:
                if (p == q and j <= i) or union.find(index[i]) == union.find(index[j]):
                    continue
                if similar(sets[i], sets[j], percent):
                    union.join(index[i], index[j])
                    found.append((ids[i], ids[j]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    rest = (members.join(sets.unionByName(others).withColumnRenamed("id", "rep"), "rep")
            .groupBy("key", "p", "q").applyInPandas(test_block, "a long, b long"))
    all_links = write_table(links.unionByName(rest), "links")
    for done in (*made, wanted, more, sets, others, placed, links):
        drop_table(done)
    return all_links


def op3_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: whole ``documents``, five words, 0.75."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


OP3_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(list_slice(w, i, i + 4), ' ')) AS h
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 75 * (x.n + y.n - m)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(comp.c, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(comp.c, d.doc_id)) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN comp ON comp.a = d.doc_id
"""
