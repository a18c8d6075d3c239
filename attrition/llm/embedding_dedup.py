"""Near-duplicate vectors by random-hyperplane sign hashing.

Only vectors of equal, non-null labels are compared.  Equal vectors of a label
collapse to one class with a multiplicity.  Every class gets one key per table:
the signs of its products with ``bits`` random hyperplanes.  Classes that share a
label, table and key are compared in double precision.  The number of bits
follows the largest label's size (buckets of about ``BUCKET`` classes), the number
of tables keeps the chance of missing a pair at the threshold below ``MISS``.

A pair is counted in the first table whose keys agree and nowhere else, so exact
link counts are sums and no pair list is made.  Buckets are cut into blocks; a
pair of blocks is one bounded task that emits one count and at most one link a
class.  Components are distributed (``components.py``).

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components, and vectors without a label, link with nothing; vectors of different
length never link; rows that repeat a vec_id are vectors of their own that share
an id; rows with a null id count as links of others, have component null and are
kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.components import connected_components
from attrition.session import drop_table, ship_package, write_table

BUCKET = 128
BLOCK = 512
MISS = 1e-6


def plan(largest: int, cosine: float, bucket: int = BUCKET, miss: float = MISS) -> tuple[int, int]:
    """(bits, tables) for a label of ``largest`` classes."""
    bits = max(2, math.ceil(math.log2(max(largest, 1) / bucket)))
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-agree))


def _doubles(column: pa.Array) -> list[np.ndarray | None]:
    """Usable vectors as doubles, None for the others."""
    out = []
    for v in column:
        values = v.values if v.is_valid else None
        if values is None or not len(values) or values.null_count:
            out.append(None)
            continue
        x = values.to_numpy(zero_copy_only=False).astype(np.float64)
        norm = np.abs(x).max() if np.isfinite(x).all() else 0.0
        out.append(x if norm > 0 else None)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max()
    return x / np.sqrt((x * x).sum())


def _planes(size: int, count: int) -> np.ndarray:
    return np.random.default_rng([911, size]).standard_normal((count, size))


def _merge(linked: np.ndarray) -> np.ndarray:
    """Smallest index reachable in a symmetric boolean matrix."""
    n = len(linked)
    label = np.arange(n)
    while True:
        near = np.minimum(label, np.where(linked, label[None, :], n).min(axis=1, initial=n))
        near = near[near]
        if (near == label).all():
            return label
        label = near


def near_vectors(vectors: DataFrame, cosine: float = 0.98, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
                 bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``."""
    spark = vectors.sparkSession
    ship_package(spark)
    source = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("v"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs = _doubles(batch.column("v"))
            body = [None if x is None else x.astype("<f8").tobytes() for x in xs]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array([None if b is None else hashlib.md5(b).digest() for b in body], pa.binary()),
                 pa.array(body, pa.binary())], names=["id", "label", "same", "v"])

    marked = write_table(source.mapInArrow(digest, "id long, label string, same binary, v binary"), "vectors")
    usable = marked.where("label is not null and same is not null")
    classes = write_table(usable.groupBy("label", "same").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v")), "classes")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    bits, tables = plan(largest, cosine, bucket)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            rows = []
            for v in batch.column("v"):
                x = _unit(np.frombuffer(v.as_buffer(), "<f8"))
                signs = (_planes_of(len(x), bits * tables) @ x >= 0).reshape(tables, bits)
                rows.append(signs @ weights)
            keys = np.array(rows, "<i8").reshape(batch.num_rows, tables)
            for t in range(tables):
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("label", "same", "rep", "n", "v")), pa.array(np.full(batch.num_rows, t), pa.int32()),
                     pa.array(keys[:, t], pa.int64()), pa.array([k.tobytes() for k in keys], pa.binary())],
                    names=["label", "same", "rep", "n", "v", "t", "key", "keys"])

    rows = classes.mapInArrow(hashed, "label string, same binary, rep long, n long, v binary, t int, key long, keys binary")
    rows = write_table(rows, "buckets")
    sizes = rows.groupBy("label", "t", "key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    members = (rows.join(sizes, ["label", "t", "key"])
               .withColumn("blocks", F.ceil(F.col("m") / block).cast("int"))
               .withColumn("mine", F.pmod(F.xxhash64("same"), F.col("blocks")).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
               .select("label", "t", "key", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"),
                       "mine", "same", "rep", "n", "v", "keys"))

    def compare(table: pa.Table) -> pa.Table:
        t, p, q = (table.column(c)[0].as_py() for c in ("t", "p", "q"))
        side, n, rep = (table.column(c).to_numpy() for c in ("mine", "n", "rep"))
        vectors = [np.frombuffer(v, "<f8") for v in table.column("v").to_pylist()]
        keys = np.stack([np.frombuffer(k, "<i8") for k in table.column("keys").to_pylist()])
        sizes = np.array([len(v) for v in vectors])
        rows, links, to = [], [], []
        for size in np.unique(sizes):
            own = np.flatnonzero(sizes == size)
            x = np.stack([_unit(vectors[i]) for i in own])
            linked = x @ x.T >= cosine
            linked &= (side[own][:, None] == p) & (side[own][None, :] == q) | (side[own][:, None] == q) & (side[own][None, :] == p)
            np.fill_diagonal(linked, False)
            for earlier in range(t):
                linked &= keys[own, earlier][:, None] != keys[own, earlier][None, :]
            some = linked.any(axis=1)
            own, linked = own[some], linked[some][:, some]
            rows += own.tolist()
            links += (linked @ n[own]).tolist()
            to += rep[own[_merge(linked)]].tolist()
        kept = table.select(["label", "same", "rep"]).take(pa.array(rows, pa.int64()))
        return kept.add_column(2, "links", pa.array(links, pa.int64())).append_column("to", pa.array(to, pa.int64()))

    found = write_table(members.groupBy("label", "t", "key", "p", "q").applyInArrow(compare, "label string, same binary, links long, rep long, to long"), "found")
    drop_table(rows)
    others = found.groupBy("label", "same").agg(F.sum("links").alias("links"))
    counts = classes.select("label", "same", "rep", "n").join(others, ["label", "same"], "left")
    ids = marked.select("id", "label", "same").join(counts, ["label", "same"], "left")
    copies = usable.select("id", "label", "same").join(classes.select("label", "same", "rep"), ["label", "same"]).where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    component = connected_components(found.select(F.col("rep").alias("a"), F.col("to").alias("b")).unionByName(copies))
    return (ids.join(component, "id", "left")
            .select(F.col("id").alias(id_col), (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("n") - 1, F.lit(0))).cast("long").alias("n_links"),
                    F.coalesce("component", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))


_kept_planes: dict[tuple[int, int], np.ndarray] = {}


def _planes_of(size: int, count: int) -> np.ndarray:
    if (size, count) not in _kept_planes:
        _kept_planes[size, count] = _planes(size, count)
    return _kept_planes[size, count]


def op6_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: all ``embeddings``, cosine 0.98."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP6_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(c.c, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(c.c, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN comp c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""
