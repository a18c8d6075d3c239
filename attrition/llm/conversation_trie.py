"""Conversation prefix trie, rolled up by depth bands.

Every conversation is a path from a textless root; conversations that begin with
the same turns share their nodes.  A node is named by its depth and a 128-bit hash
of its prefix: the exclusive or of hashes of (depth, role, text), so a prefix's hash
is a running window over blocks of ``BLOCK`` turns, with the blocks before added.

Subtree totals are rolled up by bands of ``BAND`` depths:

* the nodes of a band send their values to their band's root (one combined sum);
* band roots form a contracted trie, which is rolled up in the same way, so a trie
  of depth D needs about log(D) rounds to the base ``BAND``, however deep it is;
* a band root's completed total goes to its parent, the last node of the band
  above, and every node then explodes to its ancestors inside its band, itself
  included: at most ``BAND`` rows a node.

Nothing is gathered by conversation or node: turns are placed by a range exchange
and counted by range, counts and sums are combined before they are shuffled, and a
node's list of conversations is hashed as a stream of pieces in numerical order.

Defined cases: rows without a conv_id belong to no conversation; null role or text
is empty; turns of one conversation and turn number follow role, then text;
repeated rows are repeated turns; an empty table gives no node; columns other than
conv_id, turn, role and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attrition.session import drop_table, ship_package, write_table

BAND = 8
BLOCK = 1024            # turns of one prefix window; a multiple of every band height used
KEY = ["depth", "x1", "x2"]
VALUES = ["n_leaves", "saved_tokens"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """Written table ``(conv_id, pid, place, t1, t2, n_chars)``: ``place`` follows the
    order of turns inside the range ``pid``.  A conversation may fill many ranges."""
    own = (conversations.where("conv_id is not null")
           .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
                   F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))
    turn = F.col("turn").asc_nulls_first()
    # beginnings of role and text suffice to split the rows of one turn number
    placed = (own.repartitionByRange("conv_id", turn, F.substring("role", 1, 64), F.substring("text", 1, 64))
              .sortWithinPartitions("conv_id", turn, "role", "text").withColumn("place", F.monotonically_increasing_id()))
    return write_table(placed.select("conv_id", F.shiftright("place", 33).alias("pid"), "place", F.xxhash64("role", "text").alias("t1"),
                                     F.xxhash64(F.lit(11), "text", "role").alias("t2"), F.length("text").cast("long").alias("n_chars")), "turns")


def conversation_pieces(turns: DataFrame) -> DataFrame:
    """``(conv_id, pid, first, before, length)``: the part of a conversation in a range,
    turns before it and in all.  A conversation has at most one row a range."""
    pieces = turns.groupBy("conv_id", "pid").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("conv_id")
    before = F.sum("n").over(whole.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1))
    return pieces.select("conv_id", "pid", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(whole).alias("length"))


def plain_paths(conversations: DataFrame) -> DataFrame:
    """Conversations as they are: ``(conv_id, depth, final, t1, t2, n_chars)``, the
    root's row (depth 0) included."""
    turns = ordered_turns(conversations)
    pieces = conversation_pieces(turns)
    own = turns.join(pieces, ["conv_id", "pid"]).select("conv_id", (F.col("place") - F.col("first") + F.col("before") + 1).alias("depth"),
                                                        F.col("length").alias("final"), "t1", "t2", "n_chars")
    return own.unionByName(_roots(pieces.select("conv_id", F.col("length").alias("final")).distinct()))


def _roots(convs: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return convs.select("conv_id", zero.alias("depth"), "final", zero.alias("t1"), zero.alias("t2"), zero.alias("n_chars"))


def rebuilt_paths(conversations: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """Conversations whose first h turns are those of their group's first conversation,
    ``conv_id - conv_id % group``; h = crc32(conv_id) % ``heads``.  As ``plain_paths``."""
    turns = ordered_turns(conversations)
    h = F.crc32(F.col("conv_id").cast("string")) % heads
    pieces = write_table(conversation_pieces(turns).withColumn("h", h).withColumn("leader", F.col("conv_id") - F.col("conv_id") % group), "pieces")
    lengths = pieces.where("conv_id = leader").groupBy("leader").agg(F.max("length").alias("lead"))
    convs = (pieces.groupBy("conv_id", "h", "leader").agg(F.max("length").alias("length")).join(lengths, "leader", "left")
             .withColumn("lead", F.least("h", F.coalesce("lead", F.lit(0))))
             .select("conv_id", "h", "leader", "lead", (F.col("lead") + F.greatest(F.col("length") - F.col("h"), F.lit(0))).alias("final")))
    convs = write_table(convs, "conversations")
    placed = (turns.join(pieces.select("conv_id", "pid", "first", "before").join(convs, "conv_id"), ["conv_id", "pid"])
              .withColumn("pos", F.col("place") - F.col("first") + F.col("before") + 1))
    own = placed.where("pos > h").select("conv_id", (F.col("lead") + F.col("pos") - F.col("h")).alias("depth"), "final", "t1", "t2", "n_chars")
    first = placed.where((F.col("conv_id") == F.col("leader")) & (F.col("pos") < heads)).select("leader", "pos", "t1", "t2", "n_chars")
    lent = (convs.select("conv_id", "leader", "h", "final").join(first, "leader").where("pos <= h")
            .select("conv_id", F.col("pos").alias("depth"), "final", "t1", "t2", "n_chars"))
    return own.unionByName(lent).unionByName(_roots(convs.select("conv_id", "final")))


def _prefixes(paths: DataFrame, band: int) -> DataFrame:
    """Written table of every path's nodes ``(conv_id, final, depth, x1, x2, p1, p2,
    n_chars, up)``: names of the node, its parent and, in ``up``, of the nodes from its
    band's root to itself."""
    e = write_table(paths.select("conv_id", "depth", "final", "n_chars", F.floor(F.col("depth") / BLOCK).alias("block"),
                                 *(F.when(F.col("depth") == 0, F.lit(0)).otherwise(h).cast("long").alias(n) for n, h in (
                                     ("e1", F.xxhash64("t1", "t2", "depth")), ("e2", F.xxhash64("depth", "t2", "t1"))))), "paths")
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (e.groupBy("conv_id", "block").agg(F.bit_xor("e1").alias("o1"), F.bit_xor("e2").alias("o2"))
              .select("conv_id", "block", F.bit_xor("o1").over(earlier).alias("o1"), F.bit_xor("o2").over(earlier).alias("o2")).where("block > 0"))
    in_block = Window.partitionBy("conv_id", "block").orderBy("depth")
    running = in_block.rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0).cast("long")
    named = e.join(blocks, ["conv_id", "block"], "left")
    for i in ("1", "2"):
        named = named.withColumn("x" + i, F.bit_xor("e" + i).over(running).bitwiseXOR(F.coalesce("o" + i, zero)))
    inside = (F.col("depth") % band + 1).cast("int")
    up = F.collect_list(F.struct("x1", "x2")).over(in_block.rowsBetween(1 - band, 0))
    out = named.withColumn("up", up).select(
        "conv_id", "final", *KEY, F.col("x1").bitwiseXOR(F.col("e1")).alias("p1"), F.col("x2").bitwiseXOR(F.col("e2")).alias("p2"),
        "n_chars", F.slice("up", -inside, inside).alias("up"))
    out = write_table(out, "prefixes")
    drop_table(e)
    return out


def _band_roots(prefixes: DataFrame, level: int, band: int) -> DataFrame:
    """Nodes at depths divisible by ``band ** level``, once each: ``up`` as in
    ``_prefixes`` within the contracted trie, ``q1, q2``: the last node before it of
    the level below."""
    step, below = band ** level, band ** (level - 1)
    rows = prefixes.where(F.col("depth") % step == 0)
    inside = Window.partitionBy("conv_id", F.floor(F.col("depth") / (step * band))).orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    nodes = (rows.withColumn("up", F.collect_list(F.struct("x1", "x2")).over(inside)).groupBy(*KEY)
             .agg(F.min(F.struct("conv_id", "up", "p1", "p2")).alias("first"))
             .select(*KEY, "first.conv_id", "first.up", F.col("first.p1").alias("q1"), F.col("first.p2").alias("q2")))
    if level > 1:
        before = prefixes.where(F.col("depth") % below == 0).select("conv_id", (F.col("depth") + below).alias("depth"),
                                                                   F.col("x1").alias("q1"), F.col("x2").alias("q2"))
        nodes = nodes.drop("q1", "q2").join(before, ["conv_id", "depth"], "left")
    return nodes.drop("conv_id")


def _sums(values: list[str]) -> list[Column]:
    return [F.sum(v).alias(v) for v in values]


def _rollup(nodes: DataFrame, prefixes: DataFrame, values: list[str], deepest: int, band: int, level: int = 0) -> DataFrame:
    """``KEY`` and every value's total over the subtree; ``nodes`` has ``KEY``, ``up``
    and a value of its own for each node of the level."""
    step = band ** level
    if deepest >= step * band:
        to_root = nodes.select((F.col("depth") - F.col("depth") % (step * band)).alias("depth"), F.col("up")[0]["x1"].alias("x1"),
                               F.col("up")[0]["x2"].alias("x2"), *values).groupBy(*KEY).agg(*_sums(values))
        roots = write_table(_band_roots(prefixes, level + 1, band).join(to_root, KEY), "band_roots")
        done = write_table(_rollup(roots, prefixes, values, deepest, band, level + 1), "completed")
        to_parent = (roots.where("depth > 0").select(*KEY, "q1", "q2").join(done, KEY)
                     .groupBy((F.col("depth") - step).alias("depth"), F.col("q1").alias("x1"), F.col("q2").alias("x2"))
                     .agg(*(F.sum(v).alias("below_" + v) for v in values)))
        nodes = (nodes.join(to_parent, KEY, "left")
                 .select(*KEY, "up", *((F.col(v) + F.coalesce("below_" + v, F.lit(0))).alias(v) for v in values)))
    root = F.col("depth") - F.col("depth") % (step * band)
    return (nodes.select(root.alias("root"), *values, F.posexplode("up").alias("i", "at"))
            .groupBy((F.col("root") + F.col("i") * step).alias("depth"), F.col("at.x1").alias("x1"), F.col("at.x2").alias("x2"))
            .agg(*_sums(values)))


def _digest_members(members: DataFrame) -> DataFrame:
    """``KEY`` and ``ends_sha256`` of the comma-joined ids of each node, ascending."""
    ship_package(members.sparkSession)

    def runs(batch: pa.RecordBatch) -> list[int]:
        cols = [batch.column(c).to_numpy() for c in KEY]
        change = np.zeros(batch.num_rows, bool)
        change[0] = True
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        return [*np.flatnonzero(change).tolist(), batch.num_rows]

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = runs(batch)
                ids = batch.column("conv_id").to_pylist()
                first = batch.take(pa.array(at[:-1]))
                yield pa.RecordBatch.from_arrays([*(first.column(c) for c in [*KEY, "conv_id"]),
                                                  pa.array([",".join(map(str, ids[a:b])) for a, b in zip(at, at[1:])])], names=[*KEY, "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for *this, ids in zip(*(batch.column(c).to_pylist() for c in [*KEY, "ids"])):
                if this != key:
                    if key:
                        done.append((*key, state.hexdigest()))
                    key, state = this, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield _digests(done)
        if key:
            yield _digests([(*key, state.hexdigest())])

    def _digests(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in list(zip(*rows))[:3]), pa.array([r[3] for r in rows])],
                                          names=[*KEY, "ends_sha256"])

    schema = "depth long, x1 long, x2 long, "
    pieces = (members.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
              .mapInArrow(join_ids, schema + "first long, ids string"))
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digest, schema + "ends_sha256 string")


def prefix_trie(paths: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node of the trie over ``paths`` (see ``plain_paths``): ``conv_id``
    (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    if band < 2 or BLOCK % band:
        raise ValueError(f"the band height must be 2 or more and divide {BLOCK}")
    prefixes = _prefixes(paths, band)
    nodes = write_table(prefixes.groupBy(*KEY).agg(F.min(F.struct("conv_id", "up")).alias("first"), F.count(F.lit(1)).alias("n_convs"),
                                                   F.min("n_chars").alias("n_chars"), F.min("p1").alias("p1"), F.min("p2").alias("p2"))
                        .select(*KEY, "first.conv_id", "first.up", "n_convs", "n_chars", "p1", "p2"), "nodes")
    children = (nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2"))
                .agg(F.count(F.lit(1)).alias("n_children")))
    nodes = write_table(nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
                        .withColumn("n_leaves", (F.col("n_children") == 0).cast("long"))
                        .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("n_chars")), "nodes")
    deepest = nodes.agg(F.max("depth")).first()[0]
    totals = _rollup(nodes.select(*KEY, "up", *VALUES), prefixes, VALUES, -1 if deepest is None else deepest, band)
    ends = _digest_members(prefixes.where("depth = final").select(*KEY, "conv_id"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.drop("up", "n_chars", *VALUES).join(totals, KEY).join(ends, KEY, "left").join(parents, ["depth", "p1", "p2"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *VALUES,
                    F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))


def op11_conversation_trie(spark, sf_dir: str) -> DataFrame:
    """Contract query: whole ``conversations``, rebuilt."""
    return prefix_trie(rebuilt_paths(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text in DuckDB, half a byte at a time."""
    table = []
    for c in range(16):
        for _ in range(4):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    halves = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c) & 15, ascii(c) >> 4]))"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295, list_transform({halves}, lambda n: n::BIGINT)), "
            f"lambda a, n: xor(a >> 4, ({table}::BIGINT[])[(xor(a, n) & 15) + 1])))")


OP11_SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS leader, {_crc32_sql("CAST(conv_id AS VARCHAR)")} % 6 AS h
      FROM (SELECT DISTINCT conv_id FROM t)),
m AS (
  SELECT c.conv_id, t.pos AS o, r, x FROM c JOIN t ON t.conv_id = c.leader AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, t.pos + 10, r, x FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
p AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY o) AS d, md5(md5(r) || md5(x)) AS h, x FROM m),
k AS (
  SELECT conv_id, d, md5(string_agg(h, '') OVER (PARTITION BY conv_id ORDER BY d)) AS key, x FROM p
  UNION ALL SELECT conv_id, 0, 'root', '' FROM c),
f AS (SELECT conv_id, max(d) AS last FROM k GROUP BY conv_id),
n AS (
  SELECT d, key, min(conv_id) AS conv_id, count(*) AS n_convs, max(length(x)) AS len,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = last) AS ends
  FROM k JOIN f USING (conv_id) GROUP BY d, key),
q AS (SELECT n.*, b.key AS parent FROM n LEFT JOIN k b ON b.conv_id = n.conv_id AND b.d = n.d - 1),
kids AS (SELECT d - 1 AS d, parent AS key, count(*) AS n FROM q WHERE d > 0 GROUP BY 1, 2),
v AS (SELECT q.*, coalesce(kids.n, 0) AS n_children FROM q LEFT JOIN kids ON kids.d = q.d AND kids.key = q.key),
s AS (
  SELECT a.d, a.key, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((v.n_convs - 1) * v.len) AS saved
  FROM v JOIN k a ON a.conv_id = v.conv_id AND a.d <= v.d GROUP BY a.d, a.key)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, v.n_convs, CAST(v.n_children AS BIGINT) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM v JOIN s ON s.d = v.d AND s.key = v.key LEFT JOIN n up ON up.d = v.d - 1 AND up.key = v.parent
"""
