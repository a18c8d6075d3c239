"""Document fingerprints by SpotSigs.

A spot signature is a common word (an anchor) together with the next ``CHAIN`` content
words after it; words that are no anchors are content words.  Layout, headlines and
lists have few anchors, so signatures come from running prose.  A document's
fingerprint is its set of signatures, written as their sorted 32-bit hashes, eight
hex digits each; likeness is the Jaccard similarity of two such sets.

Comparing a table (``near_copies``) follows the published scheme: documents are
partitioned by the size of their sets, so that one can only be similar to documents
of its own and the next partition; inside, an index holds of each set its rarest
signatures, as many as two similar sets cannot both avoid; what meets there is
compared by a Jaccard that stops as soon as the sizes exclude it.

Fingerprints of a text and its edited text (``edited_fingerprints``): documents are
dealt to ranges of descending ids, whose bounds come from the ids alone; the first
document of a range is found on narrow columns and sent to the range before as well.
So texts are exchanged once, and a task sees each document beside the next one.

Defined cases: a text without signatures is one signature, of its words or, without
words, of its bytes; null is an empty text, whose fingerprint is empty; two empty
fingerprints are alike (1), an empty and another one are not (0); documents of one id
follow the hash of their text, those without an id come last; of rows that repeat an
id and text any order is the same; an empty table gives an empty result; columns other
than id and text are ignored.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm.bpe import merged
from attrition.llm.components import connected_components
from attrition.llm.minhash_dedup import verified_links
from attrition.llm.words import give_back, mix64, split_words
from attrition.session import ship_package, write_table

#: Frequent function words of English, German, French and Spanish.
ANCHORS = ("the of and to a in is that it for was on with be as by this are at from "
           "der die das und den von zu mit sich auf für ist im nicht ein eine dem des "
           "le la les de et en un une du que qui dans est pour pas sur au par ne "
           "el los las y del se por con para su al lo como no es").split()
CHAIN = 2
PERCENT = 75
SLICE_BYTES = 4 << 20


def anchor_hashes(anchors=ANCHORS) -> np.ndarray:
    return np.unique(split_words(pa.array([" ".join(anchors)]), lower=True, alnum=True).hash)


def signature_sets(column: pa.Array, anchors: np.ndarray, chain: int = CHAIN) -> list[np.ndarray]:
    """Sorted distinct 32-bit signatures of each text."""
    w = split_words(column, lower=True, alnum=True)
    anchor = np.isin(w.hash, anchors)
    content, spot = np.flatnonzero(~anchor), np.flatnonzero(anchor)
    doc = w.doc()
    at = np.searchsorted(content, spot)
    whole = at + chain <= len(content)
    spot, at = spot[whole], at[whole]
    whole = doc[content[at + chain - 1]] == doc[spot] if len(at) else np.zeros(0, bool)
    spot, at = spot[whole], at[whole]
    h = mix64(w.hash[spot] + np.uint64(chain))
    for i in range(chain):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + w.hash[content[at + i]])
    h = (h >> np.uint64(32)).astype(np.uint32)
    first = np.searchsorted(spot, w.first)
    out = []
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if b > a:
            out.append(np.unique(h[a:b]))
            continue
        words = w.hash[w.first[i]:w.first[i + 1]]
        raw = words.tobytes() if len(words) else (column[i].as_py() or "").encode()
        out.append(np.frombuffer(hashlib.sha256(raw).digest(), np.uint32, 1) if raw else np.zeros(0, np.uint32))
    return out


def likeness(a: np.ndarray, b: np.ndarray, at_least: float = 0.0) -> float:
    """Jaccard similarity of two sorted distinct arrays; 0 where their sizes exclude
    ``at_least``, without a look at them."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < at_least * large:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (small + large - both)


def show(s: np.ndarray) -> str:
    return s.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, text: str = "text", id_col: str = "doc_id", anchors=ANCHORS, chain: int = CHAIN) -> DataFrame:
    """``(id, fingerprint)`` of every document."""
    ship_package(docs.sparkSession)
    known = anchor_hashes(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([show(s) for s in signature_sets(batch.column(1), known, chain)])],
                                                 names=[id_col, "fingerprint"])

    return (docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text).alias("text"))
            .mapInArrow(run, f"`{id_col}` long, fingerprint string"))


def near_copies(docs: DataFrame, text: str = "text", id_col: str = "doc_id", percent: int = PERCENT, anchors=ANCHORS, chain: int = CHAIN) -> DataFrame:
    """One row per document: id, ``n_signatures``, ``component_id``: the smallest id
    reachable by links of likeness ``percent`` or more, itself included (null for a null
    id).  Documents with an empty fingerprint are linked with nothing."""
    found = write_table(fingerprints(docs, text, id_col, anchors, chain).withColumnRenamed(id_col, "id"), "fingerprints")
    size = (F.length("fingerprint") / 8).cast("long")
    usable = found.where("id is not null and fingerprint <> ''")
    print_key = F.sha2("fingerprint", 256)
    classes = write_table(usable.groupBy(print_key.alias("print")).agg(F.min("id").alias("rep"), F.first("fingerprint").alias("fingerprint")), "classes")
    copies = (usable.select("id", print_key.alias("print")).join(classes.select("print", "rep"), "print").where("id <> rep")
              .select(F.col("rep").alias("a"), F.col("id").alias("b")))
    # the partition of a size: sizes of one partition differ by less than the threshold allows, so similar
    # sets lie in the same one or in the next
    step = float(np.log(100 / percent)) if percent < 100 else 1.0
    sized = classes.select("rep", "fingerprint", size.alias("n"), F.floor(F.log(size.cast("double")) / step).cast("int").alias("part"))
    spot = F.explode(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.substr("fingerprint", (i * 8 + 1).cast("int"), F.lit(8)))).alias("spot")
    spots = write_table(sized.select("rep", "n", "part", spot), "spots")
    rarity = spots.groupBy("spot").agg(F.count(F.lit(1)).alias("df"))
    # similar sets share a signature among the n - ceil(percent * n / 100) + 1 rarest of each
    needed = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")
    ranked = (spots.join(rarity, "spot").groupBy("rep", "n", "part").agg(F.sort_array(F.collect_list(F.struct("df", "spot"))).alias("order"))
              .select("rep", "part", F.explode(F.slice("order", F.lit(1), needed)).alias("s")))
    buckets = write_table(ranked.select("rep", F.explode(F.array("part", F.col("part") + 1)).alias("side"), F.col("s.spot").alias("spot"))
                          .select("rep", F.xxhash64("side", "spot").alias("key")), "buckets")

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([np.frombuffer(bytes.fromhex(x), ">u4").astype(np.uint64).tobytes() for x in batch.column("fingerprint").to_pylist()],
                                              pa.binary())], names=["id", "members"])

    links = verified_links(buckets, lambda wanted: classes.select(F.col("rep").alias("id"), "fingerprint").join(wanted, "id", "left_semi")
                           .mapInArrow(members, "id long, members binary"), percent)
    final = connected_components(links.unionByName(copies))
    return (found.select("id", size.alias("n_signatures")).join(final, "id", "left")
            .select(F.col("id").alias(id_col), "n_signatures", F.coalesce("component", "id").alias("component_id")))


RESULT = [("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
          ("near_edited", pa.float64()), ("near_next", pa.float64())]
RESULT_DDL = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edit(text: str, following: str) -> str:
    """The last third of ``text`` replaced by the beginning of ``following``."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def _compare(ids: pa.Array, texts: list[str], following: list[str], anchors: np.ndarray, chain: int, id_col: str) -> pa.RecordBatch:
    edited = [edit(a, b) for a, b in zip(texts, following)]
    own, other, next_own = (signature_sets(pa.array(t, pa.large_string()), anchors, chain) for t in (texts, edited, following))
    columns = [[len(t) for t in texts], [hashlib.sha256(t.encode()).hexdigest() for t in edited], list(map(show, own)), list(map(show, other)),
               list(map(likeness, own, other)), list(map(likeness, own, next_own))]
    return pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, (_, t) in zip(columns, RESULT))], names=[id_col, *(n for n, _ in RESULT)])


def edited_fingerprints(docs: DataFrame, text: str = "text", id_col: str = "doc_id", anchors=ANCHORS, chain: int = CHAIN) -> DataFrame:
    """One row per document: id, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``.  The document after the last
    one is the first; a single document is followed by itself."""
    spark = docs.sparkSession
    ship_package(spark)
    known = anchor_hashes(anchors)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = source.withColumn("tie", F.xxhash64("text")).withColumn("range", _ranges(source.select("id"), tasks))
    # the first document of each range (a row per range), which also follows the last one of the range before
    firsts = write_table(placed.groupBy("range").agg(F.min(F.struct(F.col("id").isNull().alias("none"), F.bitwise_not("id").alias("back"), "tie")).alias("f"))
                         .select("range", F.bitwise_not("f.back").alias("id"), F.col("f.tie").alias("tie")), "firsts")
    used = sorted(r["range"] for r in firsts.select("range").collect())
    place = {r: i for i, r in enumerate(used)}
    before = spark.createDataFrame([(r, place[r], (place[r] - 1) % len(used)) for r in used], "range int, place int, before int")
    guests = F.broadcast(firsts.join(before, "range").select(F.col("id").alias("f_id"), F.col("tie").alias("f_tie"), "before"))    # at most `tasks` rows
    guest = (placed.join(guests, F.col("id").eqNullSafe(F.col("f_id")) & (F.col("tie") == F.col("f_tie")))
             .groupBy("before").agg(F.first("id").alias("id"), F.first("tie").alias("tie"), F.first("text").alias("text"))
             .select("id", "text", "tie", F.col("before").alias("place"), F.lit(True).alias("guest")))
    own = placed.join(F.broadcast(before.select("range", "place")), "range").select("id", "text", "tie", "place", F.lit(False).alias("guest"))
    ordered = (own.unionByName(guest).repartitionById(max(1, len(used)), F.col("place").cast("int"))
               .sortWithinPartitions("guest", F.col("id").desc_nulls_last(), "tie"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_id, held = None, None
        for batch in merged(batches, "text", SLICE_BYTES):
            ids, texts = batch.column("id"), batch.column("text").to_pylist()
            if held is not None:
                ids, texts = pa.concat_arrays([held_id, ids]), [held, *texts]
            if len(texts) > 1:
                yield _compare(ids.slice(0, len(texts) - 1), texts[:-1], texts[1:], known, chain, id_col)
            held_id, held = ids.slice(len(texts) - 1, 1), texts[-1]         # in the end: the guest
        gc.collect()
        give_back()

    return ordered.select("id", "text").mapInArrow(run, f"`{id_col}` long, {RESULT_DDL}")


def _ranges(ids: DataFrame, n: int) -> Column:
    """The range (from 0, descending by id, ties by hash of the text) of columns ``id``
    and ``tie``: about equal numbers of rows; an id, or the missing one, that fills
    several ranges is cut by the hash."""
    row = ids.agg(F.percentile_approx("id", [(i + 1) / n for i in range(n)], 10_000).alias("q"), F.count(F.lit(1)).alias("n"),
                  F.count("id").alias("known")).first()
    cuts = sorted(row["q"] or [], reverse=True)
    none = max(1, round(n * (row["n"] - row["known"]) / max(1, row["n"])))
    # bounds: an id that is cut k times has k ranges of its own
    bounds = [(c, cuts.count(c)) for c in dict.fromkeys(cuts)]
    share = F.least(F.col("tie") / F.lit(2.0 ** 64) + 0.5, F.lit(1 - 2.0 ** -53))
    ids_, first, width, at = [], [], [], 0
    for c, k in bounds:
        # rows above this bound and below the one before, then the bound itself
        ids_.append(c)
        first.append(at)
        width.append(k)
        at += 1 + k
    if not ids_:
        return F.floor(share * none).cast("int")
    # bounds above the id, by halving
    steps = [1 << j for j in reversed(range(len(ids_).bit_length()))]
    listed = F.array(*map(F.lit, ids_))
    above = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda n, s: F.when(
        (n + s <= len(ids_)) & (F.element_at(listed, F.least(n + s, F.lit(len(ids_)))) > F.col("id")), n + s).otherwise(n))
    i = F.least(above, F.lit(len(ids_) - 1))
    get = lambda xs: F.element_at(F.array(*map(F.lit, xs)), i + 1)
    on_bound = get(ids_) == F.col("id")
    inside = F.when(above >= len(ids_), F.lit(at)).when(on_bound, get(first) + 1 + F.floor(share * get(width))).otherwise(get(first))
    return F.when(F.col("id").isNull(), at + 1 + F.floor(share * none)).otherwise(inside).cast("int")


def op12_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Contract query: whole ``documents``."""
    return edited_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
