"""Benchmark decontamination: prefix-filtered set join, DataFrame functions only.

A benchmark item's windows are every ``window`` consecutive words (an item of
fewer words is one window).  A window is contained in a document where its words
stand consecutively, so all of its tokens are necessary and one of them is a
sufficient prefix: tokens are ordered by rarity (their count over all documents)
and the rarest of each window is joined against the documents' words.  Positional
and length bounds follow from the token's place in its window; what passes is
verified word for word.

The windows are the stated query set.  They are broadcast in slices of at most
``slice_rows`` rows (of ``window`` words each), as many slices as there are, so
the broadcast has a bound at every benchmark size and documents never shuffle.

Rarity and the prefix join use Unicode lower case, which equal words share; the
verification folds A-Z only, as the definition says.

Defined cases: null or wordless text has no words, no hits; a null item id counts
as an item named by the empty string; repeated rows get equal results; an empty
benchmark contaminates nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.session import write_table

WINDOW = 10
SLICE_ROWS = 100_000
_SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _words(text):
    """Words in their own case."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SEPARATOR), "")


def _folded(words):
    """Words joined by a space (which no word holds), A-Z in lower case."""
    return F.translate(F.array_join(words, " "), string.ascii_uppercase, string.ascii_lowercase)


def item_windows(items: DataFrame, window: int = WINDOW, item_col: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct ``(item, place, word, size, phrase)``: one row for each word place of
    each distinct window of each item; ``word`` in Unicode lower case."""
    size = F.size("words")
    start = F.explode(F.sequence(F.lit(1), F.greatest(size - window + 1, F.lit(1))))
    cut = (items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), _words(F.col(text)).alias("words"))
           .where(size > 0).select("item", "words", start.alias("at"))
           .select("item", F.slice("words", F.col("at"), F.lit(window)).alias("cut")))
    return (cut.select("item", "cut", _folded(F.col("cut")).alias("phrase"), F.size("cut").alias("size"))
            .dropDuplicates(["item", "phrase"])
            .select("item", "phrase", "size", F.posexplode("cut").alias("place", "word"))
            .withColumn("word", F.lower("word")))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text", id_col: str = "doc_id",
                  item_col: str = "item_id", item_text: str = "text", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_hit``, ``n_items``, ``items``
    (sorted strings) and ``contaminated``."""
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text)).alias("row"), F.col(text).alias("text"))
    worded = source.select("id", "row", _words(F.col("text")).alias("words"))
    places = write_table(item_windows(items, window, item_col, item_text), "item-windows")

    # rarity: corpus counts of the benchmark's words, summed map-side
    vocabulary = places.select("word").distinct()
    n_words = vocabulary.count()
    counts = None
    for lot in _lots(vocabulary, F.xxhash64("word"), n_words, slice_rows):
        one = (worded.select(F.explode("words").alias("word")).select(F.lower("word").alias("word"))
               .join(F.broadcast(lot), "word").groupBy("word").agg(F.count(F.lit(1)).alias("n")))
        counts = one if counts is None else counts.unionByName(one)

    # the rarest token of each window; ties by the word itself, then its place
    ranked = (places.join(counts, "word", "left")
              .groupBy("phrase", "size").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "place")).alias("rare"),
                                             F.collect_set("item").alias("items")))
    prefix = write_table(ranked.where("rare.n > 0").select("phrase", "size", "items", F.col("rare.word").alias("word"), F.col("rare.place").alias("place")), "prefix")

    spread = worded.select("id", "row", "words", F.posexplode("words").alias("at", "token"))
    hits = None
    for lot in _lots(prefix, F.xxhash64("phrase"), prefix.count(), slice_rows):
        first = F.col("at") - F.col("place")
        inside = (first >= 0) & (first + F.col("size") <= F.size("words"))
        same = F.when(inside, _folded(F.slice("words", first + 1, F.col("size"))) == F.col("phrase")).otherwise(False)
        one = (spread.join(F.broadcast(lot), (F.lower("token") == F.col("word")) & same)
               .select("id", "row", first.alias("start"), (first + F.col("size")).alias("stop"), "items"))
        hits = one if hits is None else hits.unionByName(one)

    # what is gathered for a document is bounded by its own words and the benchmark's items
    spans = F.array_sort(F.col("spans"))
    covered = F.aggregate(
        spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(s["start"], a["reach"]))).alias("n"),
                              F.greatest(a["reach"], s["stop"]).alias("reach")),
        lambda a: a["n"])
    found = (hits.groupBy("id", "row").agg(F.collect_set(F.struct("start", "stop")).alias("spans"),
                                           F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
             .select(F.col("id").alias("hit_id"), F.col("row").alias("hit_row"), covered.cast("long").alias("n_hit"), "items"))
    sized = worded.select("id", "row", F.size("words").cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return (sized.join(found, (F.col("row") == F.col("hit_row")) & F.col("id").eqNullSafe(F.col("hit_id")), "left")
            .select(F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", none).alias("items"),
                    F.col("n_hit").isNotNull().alias("contaminated")))


def _lots(df: DataFrame, key, rows: int, most: int) -> list[DataFrame]:
    """``df`` in as many parts as keep each below ``most`` rows on average."""
    n = max(1, -(-rows // most))
    return [df] if n == 1 else [df.where(F.pmod(key, F.lit(n)) == i) for i in range(n)]


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    """Contract query: whole ``documents`` against whole ``benchmark``, 10 words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


OP9_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rn, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item, array_to_string(list_slice(w, i, i + 9), ' ') AS phrase, len(list_slice(w, i, i + 9)) AS size
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
pos AS (SELECT rn, w, unnest(generate_series(1, len(w))) AS i FROM d WHERE len(w) > 0),
hit AS (
  SELECT p.rn, p.i, win.size, win.item
  FROM pos p JOIN sizes s ON p.i + s.size - 1 <= len(p.w)
  JOIN win ON win.size = s.size AND win.phrase = array_to_string(list_slice(p.w, p.i, p.i + s.size - 1), ' ')),
words AS (SELECT rn, count(DISTINCT j) AS n_hit FROM (SELECT rn, unnest(generate_series(i, i + size - 1)) AS j FROM hit) GROUP BY rn),
items AS (SELECT rn, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rn, item FROM hit) GROUP BY rn)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(words.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items.items, '')) AS items_sha256,
       words.n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (rn) LEFT JOIN items USING (rn)
"""
