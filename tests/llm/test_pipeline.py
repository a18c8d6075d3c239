"""The corpus pipeline's stages on planted rows, and the contract queries' SQL."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from attrition.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    item = next(t for (t,) in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect() if len(t.split()) > 15)
    passage = " ".join(f"river{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    first, second = (" ".join(f"{w}{chr(97 + i)}" for i in range(26)) for w in ("before", "lead"))
    planted = [(900001, "twelve 12 " + item, "en", "s", 1), (900002, first + " " + passage + " after it came", "en", "s", 1),
               (900003, second + " " + passage + " quite another tail here", "en", "s", 1), (900004, "123 456", "en", "s", 1), (900005, None, None, None, None),
               (900006, "a small clean document about nothing", "en", "s", 1), (900006, "a small clean document about nothing", "en", "s", 1)]
    docs = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "bpe_codec":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        kept[name] = spark.createDataFrame(out.collect(), out.schema)
        docs = kept[name]
    ids = {n: [r.doc_id for r in t.select("doc_id").collect()] for n, t in kept.items()}
    assert not {900004, 900005} & set(ids["language_id"]) and {900001, 900006} <= set(ids["language_id"])
    assert ids["near_dedup"].count(900006) == 1 and len(ids["near_dedup"]) == len(set(ids["near_dedup"]))
    texts = {r.doc_id: r.text for r in kept["substring_dedup"].where("doc_id >= 900000").collect()}
    assert texts[900002] == first + " after it came" and texts[900003] == second + " quite another tail here"
    assert texts[900006] == "a small clean document about nothing"
    assert 900001 not in ids["decontamination"] and 900006 in ids["decontamination"]
    assert set(ids["bpe_codec"]) == set(ids["decontamination"])


def test_run_equals_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    got = QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, got.select(*cols).collect()), key=repr) == sorted(want, key=repr)


def test_queries_read_whole_tables(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op7_license_scan", "op8_language_id"):
        assert QUERIES[name](spark, SF).agg(F.count("*")).first()[0] == n


def test_near_dedup_keeps_a_clean_text_of_a_repeated_id(spark):
    import corpus_pipeline
    base = " ".join(f"a{i}" for i in range(80))
    near, other, lone = base.replace("a40", "zz"), " ".join(f"b{i}" for i in range(80)), " ".join(f"c{i}" for i in range(80))
    rows = [(1, base), (5, near), (5, other), (5, other), (None, lone), (None, lone.replace("c40", "zz")), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, "").collect()]
    assert len(got) == 4 and {(1, base), (5, other), (7, None)} < set(got)
    assert [i for i, _ in got].count(None) == 1
