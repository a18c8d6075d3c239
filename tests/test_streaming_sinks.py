"""Streaming scorer and partitioned per-model sink."""
import os

from pyspark.sql import functions as F

from attrition.session import scratch_path
from attrition.sources import io as S
from attrition.sources.mart import materialized_mart, train_test
from attrition.streaming.scoring import fit_scorer, score_stream
from tests.conftest import SF_SMALL


def test_stream_scores_every_arriving_customer(spark):
    train, test = train_test(materialized_mart(spark, SF_SMALL))
    src = scratch_path(spark, "arrivals-test")
    test.repartition(3).write.parquet(src)
    scorer = fit_scorer(train, test, max_iter=3)
    out = score_stream(spark, src, test.schema, scorer, "scored_test_stream")
    rows = out.collect()
    assert len(rows) == test.count()
    assert {r.row_id for r in rows} == {r.row_id for r in test.select("row_id").collect()}
    assert all(0.0 <= r.p <= 1.0 and r.churn in (0, 1) for r in rows)
    batch = {r.row_id: r.p for r in scorer.score(test).collect()}
    assert all(abs(batch[r.row_id] - r.p) < 1e-12 for r in rows)      # stream == batch


def test_partitioned_sink_one_folder_per_model(spark):
    df = spark.createDataFrame([(1, "gbt", 1), (2, "gbt", 0), (1, "forest", 0)], "row_id long, model string, churn int")
    path = S.write_csv(df, scratch_path(spark, "s6-test"), partition_by=["model"])
    local = path[len("file:"):] if path.startswith("file:") else path
    assert sorted(d for d in os.listdir(local) if d.startswith("model=")) == ["model=forest", "model=gbt"]
    back = spark.read.option("header", True).schema("row_id long, churn int, model string").csv(path)
    assert back.where(F.col("model") == "gbt").count() == 2
