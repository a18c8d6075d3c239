"""Scoring a stream of new customers with a pipeline fitted on the train table.

The reference scores one static test file.  With Structured Streaming the
same fitted objects score customer rows as they arrive: everything applied
per row is stateless (feature projection, stream–static lookup join of the
category codes, literal median fills, vector assembly, the forest's one pass,
cut-off), so each micro-batch is independent and the query needs no state
store.  The sink is a folder of Parquet files; the checkpoint location lives in the
shared checkpoint folder.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.operators import boosting as BO
from attrition.operators import encode as N
from attrition.operators import evaluate as V
from attrition.operators import train as M
from attrition.operators.clean import sweep_inf
from attrition.operators.folds import stratified_folds
from attrition.operators.stats import apply_fills, fit_stats
from attrition.plans import recipes
from attrition.session import cut_lineage, scratch_path
from attrition.sources.mart import CATEGORICALS


@dataclass
class FittedScorer:
    codes: DataFrame           # (column_name, value, code), checkpointed
    fills: dict                # train medians
    features: list
    forest: BO.Forest          # fitted on all rows
    threshold: float

    def score(self, df: DataFrame) -> DataFrame:
        """Stateless per-row scoring; works on batch and streaming frames
        (stream–static joins against the checkpointed code table)."""
        feats = recipes.simple(sweep_inf(df))
        for c in CATEGORICALS:
            m = self.codes.where(F.col("column_name") == c).select(F.col("value").alias("_v"),
                                                                   F.col("code").alias("_code"))
            feats = (feats.withColumn("_v", N.as_key(c)).join(m, ["_v"], "left")
                     .withColumn(c, F.col("_code")).drop("_v", "_code"))
        feats = apply_fills(feats, self.fills)
        p = self.forest.score(M.assemble(feats, self.features), ["row_id"]).select("row_id", F.col("scores")[0].alias("p"))
        return p.select("row_id", "p", F.coalesce((F.col("p") >= F.lit(self.threshold)).cast("int"), F.lit(0)).alias("churn"))


def fit_scorer(train: DataFrame, test_codes_source: DataFrame, max_iter: int | None = None, threshold: float | None = None,
               seed: int = 42, k: int = 5) -> FittedScorer:
    """Fit the ``simple`` recipe pipeline on ``train`` (codes on train ∪ known test values).
    Without a ``threshold`` the cut-off is the best of the grid on out-of-fold scores."""
    feats = recipes.simple(sweep_inf(train))
    both = feats.select(*CATEGORICALS).unionByName(test_codes_source.select(*CATEGORICALS))
    codes = N.fit_ordinal(both, CATEGORICALS)
    enc = N.apply_ordinal(feats, codes, CATEGORICALS)
    features = [c for c in enc.columns if c not in ("row_id", "churn", "date_of_registration")]
    st = fit_stats(enc, [("median", c) for c in features])
    fills = {c: st[("median", c)] for c in features}
    enc = apply_fills(enc, fills)
    vec = M.assemble(stratified_folds(enc, k, seed).withColumn("label", F.col("churn").cast("double")), features)
    vec = cut_lineage(vec.select("row_id", "label", "fold", "features"))
    member = M.boost_member("cat", "simple", seed, max_iter)
    if threshold is None:
        found = BO.fit(vec, {"cat": member}, range(k), len(features), weight=None)
        threshold = float(V.best_threshold(BO.oof_scores(found, vec, "cat"), V.grid("wide"), "p", "label").first()["best_threshold"])
        member = replace(member, trees=max(1, round(sum(found.kept.values()) / k)))
    whole = BO.fit(vec, {"cat": replace(member, patience=0)}, [-1], len(features), weight=None)
    return FittedScorer(codes, fills, features, whole.forest, threshold)


def score_stream(spark: SparkSession, source_dir: str, schema, scorer: FittedScorer,
                 query_name: str = "scored_customers") -> DataFrame:
    """Run the streaming scorer over every file in ``source_dir`` to completion
    into Parquet files of the shared folder (``availableNow``) and read them back;
    no scored row goes through the driver."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source_dir)
    scored = scorer.score(stream)
    out = scratch_path(spark, f"scored-{query_name}")
    q = (scored.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
         .option("checkpointLocation", scratch_path(spark, f"ckpt-{query_name}")).start(out))
    q.awaitTermination()
    return spark.read.schema(scored.schema).parquet(out)
