"""Customer-attrition analytics on Spark DataFrames.

Sub-packages:
  sources    – table readers, the customer mart, CSV scan, ids, sinks, output checks
  functions  – null-safe Column helpers and the derived-feature expressions
  operators  – profiling, cleaning, fitted statistics, encoders, folds,
               resampling, training, evaluation, blending
  plans      – feature recipes and the end-to-end out-of-fold pipeline
  streaming  – scoring a stream of new customers with a fitted pipeline
"""

from attrition.session import get_spark, checkpoint_dir  # noqa: F401
