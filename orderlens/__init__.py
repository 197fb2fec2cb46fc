"""orderlens: Spark-native order analytics and review scoring.

Every operator is a function from DataFrames to a DataFrame. Scalar work stays in
built-in ``pyspark.sql.functions`` (JVM side, whole-stage codegen); models are MLlib
estimators. No Python UDF is used anywhere.
"""

from orderlens.session import build_session, checkpoint_dir, materialize

__all__ = ["build_session", "checkpoint_dir", "materialize"]
