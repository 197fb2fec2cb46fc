"""Model training, comparison and scoring with MLlib.

All estimators are MLlib's distributed implementations, but for the gradient of the factorization
machine (``factorization``) and the histograms of the final boosted trees (``boosting``).
Results (leaderboards, importances, CV scores) are returned as DataFrames. What reaches
the driver is model state MLlib itself keeps there (one metric per model, one
importance per feature), bounded by the number of models and features, never by rows.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Any, Sequence

from pyspark import SparkContext, StorageLevel
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier,
                                       OneVsRest, OneVsRestModel, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from orderlens.operators.boosting import fit_classes, fits_on_blocks
from orderlens.operators.factorization import BlockFMClassifier
from orderlens.operators.split import hash_folds

# Fixed values of the reference's model settings.
GBT_SEED_COMPARE = 134
GBT_SEED_FINAL = 132
GBT_FINAL_DEPTH = 10
CV_DEPTHS = [4, 6, 8, 10, 12]
CV_FOLDS = 3


def num_features(df: DataFrame, col: str = "features") -> int:
    return int(df.schema[col].metadata["ml_attr"]["num_attrs"])


def binary_estimators(n_features: int, seed: int = 7) -> dict[str, Any]:
    """The six classifiers the reference compares. The MLP input width comes from the
    vector's metadata (the reference hand-counted it)."""
    return {
        "MultilayerPerceptronClassifier": MultilayerPerceptronClassifier(layers=[n_features, 2], seed=seed),
        "GBTClassifier": GBTClassifier(seed=GBT_SEED_COMPARE),
        "FMClassifier": BlockFMClassifier(seed=seed),
        "RandomForestClassifier": RandomForestClassifier(seed=seed),
        "LogisticRegression": LogisticRegression(),
        "LinearSVC": LinearSVC(),
    }


OVR_PARALLELISM = 5  # one concurrent fit per class; results do not depend on it
ROWS_AT_ONCE = 25_000_000  # rows that concurrent fits keep together, each its own binned copy (about 250 bytes a row)
FIRST_CLASS = 1  # scores are 1-5; MLlib counts classes from 0 and would fit an empty class 0


def zero_based(df: DataFrame, label: str = "label", first: int = FIRST_CLASS) -> DataFrame:
    """Scores from ``first`` on (1-5) as classes from 0 on, the form one-vs-rest models are fitted on."""
    return df.withColumn(label, F.col(label) - first)


def score_based(df: DataFrame, cols: Sequence[str] = ("label", "prediction"), first: int = FIRST_CLASS) -> DataFrame:
    """Classes from 0 on back to scores."""
    return df.withColumns({c: F.col(c) + first for c in cols if c in df.columns})


def fits_at_once(train: DataFrame, most: int) -> int:
    """How many models to fit on ``train`` at a time. Each fit of trees caches a copy of all rows; many copies of a large
    table push each other out of memory and every level reads them again. Results do not depend on it."""
    return max(1, min(most, ROWS_AT_ONCE // max(1, train.count())))


def ovr_estimators(n_features: int, seed: int = 7) -> dict[str, Any]:
    """The four one-vs-rest candidates of the multiclass comparison."""
    wrap = lambda c: OneVsRest(classifier=c, parallelism=OVR_PARALLELISM)
    return {
        "MultilayerPerceptronClassifier": wrap(MultilayerPerceptronClassifier(layers=[n_features, 2], seed=seed)),
        "GBTClassifier": wrap(GBTClassifier(seed=GBT_SEED_COMPARE)),
        "FMClassifier": wrap(BlockFMClassifier(seed=seed)),
        "LogisticRegression": wrap(LogisticRegression()),
    }


BINARY_METRICS = ("areaUnderPR", "areaUnderROC")
MULTI_METRICS = ("f1", "accuracy")


def evaluate(pred: DataFrame, metric: str) -> float:
    if metric in BINARY_METRICS:
        return BinaryClassificationEvaluator(metricName=metric, numBins=0).evaluate(pred)  # exact, at any size
    return MulticlassClassificationEvaluator(metricName=metric).evaluate(pred)


def without_summary(model: Any) -> Any:
    """``model`` without the training summaries that MLlib leaves in it: they refer to the training data and its session, go
    along with every task that scores, and fail to be serialized once that session has observed a metric."""
    none = SparkContext._active_spark_context._jvm.scala.Option.apply(None)
    for m in getattr(model, "models", [model]):
        if getattr(m, "hasSummary", False):
            m._java_obj.setSummary(none)
    return model


def leaderboard(train: DataFrame, valid: DataFrame, estimators: dict[str, Any],
                metrics: Sequence[str] = BINARY_METRICS, parallelism: int | None = None) -> tuple[DataFrame, dict[str, Any]]:
    """Fit every estimator on ``train``, score ``valid``; one row per model with one
    column per metric. Returns the table and the fitted models.

    Models are fitted concurrently (``parallelism`` driver threads submitting Spark
    jobs, as ``CrossValidator(parallelism=...)`` does); results do not depend on it.
    """
    spark = train.sparkSession

    def fit_one(item):
        name, est = item
        model = without_summary(est.fit(train))
        # Scored once, read by every metric (MEMORY_AND_DISK: recomputable on loss).
        pred = model.transform(valid).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return name, model, [float(evaluate(pred, m)) for m in metrics]
        finally:
            pred.unpersist()

    workers = parallelism or min(len(estimators), 6)  # one per model by default
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        done = list(pool.map(fit_one, estimators.items()))
    fitted = {name: model for name, model, _ in done}
    rows = [(name, *scores) for name, _, scores in done]
    schema = StructType([StructField("model", StringType())] + [StructField(m, DoubleType()) for m in metrics])
    return spark.createDataFrame(rows, schema), fitted


def model_select(board: DataFrame, metric: str = "areaUnderPR") -> DataFrame:
    """The best model by ``metric`` (the reference's comment says ROC, its code stores
    PR: the metric is a parameter)."""
    return board.agg(F.max_by("model", metric).alias("model"), F.max(metric).alias(metric))


def feature_importance(spark: SparkSession, model: Any, names: Sequence[str]) -> DataFrame:
    """``(feature, importance)`` for a tree ensemble, names from the vector metadata."""
    imp = model.featureImportances.toArray()
    schema = StructType([StructField("feature", StringType()), StructField("importance", DoubleType())])
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, imp)], schema)


def source_columns(features: Sequence[str], numeric: Sequence[str], categorical: Sequence[str]) -> list[str]:
    """The source columns behind feature names, in their order: a one-hot name
    ``<column>_<level>`` counts for its column."""
    out = []
    for f in features:
        found = f if f in numeric else next((c for c in categorical if f.startswith(f"{c}_")), None)
        if found and found not in out:
            out.append(found)
    return out


def feature_select_topk(importances: DataFrame, min_value: float = 0.05, k: int = 10) -> DataFrame:
    """Features above ``min_value``, best first (ties by name), at most ``k``: the
    limit is the feature (a top-k report)."""
    return (importances.where(F.col("importance") > min_value)
            .orderBy(F.col("importance").desc(), F.col("feature")).limit(k))


def cross_validated(train: DataFrame, estimator: Any, param: str, values: Sequence[Any], folds: int = CV_FOLDS,
                    metric: str = "areaUnderROC", id_col: str = "order_id", parallelism: int = 4) -> tuple[DataFrame, Any]:
    """k-fold cross-validation over one parameter grid: the table ``(param, avg_metric)`` and the best model,
    refitted on all rows. Folds come from the id's hash, so neither depends on partitions."""
    p = estimator.getParam(param)
    grid = ParamGridBuilder().addGrid(p, list(values)).build()
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, numFolds=folds, foldCol="fold",
                        evaluator=BinaryClassificationEvaluator(metricName=metric, numBins=0),
                        parallelism=fits_at_once(train, parallelism))
    model = cv.fit(hash_folds(train, id_col, folds))
    rows = [(float(pm[p]), float(m)) for pm, m in zip(grid, model.avgMetrics)]
    return train.sparkSession.createDataFrame(rows, f"{param} double, avg_{metric} double"), model.bestModel


def cross_validate(train: DataFrame, estimator: Any, param: str, values: Sequence[Any], **how: Any) -> DataFrame:
    """The table of ``cross_validated``."""
    return cross_validated(train, estimator, param, values, **how)[0]


def predictions(model: Any, df: DataFrame, id_col: str = "order_id", keep_label: bool = True) -> DataFrame:
    out = model.transform(df)
    cols = [id_col] + (["label"] if keep_label and "label" in out.columns else []) + ["prediction"]
    return out.select(*cols)


def ovr_fit(train: DataFrame, classifier: Any, first: int = FIRST_CLASS) -> Any:
    """One-vs-rest on scores from ``first`` on (1-5): one sub-model for each. Boosted trees on blocks are fitted for all
    classes in the same jobs."""
    rows = zero_based(train, first=first)
    if fits_on_blocks(classifier, rows, OVR_PARALLELISM):
        most = int(rows.agg(F.max(classifier.getLabelCol())).first()[0])
        models = fit_classes(classifier, rows, [float(c) for c in range(most + 1)], range(most + 1))
        return OneVsRest(classifier=classifier)._copyValues(OneVsRestModel(models=models))
    return without_summary(OneVsRest(classifier=classifier, parallelism=fits_at_once(rows, OVR_PARALLELISM)).fit(rows))


def ovr_transform(model: OneVsRestModel, df: DataFrame) -> DataFrame:
    """``model.transform`` (columns ``rawPrediction``, one margin a class, and ``prediction``) without its row-by-row Python
    functions: the sub-models' margins as an array, the first greatest one wins."""
    out, margins = df, []
    for i, sub in enumerate(model.models):
        own = sub.copy()
        own.setRawPredictionCol(f"_raw_{i}")
        for unused in ("setProbabilityCol", "setPredictionCol"):
            if hasattr(own, unused):
                getattr(own, unused)("")
        out = own.transform(out)
        margins.append(vector_to_array(f"_raw_{i}")[1])
    out = out.withColumn("_margins", F.array(*margins))
    best = (F.array_position("_margins", F.array_max("_margins")) - 1).cast("double")
    return out.withColumns({"rawPrediction": array_to_vector("_margins"), "prediction": best}).select(*df.columns, "rawPrediction", "prediction")


def ovr_scores(model: Any, df: DataFrame, id_col: str = "order_id", keep_label: bool = True, first: int = FIRST_CLASS) -> DataFrame:
    """Predicted scores from ``first`` on (``df`` holds labels as scores)."""
    known = zero_based(df, first=first) if "label" in df.columns else df
    out = ovr_transform(model, known)
    return score_based(out.select(id_col, *(["label"] if keep_label and "label" in out.columns else []), "prediction"), first=first)


def ovr_predict(train: DataFrame, valid: DataFrame, classifier: Any, id_col: str = "order_id") -> DataFrame:
    return ovr_scores(ovr_fit(train, classifier), valid, id_col)


def score_holdout(train: DataFrame, holdout: DataFrame, estimator: Any, id_col: str = "order_id") -> DataFrame:
    return predictions(estimator.fit(train), holdout, id_col, keep_label=False)


def score_merge(binary: DataFrame, multi: DataFrame, id_col: str = "order_id",
                binary_col: str = "prediction", multi_col: str = "prediction") -> DataFrame:
    """Inner join of binary and multiclass scores on the id (both sides one row per id,
    so the exchange on the id is the only cost)."""
    b = binary.select(id_col, F.col(binary_col).alias("prediction_binary"))
    m = multi.select(id_col, F.col(multi_col).alias("prediction_multiclass"))
    return b.join(m, [id_col], "inner")


def prediction_join(df: DataFrame, preds: DataFrame, id_col: str, pred_id: str) -> DataFrame:
    """Left join on differently named keys, right key dropped."""
    return df.join(preds, df[id_col] == preds[pred_id], "left").drop(preds[pred_id])


def row_max_score(df: DataFrame, cols: Sequence[str | Column], out: str = "max") -> DataFrame:
    return df.withColumn(out, F.greatest(*[F.col(c) if isinstance(c, str) else c for c in cols]))


def probability_columns(pred: DataFrame, col: str = "probability", n: int = 2, prefix: str = "p") -> DataFrame:
    """Probability vector -> array -> ``p_0 .. p_{n-1}`` scalar columns."""
    arr = pred.withColumn("_arr", vector_to_array(col))
    return arr.withColumns({f"{prefix}_{i}": F.col("_arr")[i] for i in range(n)}).drop("_arr")
