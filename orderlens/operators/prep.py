"""Feature preparation: imputation, one-hot encoding, max-abs scaling
and the fitted preprocessing pipeline. All fits are distributed aggregates; only the
fitted parameters (one median / level list / max per column) reach the driver, and for
the exact forms not even those: they are scalar subqueries inlined into the plan."""

from __future__ import annotations

from typing import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, MaxAbsScaler, OneHotEncoder, RFormula, StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators.metrics import impute_medians
from orderlens.operators.bracket import medians


def median_impute(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """In-place median imputation. ``exact`` uses exact medians from bracketed
    selection; ``exact=False`` is MLlib's ``Imputer`` (approximate quantile sketch,
    relative error 0.001), as the reference."""
    if exact:
        return impute_medians(df, cols)
    return Imputer(inputCols=list(cols), outputCols=list(cols), strategy="median").fit(df).transform(df)


def onehot_encode(df: DataFrame, cols: Sequence[str], drop_last: bool = True, unseen: str = "error") -> DataFrame:
    """``<c>_index`` (levels by frequency, ties by name) and ``<c>_vec`` (one-hot,
    last level dropped by default). ``unseen='keep'`` maps unseen/NULL levels to an
    extra index (and an all-zero vector)."""
    indexer = StringIndexer(inputCols=list(cols), outputCols=[f"{c}_index" for c in cols],
                            stringOrderType="frequencyDesc", handleInvalid=unseen).fit(df)
    out = indexer.transform(df)
    # A single level with the last one dropped is a zero-width vector; MLlib's encoder
    # refuses such a column, so it gets the empty vector directly.
    width = {c: len(labels) - (1 if drop_last else 0) + (1 if unseen == "keep" else 0)
             for c, labels in zip(cols, indexer.labelsArray)}
    wide = [c for c in cols if width[c] > 0]
    if wide:
        out = OneHotEncoder(inputCols=[f"{c}_index" for c in wide], outputCols=[f"{c}_vec" for c in wide],
                            dropLast=drop_last, handleInvalid="keep" if unseen == "keep" else "error"
                            ).fit(out).transform(out)
    for c in cols:
        if width[c] == 0:
            out = out.withColumn(f"{c}_vec", array_to_vector(F.array().cast("array<double>")))
    return out


def maxabs_scale(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``x / max|x|`` per column (an all-zero column stays 0, as MLlib's
    ``MaxAbsScaler``). The maxima are one scalar subquery (a one-row aggregate)."""
    m = df.agg(F.struct(*[F.max(F.abs(F.col(c))).alias(c) for c in cols])).scalar()  # one row
    scaled = {c: F.col(c).cast("double") / F.when(F.coalesce(m.getField(c), F.lit(0)) == 0, F.lit(1.0))
              .otherwise(m.getField(c).cast("double")) for c in cols}
    return df.withColumns(scaled)


def preprocessing_pipeline(label: str, numeric: Sequence[str], categorical: Sequence[str],
                           unseen: str = "error") -> Pipeline:
    """``RFormula`` (strings indexed and one-hot encoded, last level dropped) ->
    ``MaxAbsScaler``, on imputed columns. Features are an explicit allow-list instead of
    ``. - id``, so ids and timestamps never become features. ``unseen`` is what happens to
    a level that the training part lacks: ``error``, ``keep`` (a level of its own) or ``skip``."""
    formula = f"{label} ~ " + " + ".join([*numeric, *categorical])
    return Pipeline(stages=[
        RFormula(formula=formula, featuresCol="raw_features", labelCol="label", handleInvalid=unseen),
        MaxAbsScaler(inputCol="raw_features", outputCol="features"),
    ])


def single_level(df: DataFrame, categorical: Sequence[str]) -> list[str]:
    """The categorical columns with one level or none (one global aggregate). ``RFormula``
    cannot encode them; ``prepare`` keeps them as a constant feature."""
    if not categorical:
        return []
    row = df.agg(*[(F.min(c) != F.max(c)).alias(c) for c in categorical]).first()
    return [c for c in categorical if not row[c]]


def fill_medians(df: DataFrame, fitted: dict[str, float]) -> DataFrame:
    """NULL and NaN of double columns replaced by fitted medians."""
    return df.withColumns({c: F.when(F.col(c).isNull() | F.isnan(c), F.lit(m)).otherwise(F.col(c)) for c, m in fitted.items()})


def prepare(train: DataFrame, others: Sequence[DataFrame], label: str, id_col: str,
            numeric: Sequence[str], categorical: Sequence[str],
            impute: Sequence[str] | None = None, unseen: str = "error") -> tuple[PipelineModel, list[DataFrame]]:
    """Fit the pipeline on ``train`` only (the reference fitted before splitting, which
    leaks validation rows into the medians and scales), then transform ``train`` and
    each of ``others`` (which may lack the label, e.g. the holdout) to
    ``(id, features[, label])``. Medians are exact. A categorical column of a single level
    stays as the constant feature ``<column>_index``, so the feature set depends on the
    columns asked for and not on the data."""
    cast = lambda d: d.withColumns({c: F.col(c).cast("double") for c in numeric})
    fitted = medians(cast(train), list(numeric if impute is None else impute))
    constant = single_level(train, categorical)
    fixed = {f"{c}_index": F.lit(0.0) for c in constant}
    ready = lambda d: fill_medians(cast(d), fitted).withColumns(fixed)
    model = preprocessing_pipeline(label, [*numeric, *fixed], [c for c in categorical if c not in constant], unseen).fit(ready(train))
    out = []
    for d in [train, *others]:
        t = model.transform(ready(d))
        names = t.schema["raw_features"].metadata  # scaled vector keeps the feature names
        cols = [F.col(id_col), F.col("features").alias("features", metadata=names)]
        out.append(t.select(*cols, *(["label"] if "label" in t.columns else [])))
    return model, out


def feature_names(df: DataFrame, col: str = "features") -> list[str]:
    """Feature names from the vector column's ML attribute metadata, in index order."""
    attrs = df.schema[col].metadata.get("ml_attr", {}).get("attrs", {})
    named = sorted((a["idx"], a["name"]) for group in attrs.values() for a in group)
    return [n for _, n in named]
