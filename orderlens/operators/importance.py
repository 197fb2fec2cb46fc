"""Permutation importances of any fitted model, as Spark joins.

The importance of a feature is the ROC area that is lost when every row gets another row's
value of it. Rows are ranked twice, by two hashes of their id (distributed running sums), and
rank i of one order is paired with rank i of the other: one join deals every row's features to
another row, the same on every layout. All features are scored in one pass over rows times
features, and their exact areas are one grouped curve.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators import metrics as MT
from orderlens.operators.prefix import prefix_sums
from orderlens.session import materialize

DIGITS = 13  # hex digits of the hash that orders the rows: exact in a double
BASE = -1  # the unchanged rows


def hash_ranks(df: DataFrame, id_col: str, salt: str, out: str) -> DataFrame:
    """``df`` plus ``out``: the row's rank (from 1) by the md5 of ``salt|id``, then by id (unique)."""
    digest = F.substring(F.md5(F.concat(F.lit(f"{salt}|"), F.col(id_col).cast("string"))), 1, DIGITS)
    keyed = df.withColumns({"_hash": F.conv(digest, 16, 10).cast("bigint"), "_one": F.lit(1).cast("bigint")})
    ranked = prefix_sums(keyed, [("_hash", True), (id_col, True)], ["_one"], prefix="_rank")
    return ranked.withColumnRenamed("_rank_one", out).drop("_hash", "_one")


def paired(df: DataFrame, id_col: str, values: str, out: str, salts: tuple[str, str] = ("a", "b")) -> DataFrame:
    """``df`` plus ``out``: the ``values`` of the row that holds the same place in another random order."""
    slim = materialize(df, "permuted-rows")
    own = hash_ranks(slim, id_col, salts[0], "_place")
    other = hash_ranks(slim.select(id_col, F.col(values).alias(out)), id_col, salts[1], "_place").drop(id_col)
    return own.join(other, "_place").drop("_place")


def permutation_importance(df: DataFrame, names: Sequence[str], score: Callable[[DataFrame], DataFrame], id_col: str = "order_id",
                           label: str = "label", values: str = "values") -> DataFrame:
    """``(feature, importance)`` for the features ``names`` in the array column ``values``.

    ``score`` adds the column ``score`` to rows that hold ``values``; labels are 0 or 1. The importance
    is the exact ROC area of the unchanged rows less that with the feature's values permuted.
    """
    pairs = paired(df.select(id_col, label, values), id_col, values, "_other")
    each = pairs.withColumn("_feature", F.explode(F.sequence(F.lit(BASE), F.lit(len(names) - 1))))
    changed = F.transform(values, lambda x, i: F.when(i == F.col("_feature"), F.get("_other", i)).otherwise(x))
    scored = score(each.withColumn(values, changed).select("_feature", label, values)).select("_feature", label, "score")
    areas = materialize(MT.auc_roc(scored, "score", label, split_col="_feature"), "permuted-areas")
    base = areas.where(F.col("_feature") == BASE).select("auc_roc").scalar()
    name = F.get(F.array(*[F.lit(n) for n in names]), F.col("_feature"))
    return areas.where(F.col("_feature") != BASE).select(name.alias("feature"), (base - F.col("auc_roc")).alias("importance"))


def model_score(model, margin: Callable[[DataFrame], DataFrame], features: str = "features", values: str = "values"):
    """A ``score`` function that runs a fitted MLlib model on the array column and reads its margin."""
    return lambda d: margin(model.transform(d.withColumn(features, array_to_vector(values))))


def model_importance(model, df: DataFrame, names: Sequence[str], margin: Callable[[DataFrame], DataFrame], id_col: str = "order_id",
                     label: str = "label", features: str = "features") -> DataFrame:
    """Permutation importances of a fitted binary MLlib model on the labelled rows of ``df``."""
    rows = df.select(id_col, label, vector_to_array(features).alias("values"))
    return permutation_importance(rows, names, model_score(model, margin, features), id_col, label)


def normalised(importances: DataFrame) -> DataFrame:
    """Importances as shares: negative ones are 0, the rest add up to 1 (all 0 if none is positive)."""
    total = importances.agg(F.sum(F.greatest("importance", F.lit(0.0)))).scalar()
    share = F.coalesce(F.try_divide(F.greatest("importance", F.lit(0.0)), total), F.lit(0.0))
    return importances.select("feature", share.alias("importance"))
