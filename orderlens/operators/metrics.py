"""Evaluation operators as DataFrames.

The reference collects scored rows to the driver for ROC and lift curves and runs 25
filtered counts for a confusion matrix. Here everything is an aggregate: scores are
grouped first (partial aggregation, ties together), then distributed running sums over
the per-score table give cumulative positives/negatives. Exact areas:

* ROC AUC = sum_i neg_i * (2 cum_pos_i - pos_i) / (2 P N): the trapezoid over ROC
  points at every distinct score, equal to MLlib with ``numBins=0``.
* PR AUC: trapezoid over (recall, precision) points with the first point
  (0, precision of the top score group), as MLlib.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import INPUT_SHARE, materialize, spread
from orderlens.operators.aggregate import is_other
from orderlens.operators.bracket import medians
from orderlens.operators.prefix import default_buckets, prefix_sums

SCORES_A_TASK = 100_000  # distinct scores that a task of a running sum sorts, about


def _groups(split_col: str | None) -> list[str]:
    return [split_col] if split_col else []


def score_groups(df: DataFrame, score: str, label: str, split_col: str | None = None) -> DataFrame:
    """``(split, score, pos, neg)``: one row per distinct score."""
    lab = F.col(label)
    return df.groupBy(*_groups(split_col), score).agg(
        F.count(F.when(lab == 1, F.lit(1))).alias("pos"),
        F.count(F.when(lab == 0, F.lit(1))).alias("neg"))


def _cumulative(df: DataFrame, score: str, label: str, split_col: str | None) -> tuple[DataFrame, DataFrame]:
    """The per-score counts with running sums, and the counts themselves (written once:
    split points, bucket totals and rows all read them). Tasks and buckets grow with the scores, so that what a task
    aggregates and sorts stays the same at any size."""
    with spread(df.sparkSession, df.count() // SCORES_A_TASK * INPUT_SHARE):
        g = materialize(score_groups(df, score, label, split_col), "score-counts")
    buckets = g.count() // SCORES_A_TASK + 1
    more = {"buckets": buckets, "tasks": buckets} if buckets > default_buckets(g) else {}
    return prefix_sums(g, [(score, False)], ["pos", "neg"], _groups(split_col), few_groups=True, **more), g


def _as_double(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def _ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as double; NULL (not an ANSI error) for an empty class or split."""
    return F.try_divide(_as_double(num), _as_double(den))


def auc_roc(df: DataFrame, score: str = "score", label: str = "label", split_col: str | None = None) -> DataFrame:
    c, _ = _cumulative(df, score, label, split_col)
    num = F.sum((F.col("neg") * (2 * F.col("cum_pos") - F.col("pos"))).cast("decimal(38,0)")).cast("double")
    den = F.lit(2.0) * _as_double(F.sum("pos")) * _as_double(F.sum("neg"))
    return c.groupBy(*_groups(split_col)).agg(F.try_divide(num, den).alias("auc_roc"))


def auc_pr(df: DataFrame, score: str = "score", label: str = "label", split_col: str | None = None) -> DataFrame:
    c, _ = _cumulative(df, score, label, split_col)
    seen = F.col("cum_pos") + F.col("cum_neg")
    before = seen - F.col("pos") - F.col("neg")
    prec = _ratio("cum_pos", seen)
    prev = F.when(before == 0, prec).otherwise(_ratio(F.col("cum_pos") - F.col("pos"), before))
    area = F.try_divide(F.sum(_as_double("pos") * (prec + prev) / F.lit(2.0)), _as_double(F.sum("pos")))
    return c.groupBy(*_groups(split_col)).agg(area.alias("auc_pr"))


def _with_totals(c: DataFrame, counts: DataFrame, split_col: str | None) -> DataFrame:
    """Attach per-split totals P and N (one row per split label, broadcast)."""
    g = _groups(split_col)
    if g:
        tot = counts.groupBy(*g).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
        return c.join(F.broadcast(tot), g)
    tot = counts.agg(F.struct(F.sum("pos").alias("P"), F.sum("neg").alias("N"))).scalar()
    return c.withColumns({"P": tot.getField("P"), "N": tot.getField("N")})


def roc_points(df: DataFrame, score: str = "score", label: str = "label", split_col: str | None = None) -> DataFrame:
    """``(split, threshold, fpr, tpr)`` at every distinct score, highest first."""
    c = _with_totals(*_cumulative(df, score, label, split_col), split_col)
    return c.select(*_groups(split_col), F.col(score).alias("threshold"),
                    _ratio("cum_neg", "N").alias("fpr"),
                    _ratio("cum_pos", "P").alias("tpr"))


def lift_points(df: DataFrame, score: str = "score", label: str = "label", split_col: str | None = None,
                points: int = 10) -> DataFrame:
    """Cumulative lift at each ``1/points`` share of the positives.

    Point k sits at the first score group (ties kept together) whose cumulative
    positives reach ``k * P / points``; ``population`` is the share of rows down to
    that group and ``lift = (cum_pos / P) / population``. Integer arithmetic decides
    which group holds which point.
    """
    c = _with_totals(*_cumulative(df, score, label, split_col), split_col)
    c = c.where(F.col("P") > 0).withColumn("cum_n", F.col("cum_pos") + F.col("cum_neg"))  # no positives: no curve
    kmin = F.expr(f"({points} * (cum_pos - pos)) div P") + 1
    kmax = F.expr(f"({points} * cum_pos) div P")
    hit = c.where(kmin <= kmax).withColumn("point", F.explode(F.sequence(kmin, kmax)))
    population = _as_double("cum_n") / _as_double(F.col("P") + F.col("N"))
    return hit.select(*_groups(split_col), F.col("point").cast("int").alias("point"),
                      population.alias("population"),
                      ((_as_double("cum_pos") / _as_double("P")) / population).alias("lift"))


def margin(pred: DataFrame, raw: str = "rawPrediction", positive: int = 1, out: str = "score") -> DataFrame:
    """``out``: the raw score of the positive class, for models without probabilities (``LinearSVC``). It orders
    rows as a probability would, which is all that areas, ROC and lift read."""
    return pred.withColumn(out, vector_to_array(raw)[positive])


def class_margins(pred: DataFrame, classes: Sequence, label: str = "label", raw: str = "rawPrediction",
                  keep: Sequence[str] = ()) -> DataFrame:
    """``(class, score, label)`` with one row per row and class of a one-vs-rest model: the margin of the class and
    whether it is the row's label. ``raw`` is a vector or an array in the order of ``classes``."""
    kind = pred.schema[raw].dataType.typeName()
    values = F.col(raw) if kind == "array" else vector_to_array(raw)
    each = F.posexplode(values).alias("_i", "score")
    out = pred.select(*keep, F.col(label).alias("_label"), each)
    cls = F.get(F.array(*[F.lit(c) for c in classes]), F.col("_i"))
    return out.select(*keep, cls.alias("class"), "score", (F.col("_label") == cls).cast("int").alias("label"))


def binned_auc_roc(df: DataFrame, score: str = "score", label: str = "label", split_col: str | None = None,
                   bins: int = 1000, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """``(auc_roc, auc_low, auc_high)`` from a histogram of the scores: an estimate for nearly unique scores.

    Scores fall into ``bins`` equal bins of ``low`` .. ``high`` (those beyond into the first or last), so what is
    shuffled and what the windows sort is at most ``bins`` rows a task and split, whatever the number of rows. Only pairs
    inside one bin are unknown: the exact area lies between ``auc_low`` and ``auc_high``, and the estimate takes half of them.
    """
    place = F.floor((_as_double(score) - low) / F.lit((high - low) / bins)).cast("int")
    binned = df.withColumn("_bin", F.greatest(F.lit(0), F.least(F.lit(bins - 1), place)))
    g = _groups(split_col)
    counts = score_groups(binned, "_bin", label, split_col)
    above = Window.partitionBy(*g).orderBy(F.col("_bin").desc()).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("above", F.coalesce(F.sum("pos").over(above), F.lit(0)))
    pairs = _as_double(F.sum("pos")) * _as_double(F.sum("neg"))
    whole = lambda c: F.sum(c.cast("decimal(38,0)")).cast("double")
    sure, open_ = whole(F.col("neg") * F.col("above")), whole(F.col("neg") * F.col("pos"))
    return counts.groupBy(*g).agg(F.try_divide(sure + open_ / 2, pairs).alias("auc_roc"), F.try_divide(sure, pairs).alias("auc_low"),
                                  F.try_divide(sure + open_, pairs).alias("auc_high"))


def accuracy(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    return df.agg(F.avg(F.when(F.col(label) == F.col(pred), F.lit(1.0)).otherwise(F.lit(0.0))).alias("accuracy"))


def f1_weighted(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Support-weighted F1 over the label classes (MLlib's default ``f1``).

    One aggregate to (label, prediction) pair counts, one more to per-class
    (support, true positives, predicted); no joins.
    """
    pairs = df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("n"))
    lab, prd, n = F.col(label).cast("double"), F.col(pred).cast("double"), F.col("n")
    tp = F.when(lab == prd, n).otherwise(F.lit(0))
    per = pairs.select(F.explode(F.array(
        F.struct(lab.alias("c"), n.alias("support"), tp.alias("tp"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(prd.alias("c"), F.lit(0).cast("bigint").alias("support"), F.lit(0).cast("bigint").alias("tp"),
                 n.alias("predicted")))).alias("s")).select("s.*")
    cls = per.groupBy("c").agg(F.sum("support").alias("support"), F.sum("tp").alias("tp"),
                               F.sum("predicted").alias("predicted"))
    precision = F.when(F.col("predicted") > 0, _as_double("tp") / _as_double("predicted")).otherwise(F.lit(0.0))
    recall = F.when(F.col("support") > 0, _as_double("tp") / _as_double("support")).otherwise(F.lit(0.0))
    f1 = F.when(precision + recall > 0, F.lit(2.0) * precision * recall / (precision + recall)).otherwise(F.lit(0.0))
    return cls.agg((F.sum(_as_double("support") * f1) / _as_double(F.sum("support"))).alias("f1_weighted"))


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction",
                     classes: Sequence | None = None) -> DataFrame:
    """One grouped count. Long form ``(label, prediction, count)``; with ``classes``,
    one row per label and a ``prediction_<c>`` column per class (empty cells 0) and
    ``prediction_other`` for predictions outside the classes."""
    if classes is None:
        return df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("count"))
    return df.groupBy(label).agg(*[F.count(F.when(F.col(pred) == F.lit(c), F.lit(1))).alias(f"{pred}_{c}")
                                   for c in classes],
                                 F.count(F.when(is_other(pred, classes), F.lit(1))).alias(f"{pred}_other"))


CORR_PAIRS = 14  # at sf0.1: 5.4 s, against 7.1 s with 7 and 6.3 s with rows multiplied per pair


def impute_medians(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Replace NULL/NaN in ``cols`` by the column's exact median (of ``fit_on``, else of
    ``df``); the type is kept (integral columns take the median truncated, as MLlib's
    ``Imputer``)."""
    fitted = medians(df if fit_on is None else fit_on, cols)  # one number a column
    types = dict(df.dtypes)
    exprs = {}
    for c in cols:
        x = F.col(c)
        missing = x.isNull() | (F.isnan(x) if types[c] in ("double", "float") else F.lit(False))
        exprs[c] = F.when(missing, F.lit(fitted.get(c)).cast(types[c])).otherwise(x)
    return df.withColumns(exprs)


def _filled(df: DataFrame, cols: Sequence[str], impute: Sequence[str], sentinel: dict[str, float] | None) -> DataFrame:
    data = df.select(*cols)
    if sentinel:
        data = data.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in sentinel.items()})
    return impute_medians(data, list(impute)) if impute else data


def corr_matrix(df: DataFrame, cols: Sequence[str], impute: Sequence[str] = (),
                sentinel: dict[str, float] | None = None) -> DataFrame:
    """Pearson correlation of every column pair as ``(row, col, r)``.

    ``impute`` columns get their exact median first (the reference's ``Imputer``);
    ``sentinel`` maps columns whose NULLs are read as a number (the reference's 999).
    Remaining NULLs drop out pairwise. The distinct pairs are one grouped aggregate.
    """
    data = _filled(df, cols, impute, sentinel)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    # A few pairs per aggregate: each row is read once per aggregate and never multiplied,
    # and the generated code stays below the JIT's method-size limit (28 pairs in one do not).
    # Each aggregate is one row; a pair's row in the result is cut from it by ``stack``.
    parts = []
    for at in range(0, len(pairs), CORR_PAIRS):
        some = pairs[at:at + CORR_PAIRS]
        one = data.agg(*[F.corr(_as_double(a), _as_double(b)).alias(f"r{i}") for i, (a, b) in enumerate(some)])
        parts.append(one.select(F.inline(F.array(*[
            F.struct(F.lit(a).alias("row"), F.lit(b).alias("col"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(some)]))))
    upper = reduce(DataFrame.unionByName, parts) if parts else data.sparkSession.createDataFrame([], "row string, col string, r double")
    lower = upper.select(F.col("col").alias("row"), F.col("row").alias("col"), "r")
    diag = data.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "row string, col string, r double")
    return upper.unionByName(lower).unionByName(diag)


def _pair_sums(at: Sequence[float], block: int):
    """Task function of :func:`corr_wide`: the sums of every column pair over a task's rows."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        d = len(at)
        blocks = [slice(i, min(i + block, d)) for i in range(0, d, block)]
        met = [(a, b) for i, a in enumerate(blocks) for b in blocks[i:]]
        sums = None
        for batch in batches:
            m = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]).astype("float64")
            x = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns]) - np.array(at)
            odd = (~np.isfinite(x)).astype("float64") * m
            x = np.where(np.isfinite(x), x, 0.0) * m
            xx = x * x
            if sums is None:
                sums = [np.zeros((7, a.stop - a.start, b.stop - b.start)) for a, b in met]
            for s, (a, b) in zip(sums, met):
                ma, mb = m[:, a].T, m[:, b]
                s += (ma @ mb, x[:, a].T @ mb, ma @ x[:, b], xx[:, a].T @ mb, ma @ xx[:, b], x[:, a].T @ x[:, b],
                      odd[:, a].T @ mb + ma @ odd[:, b])
        for s, (a, b) in zip(sums or [], met):
            i, j = np.meshgrid(np.arange(a.start, a.stop), np.arange(b.start, b.stop), indexing="ij")
            upper = i < j
            cols = [i[upper].astype("int32"), j[upper].astype("int32"), *[v[upper] for v in s]]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in cols], names=["i", "j", "n", "x", "y", "xx", "yy", "xy", "odd"])
    return run


CORR_BLOCK = 64


def corr_wide(df: DataFrame, cols: Sequence[str], impute: Sequence[str] = (),
              sentinel: dict[str, float] | None = None, block: int = CORR_BLOCK) -> DataFrame:
    """:func:`corr_matrix` for hundreds of columns: ``(row, col, r)`` from two scans, whatever the number of pairs.

    The first scan takes the columns' means. In the second each task adds up count, sums, squares
    and products of all pairs about those means, as matrix products of ``block`` by ``block`` columns,
    and hands on one row per pair; these rows are all that is shuffled. A task holds seven numbers a
    pair (200 columns: 1 MB). (20,000 aggregates would not fit one generated method.)

    Defined cases: NULLs drop out pairwise; r is NULL for pairs with fewer than two common rows
    or with a column that is constant on them (its squares about its mean there below 1e-12 of
    those about the column's mean), NaN if a common row has NaN or an infinity. The diagonal is 1.
    """
    spark = df.sparkSession
    data = _filled(df, cols, impute, sentinel)
    data = data.select(*[_as_double(c).alias(f"c{i}") for i, c in enumerate(cols)])
    finite = [F.when(~F.isnan(c) & (F.abs(c) < float("inf")), F.col(c)) for c in data.columns]
    means = data.agg(F.array(*[F.avg(v) for v in finite]).alias("m")).first()["m"] if cols else []
    sums = data.mapInArrow(_pair_sums([v or 0.0 for v in means], block),
                           "i int, j int, n double, x double, y double, xx double, yy double, xy double, odd double")
    every = sums.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy", "odd")])
    sx, sy = F.col("xx") - F.col("x") * F.col("x") / F.col("n"), F.col("yy") - F.col("y") * F.col("y") / F.col("n")
    spread = (sx > 1e-12 * F.col("xx")) & (sy > 1e-12 * F.col("yy"))
    r = (F.when(F.col("odd") > 0, F.lit(float("nan")))
         .when((F.col("n") >= 2) & spread, (F.col("xy") - F.col("x") * F.col("y") / F.col("n")) / F.sqrt(sx * sy)))
    r = F.when(F.col("n") > 0, r)  # no division by the count of a pair without common rows
    names = F.array(*[F.lit(c) for c in cols])
    # An input without rows has no sums: its pairs are listed all the same.
    at = spark.range(len(cols)).select(F.col("id").cast("int").alias("i"))
    pairs = at.select("i", F.explode(F.sequence(F.lit(0), F.lit(len(cols) - 1))).alias("j")) if cols else at.select("i", F.col("i").alias("j"))
    low, high = F.least("i", "j"), F.greatest("i", "j")
    found = every.select(F.col("i").alias("lo"), F.col("j").alias("hi"), r.alias("r"))
    return (pairs.select("i", "j", low.alias("lo"), high.alias("hi")).join(found, ["lo", "hi"], "left")
            .select(F.get(names, F.col("i")).alias("row"), F.get(names, F.col("j")).alias("col"),
                    F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(F.col("r")).alias("r")))
