"""Bracketed selection, permutation importances, margins, folds, fitted pivots and observed profiles."""

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from orderlens.operators import aggregate as A
from orderlens.operators import bracket as BR
from orderlens.operators import clean as C
from orderlens.operators import importance as IM
from orderlens.operators import metrics as MT
from orderlens.operators import models as MO
from orderlens.operators import split as SP


@pytest.fixture(params=[100_000, 3])
def few(request, monkeypatch):
    monkeypatch.setattr(BR, "FEW", request.param)
    monkeypatch.setattr(SP, "FEW", request.param)


def test_medians_with_ties_nulls_nan_and_infinity(spark, few):
    r = random.Random(2)
    rows = [(i, None if r.random() < .2 else r.choice([r.gauss(0, 1), 5.0, math.nan, float(r.randrange(4)), math.inf]), 7.0, None,
             float(r.randrange(1000))) for i in range(1500)]
    got = BR.medians(spark.createDataFrame(rows, "id long, a double, b double, c double, d double"), ["a", "b", "c", "d"])
    for j, c in enumerate("abd"):
        v = [x[(1, 2, 4)[j]] for x in rows]
        assert got[c] == statistics.median(x for x in v if x is not None and not math.isnan(x))
    assert "c" not in got


def test_medians_survive_a_sketch_that_misses(spark, monkeypatch):
    """A bracket is believed only where counting confirms it."""
    monkeypatch.setattr(BR, "FEW", 5)
    monkeypatch.setattr(BR, "_sketch", lambda v, shares: F.array(F.lit(900.0), F.lit(950.0)))
    assert BR.medians(spark.range(1001).select(F.col("id").cast("double").alias("x")), ["x"]) == {"x": 500.0}


def test_medians_move_few_values(spark):
    df = spark.range(200_000).select((F.xxhash64("id") / 2.0 ** 40).alias("x"))
    b = BR.brackets(df, {"x": F.col("x")}, 0.5, lambda n: ((n + 1) // 2, n // 2 + 1))["x"]
    assert b.n == 200_000 and b.inside <= 0.001 * b.n


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "string"])
def test_time_prefix_with_a_hot_time(spark, few, kind):
    r = random.Random(3)
    rows = [(None if r.random() < .1 else f"2020-01-01 00:00:{10 if r.random() < .6 else r.randrange(20):02d}", i) for i in range(900)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "t string, id long").select(F.col("t").cast(kind).alias("t"), "id")
    for share in (.7, .002, .97):
        got = {x["id"] for x in df.where(SP.time_prefix_predicate(df, "t", "id", share)).collect()}
        assert got == {x[1] for x in sorted(rows, key=lambda x: (x[0] is None, x[0] or "", x[1]))[:int(len(rows) * share)]}


def test_pairs_are_a_permutation_that_no_layout_changes(spark):
    rows = spark.range(300).select(F.col("id").alias("order_id"), F.array(F.col("id").cast("double")).alias("values"))
    seen = [sorted((r["order_id"], r["other"][0]) for r in IM.paired(rows.repartition(n), "order_id", "values", "other").collect()) for n in (1, 7)]
    assert seen[0] == seen[1] and sorted(int(b) for _, b in seen[0]) == list(range(300))
    assert sum(a == b for a, b in seen[0]) < 10


def numpy_auc(score, label):
    _, where, counts = np.unique(score, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - (counts - 1) / 2)[where]
    pos = label == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_permutation_importance_agrees_with_numpy(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 4))
    y = (x @ [3.0, 1.0, 0.2, 0.0] + rng.normal(size=3000) > 0).astype(int)
    rows = spark.createDataFrame([(i, int(t), [float(v) for v in r]) for i, (r, t) in enumerate(zip(x, y))],
                                 "order_id long, label int, values array<double>")
    model = LinearSVC().fit(rows.withColumn("features", array_to_vector("values")))
    names = ["strong", "weak", "faint", "none"]
    got = {r["feature"]: r["importance"] for r in IM.permutation_importance(rows, names, IM.model_score(model, MT.margin)).collect()}
    w = np.array(model.coefficients.toArray())
    base = numpy_auc(x @ w, y)
    want = {}
    for j, n in enumerate(names):
        z = x.copy()
        z[:, j] = rng.permutation(z[:, j])
        want[n] = base - numpy_auc(z @ w, y)
    assert sorted(got, key=got.get)[2:] == ["weak", "strong"]
    assert all(abs(got[n] - want[n]) < 0.02 for n in names)


def test_normalised_importances_add_up(spark):
    df = spark.createDataFrame([("a", 0.3), ("b", -0.1), ("c", 0.1)], "feature string, importance double")
    assert {r["feature"]: round(r["importance"], 9) for r in IM.normalised(df).collect()} == {"a": 0.75, "b": 0.0, "c": 0.25}
    assert {r["importance"] for r in IM.normalised(df.where("feature = 'b'")).collect()} == {0.0}


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 2))
    rows = [(i, int(1 + (v[0] + rng.normal() > 0) + (v[1] > 0.5)), [float(a) for a in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "order_id long, label int, x array<double>")
    return df.select("order_id", "label", array_to_vector("x").alias("features"))


def test_margin_areas_equal_mllib(spark, labelled):
    binary = labelled.withColumn("label", (F.col("label") > 1).cast("int"))
    pred = LinearSVC().fit(binary).transform(binary)
    area = MT.auc_roc(MT.margin(pred), "score", "label").first()["auc_roc"]
    assert area == pytest.approx(BinaryClassificationEvaluator(numBins=0).evaluate(pred), abs=1e-12)


def test_class_margins_have_one_curve_per_class(spark, labelled):
    from pyspark.ml.classification import OneVsRest
    zero = labelled.withColumn("label", F.col("label") - 1)
    model = OneVsRest(classifier=LogisticRegression()).fit(zero)
    out = MT.class_margins(model.transform(labelled), [1, 2, 3], keep=["order_id"])
    assert out.count() == 3 * labelled.count() and out.where("label = 1").count() == labelled.count()
    areas = {r["class"]: r["auc_roc"] for r in MT.auc_roc(out, "score", "label", split_col="class").collect()}
    for i, sub in enumerate(model.models):
        own = sub.transform(labelled.withColumn("label", (F.col("label") == i + 1).cast("int")))
        assert areas[i + 1] == pytest.approx(BinaryClassificationEvaluator(numBins=0).evaluate(own), abs=1e-12)


def test_binned_area_bounds_hold_the_exact_one(spark):
    df = spark.range(5000).select((F.pmod(F.xxhash64("id"), F.lit(100_003)) / 100_003.0).alias("score"), F.col("id"))
    df = df.withColumn("label", (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)) < 100 * F.col("score")).cast("int"))
    exact = MT.auc_roc(df).first()["auc_roc"]
    for bins in (1, 16, 4096):
        r = MT.binned_auc_roc(df, bins=bins).first()
        assert r["auc_low"] <= exact <= r["auc_high"] and r["auc_high"] - r["auc_low"] <= 2 / bins + 1e-9
    assert MT.binned_auc_roc(df.where("label = 1")).first()["auc_roc"] is None


def test_cross_validation_does_not_depend_on_partitions(spark, labelled):
    binary = labelled.withColumn("label", (F.col("label") > 1).cast("int"))
    runs = [MO.cross_validated(binary.repartition(n), LogisticRegression(), "regParam", [0.0, 10.0]) for n in (4, 40)]
    tables = [sorted((r[0], round(r[1], 9)) for r in t.collect()) for t, _ in runs]
    assert tables[0] == tables[1]
    best = max(tables[0], key=lambda r: r[1])[0]
    assert runs[0][1].getRegParam() == best


def test_fitted_pivot_gives_an_unlisted_type_its_column(spark):
    train = spark.createDataFrame([(1, "new", 1.0), (1, "card", 2.0), (2, "card", 3.0), (2, None, 9.0)], "id long, kind string, v double")
    kinds = A.frequent_values(train, "kind")
    assert kinds == ["card", "new"] and A.frequent_values(train, "kind", most=1) == ["card"]
    hold = spark.createDataFrame([(7, "new", 5.0), (7, "odd", 2.0), (8, "card", 1.0)], "id long, kind string, v double")
    out = A.pivot_agg(hold, "id", "kind", kinds, {"v": ("sum", "v")})
    assert {tuple(r) for r in out.select("id", "card", "new", "other").collect()} == {(7, 0.0, 5.0, 2.0), (8, 1.0, 0.0, 0.0)}


def test_profiles_are_observed_in_one_pass(spark):
    df = spark.createDataFrame([(1, None, 3), (2, "2020-01-01 00:00:00", None), (3, None, None)], "id long, t string, n int")
    cleaned, profile = C.clean_orders_profiled(df.withColumn("t", F.col("t").cast("timestamp")), ["t"], ["n"])
    assert cleaned.count() == 1
    assert {tuple(r) for r in profile.collect()} == {("before", "id", 0, 3), ("before", "t", 2, 3), ("before", "n", 2, 3),
                                                     ("after", "id", 0, 1), ("after", "t", 0, 1), ("after", "n", 0, 1)}


def test_models_score_after_profiles_were_observed(spark, labelled):
    binary = labelled.withColumn("label", (F.col("label") > 1).cast("int"))
    model = LinearSVC(maxIter=2).fit(binary)
    C.clean_orders_profiled(spark.sql("SELECT 1 AS id, TIMESTAMP '2020-01-01 00:00:00' AS t, 2 AS n"), ["t"], ["n"])
    assert 0 <= model.transform(binary).agg(F.sum("prediction")).first()[0] <= 400


def test_models_score_in_a_session_that_has_observed(spark, labelled):
    from pyspark.sql import Observation
    own = spark.newSession()  # other tests go on in the shared one
    rows = own.createDataFrame([(r["order_id"], r["label"], r["features"]) for r in labelled.collect()], ["order_id", "label", "features"])
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).count()
    assert seen.get == {"n": 400}
    binary = rows.withColumn("label", (F.col("label") > 1).cast("int"))
    board, _ = MO.leaderboard(binary, binary, {"svc": LinearSVC(maxIter=3), "lr": LogisticRegression(maxIter=3)})
    assert all(0.5 < r["areaUnderROC"] <= 1 for r in board.collect())
    assert MO.ovr_scores(MO.ovr_fit(rows, LogisticRegression(maxIter=3)), rows).count() == 400


def test_large_tables_are_fitted_by_fewer_models_at_a_time(spark, labelled, monkeypatch):
    assert MO.fits_at_once(labelled, 5) == 5
    whole = [m.coefficients.toArray() for m in MO.ovr_fit(labelled, LogisticRegression()).models]
    monkeypatch.setattr(MO, "ROWS_AT_ONCE", 900)  # 400 rows
    assert MO.fits_at_once(labelled, 5) == 2
    seen, wrapped = [], MO.OneVsRest
    monkeypatch.setattr(MO, "OneVsRest", lambda **how: seen.append(how["parallelism"]) or wrapped(**how))
    monkeypatch.setattr(MO, "ROWS_AT_ONCE", 1)
    alone = [m.coefficients.toArray() for m in MO.ovr_fit(labelled, LogisticRegression()).models]
    assert seen == [1] and np.allclose(whole, alone, atol=1e-9)
