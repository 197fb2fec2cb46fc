"""Golden and property tests on small frames (nulls, ties, hot keys, empty input)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orderlens import functions as X
from orderlens.operators import aggregate as A
from orderlens.operators import clean as C
from orderlens.operators import metrics as MT
from orderlens.operators import pareto as P
from orderlens.operators import prefix
from orderlens.operators import prep as PR
from orderlens.operators import split as S
from orderlens.sources import csv as CSV


def test_prefix_sums_match_pandas_with_groups(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(0, 4, 3000), "k": rng.permutation(3000).astype(float),
                        "w": rng.integers(1, 9, 3000)})
    out = prefix.prefix_sums(spark.createDataFrame(pdf), [("k", False)], ["w"], ["g"], buckets=16).toPandas()
    exp = pdf.sort_values("k", ascending=False).assign(cum=lambda d: d.groupby("g")["w"].cumsum())
    m = out.merge(exp, on=["g", "k"])
    assert len(m) == 3000 and (m["cum_w"] == m["cum"]).all()


def test_prefix_sums_empty_input(spark):
    df = spark.createDataFrame([], "k double, w long")
    assert prefix.prefix_sums(df, [("k", True)], ["w"]).count() == 0


def test_exact_medians_odd_even_nulls_and_hot_value(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0, 4.0, None, None],
                        "b": [5.0, 5.0, 5.0, 5.0, 1.0, 9.0],
                        "c": [7.0, None, None, None, None, None]})
    got = dict(prefix.exact_medians(spark.createDataFrame(pdf), ["a", "b", "c"]).collect())
    assert got == {"a": 2.5, "b": 5.0, "c": 7.0}


def test_impute_medians_keeps_integral_type(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, None), (4, 3), (5, 4)], "id int, n long")
    out = MT.impute_medians(df, ["n"])
    assert dict(out.dtypes)["n"] == "bigint"
    assert {r["id"]: r["n"] for r in out.collect()}[3] == 2  # median 2.5 truncated, as MLlib


def test_recode_and_flags_with_nulls(spark):
    df = spark.createDataFrame([("delivered", 1), ("created", None), (None, 3)], "s string, d int")
    out = df.select(X.recode("s", {"delivered": "delivered"}, "processing").alias("st"),
                    X.presence_flag("d").alias("f")).collect()
    assert [(r.st, r.f) for r in out] == [("delivered", 1), ("processing", 0), ("processing", 1)]


def test_recode_keep_turns_numbers_to_text(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,)], "p double")
    got = [r[0] for r in df.select(X.recode("p", {0.0: "Negative", 1.0: "Positive"})).collect()]
    assert got == ["Negative", "Positive", "10.0"]  # no wildcard accident on 10.0


def test_safe_divide_zero_is_null_under_ansi(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 2)], "x double, w int")
    assert [r[0] for r in df.select(X.safe_divide("x", "w")).collect()] == [None, 0.5]


def test_dropna_all_and_sentinel_fill(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, "2020-01-01 00:00:00")], "id int, d int, t string")
    df = df.withColumn("t", F.to_timestamp_ntz("t"))
    kept = C.dropna_all(df, ["d", "t"]).collect()
    assert [r.id for r in kept] == [2]
    filled = C.sentinel_fill(df, {"d": 999}, to_string=["t"]).orderBy("id").collect()
    assert [(r.d, r.t) for r in filled] == [(999, "2080-01-01 01:00:00"), (999, "2020-01-01 00:00:00")]


def test_multi_flag_counts_distinct_not_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 2), ("c", None)], "k string, v int")
    got = dict(A.multi_flag(df, "k", "v", "m").collect())
    assert got == {"a": "no", "b": "yes", "c": "no"}


def test_pivot_row_sums_equal_ungrouped_sums(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"o": rng.integers(0, 50, 500), "t": rng.choice(list("xyz"), 500),
                        "v": rng.integers(0, 100, 500)})
    df = spark.createDataFrame(pdf)
    piv = A.pivot_agg(df, "o", "t", ["x", "y", "z"], {"s": ("sum", "v")})
    total = piv.agg(F.sum(F.col("x") + F.col("y") + F.col("z"))).first()[0]
    assert total == pdf["v"].sum()


def test_pareto_null_category_never_in_top_and_ties_by_name(spark):
    rows = [("a", i) for i in range(5)] + [("b", i) for i in range(5, 10)] + [(None, i) for i in range(10, 30)]
    df = spark.createDataFrame(rows, "cat string, product_id int")
    fitted = P.pareto_fit(df, "cat", share=0.8)
    assert sorted(r.cat or "" for r in fitted.collect()) == [""]  # NULL group (20) < 0.8 * 30
    flagged = P.pareto_apply(df, fitted, "cat", out="flag")
    assert flagged.where("cat IS NULL AND flag = 'in_top_20'").count() == 0
    cum = {r.cat: r.accumulate for r in P.cumulative_counts(df, "cat").collect()}
    assert cum == {None: 20, "a": 25, "b": 30}


def test_time_split_is_exact_and_complementary(spark):
    rng = np.random.default_rng(5)
    n = 1001
    ts = pd.to_datetime("2020-01-01") + pd.to_timedelta(rng.integers(0, 5, n), unit="D")
    pdf = pd.DataFrame({"id": rng.permutation(n), "ts": ts})
    pdf.loc[:40, "ts"] = pd.NaT  # NULL timestamps sort last
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    first, rest = S.split_time_prefix(df, "ts", "id", 0.7)
    k = int(n * 0.7)
    exp = pdf.assign(nul=pdf.ts.isna()).sort_values(["nul", "ts", "id"]).id.tolist()
    assert sorted(r.id for r in first.collect()) == sorted(exp[:k])
    assert sorted(r.id for r in rest.collect()) == sorted(exp[k:])


def test_complement_is_anti_join(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    part = df.where("k < 3")
    assert sorted(r.k for r in S.complement(df, part, "k").collect()) == list(range(3, 10))


def test_stratified_sample_rejects_missing_stratum(spark):
    df = spark.createDataFrame([(1, 0), (2, 1)], "id int, label int")
    with pytest.raises(Exception, match="no fraction"):
        S.stratified_sample(df, "id", "label", {1: 0.5}).collect()


def test_stratified_sample_hash_is_deterministic(spark):
    df = spark.range(2000).withColumn("label", F.col("id") % 3)
    a = S.stratified_sample(df, "id", "label", {0: 0.5, 1: 0.5, 2: 0.5})
    b = S.stratified_sample(df.repartition(7), "id", "label", {0: 0.5, 1: 0.5, 2: 0.5})
    assert sorted(r.id for r in a.collect()) == sorted(r.id for r in b.collect())
    assert 800 < a.count() < 1200


def test_except_all_keeps_multiplicity(spark):
    a = spark.createDataFrame([(1,), (1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (3,)], "x int")
    assert sorted(r.x for r in S.except_all(a, b).collect()) == [1, 1, 2]
    assert sorted(r.x for r in S.except_distinct(a, b).collect()) == [2]


def _scores(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    label = rng.integers(0, 2, n)
    score = np.round(label * 0.3 + rng.random(n), 2)  # rounding creates ties
    return spark.createDataFrame(pd.DataFrame({"score": score, "label": label}))


def test_auc_matches_mllib_exact_and_is_monotone_invariant(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df = _scores(spark)
    ours = MT.auc_roc(df).first()[0]
    ml = BinaryClassificationEvaluator(numBins=0).evaluate(
        df.select(F.col("score").alias("rawPrediction"), F.col("label").cast("double").alias("label")))
    assert abs(ours - ml) < 1e-12
    moved = df.withColumn("score", F.exp(F.col("score") * 3) + 5)
    assert abs(MT.auc_roc(moved).first()[0] - ours) < 1e-12
    pr = BinaryClassificationEvaluator(numBins=0, metricName="areaUnderPR").evaluate(
        df.select(F.col("score").alias("rawPrediction"), F.col("label").cast("double").alias("label")))
    assert abs(MT.auc_pr(df).first()[0] - pr) < 1e-12


def test_lift_last_point_covers_all_positives(spark):
    df = _scores(spark, seed=2)
    pts = MT.lift_points(df).orderBy("point").collect()
    assert [p.point for p in pts] == list(range(1, 11))
    assert pts[-1].population <= 1.0
    assert all(p.lift >= 1.0 - 1e-9 for p in pts)


def test_roc_points_end_at_one(spark):
    pts = MT.roc_points(_scores(spark, seed=4)).orderBy(F.col("threshold").desc()).collect()
    assert pts[-1].fpr == 1.0 and pts[-1].tpr == 1.0
    assert all(a.tpr <= b.tpr and a.fpr <= b.fpr for a, b in zip(pts, pts[1:]))


def test_confusion_total_and_f1_against_mllib(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"label": rng.integers(1, 6, 500).astype(float), "prediction": rng.integers(1, 6, 500).astype(float)})
    df = spark.createDataFrame(pdf)
    cm = MT.confusion_matrix(df, classes=[1, 2, 3, 4, 5])
    assert cm.agg(F.sum(sum(F.col(f"prediction_{c}") for c in range(1, 6)))).first()[0] == 500
    ml = MulticlassClassificationEvaluator(metricName="f1").evaluate(df)
    assert abs(MT.f1_weighted(df).first()[0] - ml) < 1e-12
    acc = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(df)
    assert abs(MT.accuracy(df).first()[0] - acc) < 1e-12


def test_corr_matrix_matches_pandas(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"a": rng.normal(size=300), "b": rng.normal(size=300)})
    pdf["c"] = pdf.a * 2 + rng.normal(size=300) * 0.1
    got = {(r.row, r.col): r.r for r in MT.corr_matrix(spark.createDataFrame(pdf), ["a", "b", "c"]).collect()}
    exp = pdf.corr()
    assert len(got) == 9
    for (a, b), r in got.items():
        assert abs(r - exp.loc[a, b]) < 1e-9


def test_maxabs_scale_matches_mllib(spark):
    df = spark.createDataFrame([(1, -4.0, 0.0), (2, 2.0, 0.0), (3, None, 0.0)], "id int, x double, z double")
    got = {r.id: (r.x, r.z) for r in PR.maxabs_scale(df, ["x", "z"]).collect()}
    assert got == {1: (-1.0, 0.0), 2: (0.5, 0.0), 3: (None, 0.0)}


def test_onehot_levels_by_frequency_then_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "s string")
    out = PR.onehot_encode(df, ["s"]).collect()
    idx = {r.s: r.s_index for r in out}
    assert idx == {"c": 0.0, "a": 1.0, "b": 2.0}
    assert {r.s: r.s_vec.size for r in out} == {"c": 2, "a": 2, "b": 2}


def test_csv_sink_default_refuses_existing_path(spark, tmp_path):
    df = spark.range(3)
    path = str(tmp_path / "out")
    CSV.write_csv(df, path)
    with pytest.raises(Exception):
        CSV.write_csv(df, path)
    back = CSV.read_headerless(spark, path, df.schema, ["n"])
    assert sorted(r.n for r in back.collect()) == [0, 1, 2]


def test_time_split_on_zone_aware_timestamps(spark):
    rng = np.random.default_rng(8)
    n = 300
    pdf = pd.DataFrame({"id": rng.permutation(n), "d": rng.integers(0, 4, n)})
    df = spark.createDataFrame(pdf).withColumn(
        "ts", F.timestamp_seconds(F.lit(1_600_000_000) + F.col("d") * 3600))  # zone-aware type
    first, rest = S.split_time_prefix(df, "ts", "id", 0.5)
    exp = pdf.sort_values(["d", "id"]).id.tolist()
    assert sorted(r.id for r in first.collect()) == sorted(exp[:150])
    assert first.count() + rest.count() == n


def test_parse_timestamp_null_on_bad_text(spark):
    df = spark.createDataFrame([("2020-03-08 02:30:00",), ("not a time",), (None,)], "s string")
    got = [r[0] for r in df.select(X.parse_timestamp("s", "yyyy-MM-dd HH:mm:ss").cast("string")).collect()]
    assert got == ["2020-03-08 02:30:00", None, None]


def test_bernoulli_sample_close_to_fraction(spark):
    df = spark.range(4000).withColumn("label", F.col("id") % 2)
    n = S.stratified_sample(df, "id", "label", {0: 0.25, 1: 0.75}, method="bernoulli", seed=1).groupBy(
        "label").count().collect()
    got = {r.label: r["count"] for r in n}
    assert 400 < got[0] < 600 and 1400 < got[1] < 1600


def test_metrics_on_one_class_input_do_not_fail(spark):
    df = spark.createDataFrame([(0.1, 1), (0.7, 1), (0.7, 1)], "score double, label int")
    assert MT.auc_roc(df).first()[0] is None  # no negatives: undefined, not an error
    assert MT.lift_points(df.withColumn("label", F.lit(0))).count() == 0
    pts = MT.roc_points(df).collect()
    assert all(p.fpr is None and p.tpr is not None for p in pts)


def test_ntz_sort_key_ignores_session_time_zone(spark):
    pdf = pd.DataFrame({"id": range(6), "ts": ["2021-03-14 01:59:00", "2021-03-14 02:00:00", "2021-03-14 02:30:00",
                                               "2021-03-14 02:59:59", "2021-03-14 03:00:00", "2021-03-14 03:30:00"]})
    df = spark.createDataFrame(pdf).withColumn("ts", F.to_timestamp_ntz("ts")).withColumn("w", F.lit(1))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:00-03:00 does not exist here
    try:
        out = prefix.prefix_sums(df, [("ts", True)], ["w"], buckets=4).orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [r.cum_w for r in out] == [1, 2, 3, 4, 5, 6]
