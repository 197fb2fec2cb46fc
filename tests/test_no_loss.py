"""Nothing is dropped, cut or changed silently: the probes of the first review, as tests."""

import os
import shutil

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from orderlens import session
from orderlens.operators import aggregate as A
from orderlens.operators import clean as C
from orderlens.operators import metrics as MT
from orderlens.operators import models as M
from orderlens.operators import prefix
from orderlens.operators import prep as PR
from orderlens.operators import split as S
from orderlens.plans import basetable as B
from orderlens.plans import features as FE
from orderlens.sources import csv as CSV
from orderlens.sources import tables as TB


def test_unlisted_payment_type_is_kept(spark):
    pay = spark.createDataFrame([(1, "boleto", 1, 100.0), (1, "voucher", 2, 5.0), (2, "boleto", 1, 50.0), (3, None, 1, 7.0)],
                                "order_id int, payment_type string, payment_installments int, payment_value double")
    got = {r.order_id: r for r in FE.payments_by_order(pay, FE.NORMALIZED_PAYMENT_TYPES).collect()}
    assert (got[1].voucher_amount, got[1].other_amount, got[2].other_amount, got[3].other_amount) == (5.0, 100.0, 50.0, 7.0)
    total = sum(r[f"{t}_amount"] for r in got.values() for t in [*FE.NORMALIZED_PAYMENT_TYPES, "other"])
    assert total == pay.agg(F.sum("payment_value")).first()[0]


def test_unlisted_levels_and_classes_are_kept(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "z"), ("b", None)], "k string, v string")
    assert {tuple(r) for r in A.crosstab(df, "k", "v", ["x", "y"]).collect()} == {("a", 1, 0, 1), ("b", 0, 0, 1)}
    preds = spark.createDataFrame([(1, 1), (1, 7), (2, None)], "label int, prediction int")
    got = {r.label: r for r in MT.confusion_matrix(preds, classes=[1, 2]).collect()}
    assert got[1].prediction_other == 1 and got[2].prediction_other == 1
    assert sum(r.prediction_1 + r.prediction_2 + r.prediction_other for r in got.values()) == 3


def _lines(tmp_path, text):
    path = tmp_path / "t.csv"
    path.write_text(text)
    return str(path)


def test_csv_malformed_value_fails(spark, tmp_path):
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|oops"):
        CSV.read_csv(spark, _lines(tmp_path, "a,b\nx,1\ny,oops\n"), "a string, b int", header=True).collect()


def test_csv_header_in_other_order_fails(spark, tmp_path):
    with pytest.raises(Exception, match="header|schema"):
        CSV.read_csv(spark, _lines(tmp_path, "b,a\n1,x\n"), "a string, b int", header=True).collect()


def test_csv_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([(1, "two\nlines"), (2, ' "quoted", \\ ')], "i int, s string")
    with pytest.raises(Exception, match="line break"):
        CSV.write_csv(df, str(tmp_path / "a"), header=True)
    path = CSV.write_csv(df, str(tmp_path / "b"), header=True, multi_line=True)
    back = CSV.read_csv(spark, path, df.schema, header=True, multi_line=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_csv_keeps_microseconds(spark):
    df = spark.createDataFrame([("2020-01-02 03:04:05.123456",)], "t string").select(F.col("t").cast("timestamp_ntz"))
    assert CSV.csv_roundtrip(df).collect() == df.collect()


def test_order_tables_load_with_corrected_names(spark, tmp_path):
    products = spark.createDataFrame([("p1", "toys", 4, 9, 1, 100, 2, 3, 4)], TB.schema("products")).withColumnsRenamed(TB.MISSPELT)
    orders = spark.createDataFrame([("o1", "c1", "delivered", *["2020-01-02 03:04:05"] * 5)],
                                   ", ".join(f"{c.split(' ')[0]} string" for c in TB.schema("orders").split(", ")))
    pay = spark.createDataFrame([("o1", "boleto", 1, 2.5)], TB.schema("order_payments"))
    items = spark.createDataFrame([("o1", "p1", 2.0, 0.5)], TB.schema("order_items"))
    folder = TB.save({"products": products, "orders": orders, "order_payments": pay, "order_items": items}, str(tmp_path), holdout=True)
    assert "product_name_lenght" in open(next((tmp_path / "test_products.csv").glob("part-*"))).readline()
    for infer in (False, True):
        t = TB.load(spark, folder, holdout=True, infer=infer)
        assert set(t) == {"orders", "order_payments", "order_items", "products"}
        assert t["products"].first()["product_name_length"] == 4
        assert t["orders"].first()["order_purchase_timestamp"].year == 2020
    bt = B.basetable(*[TB.load(spark, folder, holdout=True)[n] for n in ("orders", "order_payments", "order_items", "products")])
    row = bt.first()
    assert (row.order_id, row.other_amount, row.delivery_duration_days) == ("o1", 2.5, 0)


def test_array_of_another_length_fails(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), (None,)], "a array<double>")
    assert [tuple(r) for r in C.array_expand(df, "a", 3).collect()] == [(1.0, 2.0, 3.0), (None, None, None)]
    with pytest.raises(Exception, match="array_expand"):
        C.array_expand(df, "a", 2).collect()


def test_time_split_on_text(spark):
    rows = [(f"id-{(i * 7919) % 1000:04x}", f"2020-01-{1 + i % 9:02d} 00:00:00" if i % 10 else None) for i in range(1000)]
    df = spark.createDataFrame(rows, "id string, ts string")
    first, rest = S.split_time_prefix(df, "ts", "id", 0.7)
    want = sorted(rows, key=lambda r: (r[1] is None, r[1] or "", r[0]))
    assert sorted(r.id for r in first.collect()) == sorted(i for i, _ in want[:700])
    assert first.count() + rest.count() == 1000


@pytest.mark.parametrize("ascending,nulls_last", [(True, True), (True, False), (False, True), (False, False)])
def test_running_sums_order_nan_null_and_infinity_as_spark_does(spark, ascending, nulls_last):
    values = [float(i) for i in range(100)] + [float("nan"), None, float("inf"), float("-inf")]
    df = spark.createDataFrame([(v, 1) for v in values], "k double, w int")
    out = prefix.prefix_sums(df, [("k", ascending, nulls_last)], ["w"], buckets=16)
    order = F.col("k").asc_nulls_last() if nulls_last else F.col("k").asc_nulls_first()
    if not ascending:
        order = F.col("k").desc_nulls_last() if nulls_last else F.col("k").desc_nulls_first()
    want = [repr(r.k) for r in df.orderBy(order).collect()]
    assert [repr(r.k) for r in out.orderBy("cum_w").collect()] == want


def test_nan_score_is_the_highest_point(spark):
    df = spark.createDataFrame([(i / 100, int(i % 3 == 0)) for i in range(100)] + [(float("nan"), 1)], "score double, label int")
    top = MT.roc_points(df).orderBy("tpr", "fpr").first()
    assert top.threshold != top.threshold and top.fpr == 0.0 and abs(top.tpr - 1 / 35) < 1e-12


def test_nan_is_not_part_of_a_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)] + [(float("nan"),)] * 3, "x double")
    assert sorted(r.x for r in PR.median_impute(df, ["x"]).collect()) == [1.0, 2.0, 2.0, 2.0, 2.0, 3.0]


def _rows(spark, levels):
    return spark.createDataFrame([(i, float(i % 7), lv, i % 2) for i, lv in enumerate(levels)], "id int, x double, c string, y int")


def test_prepare_keeps_single_levels_and_unseen_levels(spark):
    _, (one,) = PR.prepare(_rows(spark, ["a"] * 10), [], "y", "id", ["x"], ["c"])
    assert PR.feature_names(one) == ["x", "c_index"]
    train, other = _rows(spark, ["a", "b"] * 5), _rows(spark, ["a", "zzz"] * 5)
    with pytest.raises(Exception):
        PR.prepare(train, [other], "y", "id", ["x"], ["c"])[1][1].collect()
    _, (_, kept) = PR.prepare(train, [other], "y", "id", ["x"], ["c"], unseen="keep")
    assert kept.count() == 10


def test_prepare_imputes_the_training_median_on_text_ids(spark):
    train = spark.createDataFrame([(f"a{i}", v, i % 2) for i, v in enumerate([1.0, 2.0, 4.0, None, float("nan")])], "id string, x double, y int")
    other = spark.createDataFrame([("h", None)], "id string, x double")
    _, (_, hold) = PR.prepare(train, [other], "y", "id", ["x"], [])
    assert hold.first().features[0] == 0.5  # median 2 over maximum 4


def test_one_vs_rest_fits_one_model_per_score(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    df = spark.createDataFrame([(i, float(i % 5), float(1 + i % 5)) for i in range(50)], "order_id int, x double, label double")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    model = M.ovr_fit(df, LogisticRegression(maxIter=5))
    assert len(model.models) == 5
    got = M.ovr_scores(model, df)
    assert {r.prediction for r in got.collect()} <= {1.0, 2.0, 3.0, 4.0, 5.0} and got.where("label < 1 OR label > 5").count() == 0


def test_source_columns_of_one_hot_names():
    assert M.source_columns(["status_delivered", "x", "status_canceled", "c_index"], ["x"], ["status", "c"]) == ["status", "x", "c"]


def test_except_all_splits_hot_rows(spark, monkeypatch):
    monkeypatch.setattr(S, "EXCEPT_CHUNK", 3)
    a = spark.createDataFrame([("x", None)] * 10 + [("y", 1)] * 4, "s string, n int")
    b = spark.createDataFrame([("x", None)] * 2 + [("z", 1)], "s string, n int")
    assert sorted(map(repr, S.except_all(a, b).collect())) == sorted(map(repr, a.exceptAll(b).collect()))


def test_no_join_on_a_handful_of_values(spark):
    """With automatic broadcasts off, split points, offsets and medians still need no shuffle of rows on a group key."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"),
                                      (F.col("id") % 2).alias("label"), F.lit("t").alias("split"))
        for out in (prefix.exact_medians(df, ["a", "b"]), MT.roc_points(df, "a", "label", "split"), MT.lift_points(df, "a", "label", "split")):
            assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_cluster_without_shared_folder_is_refused(spark, monkeypatch):
    class Conf:
        def __init__(self, master):
            self.master = master

        def get(self, key, default=None):
            return self.master if key == "spark.master" else default

    class Session:
        def __init__(self, master):
            self.conf = Conf(master)

    for master in ("yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session._local_folder(Session(master))
    assert os.path.isdir(session._local_folder(Session("local[4]")))


def test_memo_notices_changed_files(spark, tmp_path):
    for t in B.SOURCES:
        shutil.copyfile(f"/root/testdata/sf0.001/{t}.parquet", tmp_path / f"{t}.parquet")
    before = B.materialized_basetable(spark, str(tmp_path))
    assert B.materialized_basetable(spark, str(tmp_path)) is before
    n = before.count()
    pq.write_table(pq.read_table("/root/testdata/sf0.001/orders.parquet").slice(0, 500), tmp_path / "orders.parquet")
    assert B.materialized_basetable(spark, str(tmp_path)).count() < n
