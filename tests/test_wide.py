"""Correlation of many columns by blocks, and the basetable chain over bucketed tables."""

import math

import numpy as np
import pandas as pd
import pytest

from conftest import SF_SMALL
from orderlens import session
from orderlens.operators import metrics as MT
from orderlens.plans import basetable as B


def matrix(df):
    return {(r.row, r.col): r.r for r in df.collect()}


def plan_after_run(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def wide():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 200)) @ rng.normal(size=(200, 200)) + 1e6
    x[rng.random(x.shape) < 0.1] = np.nan
    return pd.DataFrame(x, columns=[f"v{i}" for i in range(200)])


def test_two_hundred_columns_equal_pandas(spark, wide):
    rows = [tuple(None if math.isnan(v) else float(v) for v in r) for r in wide.itertuples(index=False)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in wide.columns)).repartition(7)
    got, exp = matrix(MT.corr_wide(df, list(wide.columns))), wide.corr()
    assert len(got) == 200 * 200
    assert max(abs(got[a, b] - exp.loc[a, b]) for a in wide for b in wide) < 1e-9


def test_block_size_does_not_change_the_result(spark, wide):
    cols = list(wide.columns[:10])
    df = spark.createDataFrame(wide[cols].fillna(0.0))
    base = matrix(MT.corr_matrix(df, cols))
    for block in (1, 3, 10, 64):
        got = matrix(MT.corr_wide(df, cols, block=block))
        assert got.keys() == base.keys() and all(abs(got[k] - base[k]) < 1e-9 for k in base)


def test_defined_cases(spark):
    rows = [(1.0, 5.0, None, 1.0, 2), (2.0, 5.0, None, float("nan"), 4), (4.0, 5.0, 3.0, 2.0, None), (None, 5.0, 1.0, 3.0, 9)]
    df = spark.createDataFrame(rows, "a double, same double, few double, odd double, whole int")
    got = matrix(MT.corr_wide(df, df.columns))
    assert got["a", "same"] is None and got["same", "a"] is None  # constant
    assert got["a", "few"] is None                                # one common row
    assert math.isnan(got["a", "odd"])                            # NaN on a common row
    assert got["few", "odd"] == pytest.approx(-1.0)               # the NaN row is not common
    assert got["a", "whole"] == pytest.approx(1.0)
    assert all(got[c, c] == 1.0 for c in df.columns)


def test_empty_and_all_null(spark):
    empty = spark.createDataFrame([], "a double, b double")
    assert matrix(MT.corr_wide(empty, ["a", "b"])) == {("a", "a"): 1.0, ("b", "b"): 1.0, ("a", "b"): None, ("b", "a"): None}
    nulls = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    assert matrix(MT.corr_wide(nulls, ["a", "b"]))["a", "b"] is None
    assert MT.corr_wide(empty, []).count() == 0


def test_bucketed_chain_plans_no_exchange_and_gives_the_same_rows(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    grain = B.both_sides_grain(spark, SF_SMALL)
    tables = B.bucketed(grain, 4)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        chain = B.joined(tables)
        plan = plan_after_run(chain)
        assert "Exchange" not in plan and plan.count("SortMergeJoin") >= 3
        assert "Exchange" in plan_after_run(B.joined(grain))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    plain = B.joined(grain)
    assert chain.columns == plain.columns
    keys = ["order_id", "sample", "status", "repeat_customer", "payment_methods", "review_score", "in_top_20"]
    a, b = (sorted(map(str, x.select(*keys).collect())) for x in (chain, plain))
    assert a == b


def test_bucketed_table_keeps_null_and_repeated_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (5, 3), (5, 3), (7, 4)], "order_id long, v int")
    back = session.materialize_bucketed(df, "Odd name!", "order_id", 3)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert "Exchange" not in plan_after_run(back.groupBy("order_id").count())
    none = session.materialize_bucketed(df.where("v > 9"), "none", "order_id", 3)
    assert none.count() == 0 and none.schema == df.schema
