"""Shuffle partitions of the basetable grow with its input and the session keeps its settings."""

import pytest
from pyspark.sql import functions as F

from orderlens import session as SE
from orderlens.operators import metrics as MT
from orderlens.plans import basetable as B
from tests.conftest import SF_SMALL

PARTS, SHARE = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def test_partitions_grow_with_the_input_and_settings_return(spark):
    before = spark.conf.get(PARTS), spark.conf.get(SHARE, None)
    for size, wanted in ((0, int(before[0])), (1000 * SE.INPUT_SHARE + 1, 1001)):
        with pytest.raises(ZeroDivisionError), SE.spread(spark, size) as parts:
            assert parts == wanted == int(spark.conf.get(PARTS)) and spark.conf.get(SHARE) == str(SE.TASK_SHARE)
            1 / 0
        assert (spark.conf.get(PARTS), spark.conf.get(SHARE, None)) == before


@pytest.fixture
def unset(spark):
    """A session without a number of shuffle partitions of its own: Spark's default holds."""
    before = spark.conf.get(PARTS)
    spark.conf.unset(PARTS)
    yield int(spark.conf.get(PARTS))
    spark.conf.set(PARTS, before)


def test_a_session_without_settings_has_the_default_of_spark(spark, unset):
    for size, wanted in ((0, unset), (1000 * SE.INPUT_SHARE + 1, 1001)):
        with SE.spread(spark, size) as parts:
            assert parts == wanted == int(spark.conf.get(PARTS))
        assert spark.conf.get(PARTS, None) is None


@pytest.mark.parametrize("key", ["basetable_train", "auc_pr"])
def test_queries_run_in_a_session_without_settings(spark, unset, monkeypatch, key):
    from orderlens.plans.registry import QUERIES
    monkeypatch.setattr(B, "_MATERIALIZED", {})
    assert QUERIES[key](spark, SF_SMALL).count() > 0
    assert spark.conf.get(PARTS, None) is None


def test_the_basetable_is_written_in_more_tasks_for_more_input(spark, monkeypatch):
    seen = {}

    def noted(df, name, **how):
        seen[name] = int(spark.conf.get(PARTS))
        return SE.materialize(df, name, **how)
    monkeypatch.setattr(SE, "INPUT_SHARE", 2000)
    monkeypatch.setattr(B, "materialize", noted)
    monkeypatch.setattr(B, "_MATERIALIZED", {})
    train = B.materialized_basetable(spark, SF_SMALL)
    assert seen["basetable"] > 2 * int(spark.conf.get(PARTS))
    assert train.count() == train.select("order_id").distinct().count() > 0


@pytest.mark.parametrize("kind", ["int", "double"])  # a window normalises floating keys
def test_tasks_of_a_curve_do_not_grow_with_its_scores(spark, monkeypatch, kind):
    df = spark.range(20_000).select((F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1e6).alias("score"),
                                    (F.col("id") % 3 == 0).cast("int").alias("label"), (F.col("id") % 2).cast(kind).alias("part"))
    rows = lambda d: sorted(tuple(r) for r in d.collect())
    how = {"split_col": "part"}
    before = [rows(MT.lift_points(df, **how)), rows(MT.roc_points(df, **how)), rows(MT.auc_roc(df, **how))]
    monkeypatch.setattr(MT, "SCORES_A_TASK", 500)
    sums, counts = MT._cumulative(df, "score", "label", "part")
    assert max(r["count"] for r in sums.groupBy(F.spark_partition_id()).count().collect()) <= 3_000
    assert sums.count() == counts.count()
    assert [rows(MT.lift_points(df, **how)), rows(MT.roc_points(df, **how)), rows(MT.auc_roc(df, **how))] == before
