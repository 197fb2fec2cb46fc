"""Model keys (rows-only for the driver): shapes, domains and invariants at sf0.001."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL

Q = E.queries()


@pytest.fixture(scope="module")
def holdout_n(spark):
    return Q["basetable_holdout"](spark, SF_SMALL).count()


def test_holdout_features_cover_holdout(spark, holdout_n):
    hf = Q["holdout_features"](spark, SF_SMALL)
    rows = hf.collect()
    assert len(rows) == holdout_n
    # Scaled by the train split's maxima, so holdout values may exceed 1; all finite.
    assert all(abs(x) < float("inf") for r in rows for x in r[1:])


def test_leaderboard_and_selection(spark):
    board = Q["model_leaderboard"](spark, SF_SMALL).collect()
    assert len(board) == 6
    assert all(0.0 <= r.areaUnderPR <= 1.0 and 0.0 <= r.areaUnderROC <= 1.0 for r in board)
    best = Q["model_select"](spark, SF_SMALL).first()
    assert best.areaUnderPR == max(r.areaUnderPR for r in board)
    assert best.model in {r.model for r in board}


def test_importances_sum_to_one_and_topk(spark):
    imp = Q["feature_importance"](spark, SF_SMALL)
    assert abs(imp.agg(F.sum("importance")).first()[0] - 1.0) < 1e-9
    top = Q["feature_select_topk"](spark, SF_SMALL).collect()
    assert len(top) <= 10 and all(r.importance > 0.05 for r in top)
    assert [r.importance for r in top] == sorted((r.importance for r in top), reverse=True)


def test_holdout_scores_are_binary(spark, holdout_n):
    s = Q["score_holdout"](spark, SF_SMALL)
    assert s.count() == holdout_n
    assert {r.prediction for r in s.select("prediction").distinct().collect()} <= {0.0, 1.0}


def test_ovr_predictions_in_score_range(spark):
    p = Q["ovr_predict"](spark, SF_SMALL)
    assert {r.prediction for r in p.select("prediction").distinct().collect()} <= {1.0, 2.0, 3.0, 4.0, 5.0}
    assert p.where("label = 0").count() == 0


def test_final_scores_one_row_per_holdout_order(spark, holdout_n):
    f = Q["final_scores"](spark, SF_SMALL)
    assert f.count() == holdout_n == f.select("order_id").distinct().count()


def test_final_fits_that_keep_unreviewed_orders(spark, holdout_n):
    from orderlens.plans import modeling as ML
    p = ML.prepared(spark, SF_SMALL)
    f = Q["final_scores_unreviewed"](spark, SF_SMALL)
    assert f.count() == holdout_n == f.select("order_id").distinct().count()
    assert {r[0] for r in f.select("prediction_multiclass").distinct().collect()} <= {0.0, 1.0, 2.0, 3.0, 4.0, 5.0}
    assert p.every_score.where("label = 0").count() > 0
    assert len(ML.final_ovr(p, True).models) == 6 and len(ML.final_ovr(p).models) == 5


def test_scored_file_chain_counts_every_holdout_order(spark, holdout_n):
    got = {r.review_sentiment: r["count"] for r in Q["scored_file_sentiment"](spark, SF_SMALL).collect()}
    assert sum(got.values()) == holdout_n and set(got) <= {"Positive", "Negative"}


def test_ovr_confusion_adds_up(spark):
    cm = Q["ovr_confusion"](spark, SF_SMALL)
    assert cm.agg(F.sum(sum(F.col(c) for c in cm.columns if c != "label"))).first()[0] == Q["ovr_predict"](spark, SF_SMALL).count()
    assert cm.agg(F.sum("prediction_other")).first()[0] == 0
    m = Q["ovr_metrics"](spark, SF_SMALL).first()
    assert 0 <= m.f1_weighted <= 1 and 0 <= m.accuracy <= 1


def test_selected_and_stratified_refits(spark, holdout_n):
    for key in ("selected_refit", "stratified_refit"):
        r = Q[key](spark, SF_SMALL).first()
        assert 0 <= r.auc_roc <= 1 and 0 <= r.auc_pr <= 1
    assert Q["selected_scores"](spark, SF_SMALL).count() == holdout_n


def test_multiclass_refit_covers_the_stratified_complement(spark, holdout_n):
    from orderlens.plans import modeling as ML
    valid = ML.stratified_parts(ML.prepared(spark, SF_SMALL))[1]
    cm = Q["multi_refit_confusion"](spark, SF_SMALL)
    assert cm.agg(F.sum(sum(F.col(c) for c in cm.columns if c != "label"))).first()[0] == valid.count()
    m = Q["multi_refit_metrics"](spark, SF_SMALL).first()
    assert 0 <= m.f1_weighted <= 1 and 0 <= m.accuracy <= 1
    scores = Q["refit_scores"](spark, SF_SMALL)
    assert scores.count() == holdout_n
    assert {r[0] for r in scores.select("prediction_multiclass").distinct().collect()} <= {1.0, 2.0, 3.0, 4.0, 5.0}


def test_margin_curves_and_permuted_importances(spark):
    roc = Q["svc_roc_points"](spark, SF_SMALL).groupBy("split").agg(F.max("fpr").alias("f"), F.max("tpr").alias("t")).collect()
    assert {r.split for r in roc} == {"train", "validate"} and all(r.f == 1.0 and r.t == 1.0 for r in roc)
    assert Q["svc_lift_points"](spark, SF_SMALL).where("point < 1 OR point > 10 OR population > 1").count() == 0
    areas = Q["ovr_class_areas"](spark, SF_SMALL).collect()
    assert {r["class"] for r in areas} == {1.0, 2.0, 3.0, 4.0, 5.0} and all(0 <= r.auc_roc <= 1 for r in areas)
    from orderlens.plans import modeling as ML
    imp = Q["permutation_importance"](spark, SF_SMALL).collect()
    assert sorted(r.feature for r in imp) == sorted(ML.prepared(spark, SF_SMALL).names) and all(abs(r.importance) <= 1 for r in imp)


def test_model_curves(spark):
    roc = Q["model_roc_points"](spark, SF_SMALL)
    last = roc.groupBy("split").agg(F.max("fpr").alias("f"), F.max("tpr").alias("t")).collect()
    assert {r.split for r in last} == {"train", "validate"} and all(r.f == 1.0 and r.t == 1.0 for r in last)
    lift = Q["model_lift_points"](spark, SF_SMALL)
    assert lift.where("point < 1 OR point > 10 OR population > 1").count() == 0


def test_cross_validation_grid(spark):
    cv = Q["cross_validate"](spark, SF_SMALL).collect()
    assert sorted(r.maxDepth for r in cv) == [4.0, 6.0, 8.0, 10.0, 12.0]
    assert all(0.0 <= r.avg_areaUnderROC <= 1.0 for r in cv)
