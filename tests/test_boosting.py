"""Boosted trees fitted on blocks: the same models as MLlib, all classes of one-vs-rest in the same jobs."""

import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, OneVsRest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from orderlens.operators import boosting as BO
from orderlens.operators import models as MO
from orderlens.plans import modeling as ML


@pytest.fixture(autouse=True)
def small_tables_too(monkeypatch):
    monkeypatch.setattr(BO, "WORTH", 0)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.normal(size=900), rng.integers(0, 5, 900), rng.integers(0, 2, 900), np.zeros(900)])
    y = 1 + np.clip(np.round(x[:, 0] + x[:, 1] * x[:, 2] / 2 + rng.normal(size=900) / 2 + 1), 0, 3)
    df = spark.createDataFrame([(i, float(a), [float(u) for u in b]) for i, (a, b) in enumerate(zip(y, x))],
                               "order_id long, label double, x array<double>")
    return df.select("order_id", "label", array_to_vector("x").alias("features")).repartition(3).cache()


def margins(model, df):
    out = model.transform(df).select("order_id", vector_to_array("rawPrediction")[1].alias("m"))
    return np.array([r["m"] for r in out.orderBy("order_id").collect()])


def test_blocks_give_mllibs_trees(spark, rows, monkeypatch):
    monkeypatch.setattr(BO, "BLOCK_ROWS", 100)
    binary = rows.withColumn("label", (F.col("label") > 2).cast("double"))
    how = {"seed": 5, "maxDepth": 3, "maxIter": 4}
    want, got = GBTClassifier(**how).fit(binary), BO.BlockGBTClassifier(**how).fit(binary)
    assert isinstance(got, GBTClassificationModel) and got.getNumTrees == 4 and got.numFeatures == 4 and got.getMaxDepth() == 3
    assert np.allclose(margins(got, binary), margins(want, binary), atol=1e-12)
    assert np.allclose(got.featureImportances.toArray(), want.featureImportances.toArray(), atol=1e-12)
    assert {r["prediction"] for r in got.transform(binary).collect()} <= {0.0, 1.0}


def test_all_classes_are_fitted_in_the_same_jobs(spark, rows, monkeypatch):
    """One-vs-rest does not fit the classes one by one, each on a copy of all rows."""
    est = BO.BlockGBTClassifier(seed=5, maxDepth=2, maxIter=2)
    want = OneVsRest(classifier=GBTClassifier(seed=5, maxDepth=2, maxIter=2)).fit(MO.zero_based(rows))
    monkeypatch.setattr(BO.BlockGBTClassifier, "_fit", lambda *a: pytest.fail("a class was fitted on its own"))
    got = MO.ovr_fit(rows, est)
    assert len(got.models) == 4
    for a, b in zip(want.models, got.models):
        assert np.allclose(margins(a, rows), margins(b, rows), atol=1e-12)
    scored = MO.ovr_scores(got, rows).collect()
    plain = {r["order_id"]: r["prediction"] + 1 for r in want.transform(MO.zero_based(rows)).collect()}
    assert {r["order_id"]: r["prediction"] for r in scored} == plain


def test_one_vs_rest_scores_without_row_functions(rows):
    model = OneVsRest(classifier=LogisticRegression()).fit(MO.zero_based(rows))
    want, got = model.transform(rows), MO.ovr_transform(model, rows)
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    pick = lambda d: {r["order_id"]: (r["prediction"], *r["rawPrediction"].toArray().round(12)) for r in d.collect()}
    assert pick(got) == pick(want)


def test_final_models_are_fitted_on_blocks():
    assert isinstance(ML.final_gbt(), BO.BlockGBTClassifier)


def test_joint_histograms_keep_every_feature():
    widths = [32, 2, 5, 1, 32, 2]
    for most in (1, 64, 4096):
        groups = BO.bundles(widths, most)
        assert sorted(f for g in groups for f in g) == list(range(6))
        assert all(len(g) == 1 or np.prod([widths[f] for f in g]) <= most for g in groups)


def test_odd_rows_are_refused_and_other_settings_left_to_mllib(spark, rows, monkeypatch):
    bad = rows.withColumn("label", F.lit(3.0))
    with pytest.raises(Exception, match="labels must be among"):
        BO.BlockGBTClassifier(maxIter=1).fit(bad)
    assert not BO.fits_on_blocks(BO.BlockGBTClassifier(subsamplingRate=0.5), rows)
    assert not BO.fits_on_blocks(BO.BlockGBTClassifier(maxBins=300), rows)
    assert not BO.fits_on_blocks(GBTClassifier(), rows)
    monkeypatch.setattr(BO, "WORTH", 901)
    assert not BO.fits_on_blocks(BO.BlockGBTClassifier(), rows) and BO.fits_on_blocks(BO.BlockGBTClassifier(), rows, 5)


def test_rows_of_one_label_end_at_the_root(rows):
    same = rows.withColumn("label", F.lit(1.0))
    model = BO.BlockGBTClassifier(maxIter=2, maxDepth=3).fit(same)
    assert [t.numNodes for t in model.trees] == [1, 1] and (margins(model, same) > 1).all()


def test_workers_need_not_have_the_package(tmp_path):
    """Workers do not share the driver's ``sys.path``: task functions bring what they call."""
    tree, widths = (np.zeros(4, "i4"), np.full(4, BO.LEAF, "u1")), [2, 3]
    tasks = {"pack": BO._pack([np.array([0.5]), np.array([1.0, 2.0])], [1.0], [0.0, 1.0]),
             "histograms": BO._histograms([tree], [np.array([1])], 0, 0, widths), "best": BO._best(widths, 1),
             "add": BO._add_trees([tree], [np.array([0.25, 0.5])], 1, 0.5, 2)}
    (tmp_path / "tasks").write_bytes(cloudpickle.dumps(tasks))
    worker = """
import sys, pyarrow as pa
from pyspark import cloudpickle
tasks = cloudpickle.loads(open(sys.argv[1], "rb").read())
rows = pa.RecordBatch.from_arrays([pa.array([1.0, 0.0, 1.0]), pa.array([[0.0, 1.5], [1.0, 3.0], [0.0, 1.0]])], names=["y", "x"])
blocks = list(tasks["pack"]([rows]))
n = tasks["best"](tasks["histograms"](blocks))
print([b.num_rows for b in tasks["add"](blocks)], next(n).column("n").to_pylist(), "orderlens" in sys.modules)
"""
    done = subprocess.run([sys.executable, "-I", "-c", worker, str(tmp_path / "tasks")], cwd="/", capture_output=True, text=True, timeout=120)
    assert done.stdout.strip() == "[1] [3.0] False", done.stderr
