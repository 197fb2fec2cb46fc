"""Operators 11 and 12 against plain Python versions."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import hard_negatives, whitening
from orderlens.llm.common import table
from orderlens.session import materialize

from .conftest import SF

VECTORS = "vec_id long, embedding array<float>, label int"


def valid(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def whole(x, scale):
    return math.floor(scale * float(np.float32(x)))


# ---- operator 11 ----

def exact_covariance(rows):
    x = [[whole(c, 1024) + 100_000 for c in r] for r in rows]
    n, d = len(x), len(x[0])
    mean = [Fraction(sum(r[i] for r in x), n) for i in range(d)]
    z = [[r[i] - mean[i] for i in range(d)] for r in x]
    return x, [[float(sum(r[i] * r[j] for r in z) / n) for j in range(d)] for i in range(d)]


def check_whitening(rows, out, components):
    """``rows``: (vec_id, vector) of the usable rows; ``out``: collected result."""
    x, cov = exact_covariance([v for _, v in rows])
    n, total = len(x), [sum(c) for c in zip(*x)]
    values, basis = np.linalg.eigh(np.array(cov))
    values, basis = values[::-1], basis[:, ::-1]
    assert len(out) == n * components
    by = {}
    for r in out:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    for (vec_id, _), ints in zip(rows, x):
        deviation = sum((n * a - s) ** 2 for a, s in zip(ints, total))
        for k in range(components):
            r = by[vec_id][k + 1]
            assert r["n"] == n and r["deviation"] == deviation == int(r["deviation_exact"])
            want = sum((a - s / n) * b for a, s, b in zip(ints, total, basis[:, k])) / math.sqrt(values[k])
            assert abs(abs(r["whitened"]) - abs(want)) < 1e-6
            assert r["explained"] == pytest.approx(values[k] / sum(values), rel=1e-9)
            assert r["identity_error"] < 1e-6


def test_whitening_of_the_given_table(spark):
    docs = table(spark, SF, "embeddings", "vec_id", "embedding")
    rows = [(r["vec_id"], r["embedding"]) for r in docs.collect() if valid(r["embedding"])]
    check_whitening(rows, whitening.whiten(docs).collect(), 8)


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = [(i, [float(np.float32(x)) for x in rng.normal(size=3) * [5, 1, 0.2]]) for i in range(40)]
    odd = [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan"), 0.0, 0.0]), (103, [float("inf"), 0.0, 0.0]),
           (104, []), (105, [1.0, 2.0]), (106, [3e38, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in good + odd], "vec_id long, embedding array<float>, n string, whitened string")
    check_whitening(good, whitening.whiten(df.repartition(5)).collect(), 3)


def test_whitening_keeps_repeated_and_null_keys(spark):
    rows = [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [1.0, 0.5]), (2, [2.0, -1.0])]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in out) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (2, 1), (2, 2)]


def test_whitening_without_variance_or_rows(spark):
    schema = "vec_id long, embedding array<float>"
    same = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect()
    assert {(r["whitened"], r["explained"], r["identity_error"], r["deviation"]) for r in same} == {(None, 0.0, 0.0, 0)}
    for rows in ([], [(1, None)]):
        empty = whitening.whiten(spark.createDataFrame(rows, schema))
        assert empty.count() == 0 and empty.columns[:7] == [
            "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_whitening_stays_exact_beyond_64_bits(spark):
    big = [(i, [float(x) for x in v]) for i, v in enumerate(np.random.default_rng(3).integers(-2 ** 40, 2 ** 40, (30, 2)))]
    out = whitening.whiten(spark.createDataFrame(big, "vec_id long, embedding array<double>")).collect()
    x = [[1024 * int(c) + 100_000 for c in v] for _, v in big]
    total = [sum(c) for c in zip(*x)]
    want = {i: sum((30 * a - s) ** 2 for a, s in zip(v, total)) for i, v in enumerate(x)}
    assert all(int(r["deviation_exact"]) == want[r["vec_id"]] and r["deviation"] is None for r in out)
    assert out[0]["identity_error"] < 1e-6


# ---- operator 12 ----

def brute_negatives(rows, is_anchor):
    """``rows``: (place, vec_id, label, vector) of all rows."""
    rows = [(p, i, l, [whole(x, 256) for x in v]) for p, i, l, v in rows if l is not None and valid(v)]
    order = lambda s, c: (-s, c[1] is None, c[1] or 0, c[0])
    out = []
    for a in rows:
        if not is_anchor(a[1]):
            continue
        scored = sorted(((sum(x * y for x, y in zip(a[3], c[3])), c) for c in rows if c[0] != a[0]), key=lambda t: order(*t))
        for ps, p in [t for t in scored if t[1][2] == a[2]][:5]:
            window = [t for t in scored if t[1][2] != a[2] and 80 * ps <= 100 * t[0] <= 100 * ps][:5]
            out += [(a[1], p[1], k + 1, c[1], ps, s) for k, (s, c) in enumerate(window)]
    return sorted(out, key=repr)


def mined(df, step=3):
    out = hard_negatives.mine(df, F.col("vec_id") % step == 0)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("block", [4096, 16])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, block):
    """Ties, copies, NULLs and a label that a third of the rows share; also with many blocks and stripes."""
    for name in ("ANCHORS", "STRIPE", "TILE"):
        monkeypatch.setattr(hard_negatives, name, block)
    rng = np.random.default_rng(5)
    rows = []
    for i in range(240):
        v = [float(x) for x in rng.integers(-3, 4, 6) / 2 + [2, 0, 0, 0, 0, 0]]
        rows.append((i, v, 0 if i % 3 == 0 else int(rng.integers(0, 4))))
    rows += [(i, [2.0, 0.5, 0.5, 0.0, 0.0, 0.0], i % 4) for i in range(300, 340)]  # one very common vector
    rows += [(None, [2.0] * 6, 1), (3, [2.0] * 6, 0), (3, [2.0] * 6, 0), (400, None, 1), (401, [1.0, None], 1),
             (402, [float("nan")] * 6, 2), (403, [1.0] * 6, None), (404, [2.0, 1.0], 2), (405, [], 3)]
    df = materialize(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("score", F.lit("x"))
                     .repartition(4), "test-vectors")
    placed = df.select("vec_id", "label", "embedding", F.xxhash64("_metadata.file_path").alias("f"), "_metadata.row_index").collect()
    brute = brute_negatives([((r["f"], r["row_index"]), r["vec_id"], r["label"], r["embedding"]) for r in placed],
                            lambda i: i is not None and i % 3 == 0)
    assert len(brute) > 500
    assert mined(df) == brute


def test_hard_negatives_of_nothing(spark):
    assert mined(spark.createDataFrame([], VECTORS)) == []
    assert mined(spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 2)], VECTORS)) == []  # no anchors
    assert mined(spark.createDataFrame([(3, [1.0], 1), (4, [1.0], 2)], VECTORS)) == []  # no positive
    assert mined(spark.createDataFrame([(3, [1.0], 1), (4, [1.0], 1)], VECTORS)) == []  # no negative


def test_hard_negatives_refuse_scores_that_do_not_fit(spark):
    with pytest.raises(Exception, match="would not fit a long"):
        mined(spark.createDataFrame([(3, [1e12], 1), (4, [1e12], 1)], "vec_id long, embedding array<double>, label int"))


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 64, 47), (100, 65, 129), (128, 70, 33), (512, 64, 300), (40, 0, 40)])
def test_strassen_is_exact(shape):
    m, k, n = shape
    rng = np.random.default_rng(7)
    a, b = rng.integers(-2 ** 27, 2 ** 27, (m, k)), rng.integers(-2 ** 27, 2 ** 27, (n, k))
    assert (hard_negatives.strassen(a, b) == a @ b.T).all()


def test_no_candidate_is_sent_more_often_than_there_are_anchor_blocks(spark):
    plan = hard_negatives.mine(table(spark, SF, "embeddings"), F.col("vec_id") % 100 == 0)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
