"""MLlib's boosted trees, fitted on blocks of binned rows.

``GBTClassifier`` visits every row once for each level, round and class, object by object, and one-vs-rest keeps a copy of
all rows for each class. ``BlockGBTClassifier`` is the same estimator (parameters, candidate thresholds, logistic loss,
variance gain) on rows binned once into persisted blocks of bytes. A level of all classes' trees is one job: each task adds
up counts and gradients of its blocks by node and bin, these are shuffled by node, and one best split a node reaches the
driver. It returns MLlib's own ``GBTClassificationModel``. ``fit_classes`` fits all classes of one-vs-rest in the same jobs.
"""

from __future__ import annotations

import json
import sys
from concurrent.futures import ThreadPoolExecutor
from typing import Any, Sequence

from pyspark import StorageLevel, cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # task functions call each other: workers need not have the package

BLOCK_ROWS = 65_536
WORTH = 1_000_000  # rows times classes from which blocks are quicker than MLlib's own fit (two jobs a level whatever the rows)
HIST_SHARE = 256 * 2 ** 10  # bytes of added-up histograms that one task searches for splits: less is not worth a task
HIST_CELLS = 16_384  # of one joint histogram, so that it stays in a core's cache
LEAF = 255  # a threshold that no bin exceeds: rows of a leaf go left to the last level
FLAT = 1e-12  # share of a node's variance below which a gain is rounding
_BLOCK = "label binary, bins binary, score binary"
_HIST = "cls int, node int, n binary, s binary, sq double"
_SPLIT = "cls int, node int, n double, s double, feature int, bin int, gain double, n_left double, s_left double, sq double"


def thresholds(values: Any, max_bins: int) -> list[Any]:
    """MLlib's candidate thresholds for each column of a sample: the midpoints of neighbouring values, at most
    ``max_bins - 1``, then those at even strides of the rows."""
    import numpy as np
    out = []
    for x in values.T:
        v, n = np.unique(x, return_counts=True)
        mid = (v[:-1] + v[1:]) / 2
        if len(mid) > max_bins - 1:
            stride = len(x) / max_bins
            seen, target, kept = n.cumsum(), stride, []
            for i in range(len(mid)):
                if abs(seen[i] - target) < abs(seen[i + 1] - target):
                    kept.append(i)
                    target += stride
            mid = mid[kept]
        out.append(mid)
    return out


def _pack(cuts: list[Any], classes: Sequence[float], first: Any):
    """Task function: rows ``(label, values)`` to blocks of class numbers, bins column by column and scores 0."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def block(rows):
            y, x = (np.concatenate(v) for v in zip(*rows))
            bins = np.stack([np.searchsorted(c, x[:, f], side="left").astype("u1") for f, c in enumerate(cuts)])
            cls = np.full(len(y), len(classes), "u1")
            for i, c in enumerate(classes):
                cls[y == c] = i
            parts = cls, bins, np.zeros((len(classes), len(y)), "<f8")
            return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in parts], names=["label", "bins", "score"])
        kept, n = [], 0
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            if batch.column(0).null_count or batch.column(1).null_count or len(x) != len(cuts) * len(y) or not np.isfinite(x).all():
                raise ValueError(f"boosted trees need a label and {len(cuts)} finite features a row")
            if first is not None and not np.isin(y, list(first)).all():
                raise ValueError(f"labels must be among {list(first)}")
            kept.append((y, x.reshape(len(y), len(cuts))))
            n += len(y)
            if n >= BLOCK_ROWS:
                yield block(kept)
                kept, n = [], 0
        if n:
            yield block(kept)
    return run


def _blocks(batches, d: int, n_classes: int):
    """``(class numbers, bins by column, scores by class)`` of every block."""
    import numpy as np
    for batch in batches:
        for at in range(batch.num_rows):
            cls, bins, score = (np.frombuffer(batch.column(i)[at].as_buffer(), t) for i, t in enumerate(("u1", "u1", "<f8")))
            yield cls, bins.reshape(d, -1), score.reshape(n_classes, -1)


def _walk(bins: Any, feature: Any, cut: Any, depth: int):
    """The node on level ``depth`` that each row reaches, counted from 0. Trees are heaps: the root is 1."""
    import numpy as np
    n = bins.shape[1]
    flat, row, node = bins.ravel(), np.arange(n), np.ones(n, "i8")
    offset = feature.astype("i8") * n
    for _ in range(depth):
        at = offset.take(node)
        at += row
        right = flat.take(at) > cut.take(node)
        node += node
        node += right
    return node - 2 ** depth


def _gradient(positive: Any, score: Any, round_: int):
    """The target of a round's trees: labels as -1 and 1 first, then the negative gradient of the logistic loss."""
    import numpy as np
    y = positive * 2.0 - 1.0
    return 4.0 * y / (1.0 + np.exp(2.0 * y * score)) if round_ else y


def bundles(widths: Sequence[int], most: int) -> list[list[int]]:
    """Features in groups whose joint bins are at most ``most`` (a wider feature stays alone): one joint histogram is
    counted instead of several, and summing it over the other features gives each one's own."""
    out: list[list[int]] = []
    size: list[int] = []
    for f in sorted(range(len(widths)), key=lambda f: -widths[f]):
        at = next((i for i, z in enumerate(size) if z * widths[f] <= most), None)
        if at is None:
            out.append([f])
            size.append(widths[f])
        else:
            out[at].append(f)
            size[at] *= widths[f]
    return out


def _histograms(trees: Sequence[tuple], opened: Sequence[Any], level: int, round_: int, widths: Sequence[int]):
    """Task function: counts and gradients of a task's rows by open node of the level, feature and bin."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        d, open_ = len(widths), [len(nodes) for nodes in opened]
        groups = bundles(widths, min(65_535, max(64, HIST_CELLS // max(1, max(open_)))))
        size = [int(np.prod([widths[f] for f in g])) for g in groups]
        counts = [[np.zeros(k * w) for w in size] for k in open_]
        sums = [[np.zeros(k * w) for w in size] for k in open_]
        squares = [np.zeros(k) for k in open_]
        slots = []
        for nodes in opened:
            slots.append(np.full(2 ** level, -1, "i8"))
            slots[-1][nodes - 2 ** level] = np.arange(len(nodes))
        for cls, bins, score in _blocks(batches, d, len(trees)):
            joint = []
            for g in groups:
                column = bins[g[0]].astype("u2")
                for f in g[1:]:
                    column *= np.uint16(widths[f])
                    column += bins[f]
                joint.append(column)
            for c, (feature, cut) in enumerate(trees):
                k = open_[c]
                if not k:
                    continue
                slot = slots[c].take(_walk(bins, feature, cut, level))
                keep = np.flatnonzero(slot >= 0) if slot.min() < 0 else None  # rows of finished nodes drop out
                some = (lambda v: v) if keep is None else (lambda v: v.take(keep))
                slot = some(slot)
                g = _gradient(some(cls) == c, some(score[c]), round_)
                squares[c] += np.bincount(slot, g * g, k)
                key = np.empty(len(slot), "i8")
                for i, w in enumerate(size):
                    np.multiply(slot, w, out=key)
                    key += some(joint[i])
                    counts[c][i] += np.bincount(key, minlength=k * w)
                    sums[c][i] += np.bincount(key, g, k * w)

        def rows(hist, k):
            each: list[Any] = [None] * d
            for g, h in zip(groups, hist):
                h = h.reshape([k, *[widths[f] for f in g]])
                for i, f in enumerate(g):
                    each[f] = h.sum(axis=tuple(j + 1 for j in range(len(g)) if j != i))
            return pa.array([v.tobytes() for v in np.concatenate(each, axis=1)], pa.binary())
        for c, k in enumerate(open_):
            if k and squares[c].any():
                yield pa.RecordBatch.from_arrays([pa.array([c] * k, pa.int32()), pa.array(opened[c], pa.int32()), rows(counts[c], k),
                                                  rows(sums[c], k), pa.array(squares[c])], names=["cls", "node", "n", "s", "sq"])
    return run


def _split(n: Any, s: Any, widths: Sequence[int], least: int) -> tuple:
    """``(n, s, feature, bin, gain, n_left, s_left)``: a node's totals and its best split (feature -1: none)."""
    import numpy as np
    total_n, total_s, at = n[:widths[0]].sum(), s[:widths[0]].sum(), 0
    best = (-1, -1, 0.0, 0.0, 0.0)
    for f, w in enumerate(widths):
        left_n, left_s = n[at:at + w].cumsum()[:-1], s[at:at + w].cumsum()[:-1]
        at += w
        right_n, right_s = total_n - left_n, total_s - left_s
        ok = (left_n >= least) & (right_n >= least)
        if ok.any():
            gain = left_s ** 2 / np.maximum(left_n, 1) + right_s ** 2 / np.maximum(right_n, 1)
            gain = np.where(ok, (gain - total_s ** 2 / total_n) / total_n, -np.inf)
            b = int(gain.argmax())
            if gain[b] > best[2]:
                best = (f, b, float(gain[b]), float(left_n[b]), float(left_s[b]))
    return float(total_n), float(total_s), *best


def _best(widths: Sequence[int], least: int):
    """Task function: the histograms of all tasks to one row a node, its totals and best split."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        found: dict = {}
        for batch in batches:
            for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                v = [np.frombuffer(batch.column(j)[i].as_buffer(), "<f8") for j in (2, 3)] + [batch.column(4)[i].as_py()]
                found[key] = [a + b for a, b in zip(found[key], v)] if key in found else v
        if found:
            out = [(*key, *_split(n, s, widths, least), sq) for key, (n, s, sq) in found.items()]
            columns = [c.split() for c in _SPLIT.split(", ")]
            kinds = {"int": pa.int32(), "double": pa.float64()}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds[t]) for v, (_, t) in zip(zip(*out), columns)], names=[c for c, _ in columns])
    return run


def _add_trees(trees: Sequence[tuple], values: Sequence[Any], depth: int, weight: float, d: int):
    """Task function: blocks with the trees' values added to their scores."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            scores = []
            for _, bins, score in _blocks([batch], d, len(trees)):
                step = [weight * values[c].take(_walk(bins, *tree, depth)) for c, tree in enumerate(trees)]
                scores.append((score + np.stack(step)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.binary())], names=["label", "bins", "score"])
    return run


class _Tree:
    """A growing tree as a heap; nodes are numbered from 1, level by level."""

    def __init__(self, depth: int):
        import numpy as np
        size = 2 ** (depth + 1)
        self.depth, self.feature, self.cut = depth, np.zeros(size, "i4"), np.full(size, LEAF, "u1")
        self.value, self.gain, self.stats = np.zeros(size), np.full(size, -1.0), np.full((size, 3), np.nan)

    def last_values(self) -> Any:
        """Values of the last level, leaves above it handed down to where their rows end."""
        value = self.value.copy()
        for i in range(1, 2 ** self.depth):
            if self.cut[i] == LEAF:
                value[2 * i] = value[i]
        return value[2 ** self.depth:]

    def table(self, tree: int, cuts: list[Any]) -> list[tuple]:
        """MLlib's node rows, numbered in preorder."""
        rows: list[Any] = []

        def visit(i: int) -> int:
            at = len(rows)
            rows.append(None)
            n, s, sq = (float(v) for v in self.stats[i])
            inner = self.cut[i] != LEAF
            left, right = (visit(2 * i), visit(2 * i + 1)) if inner else (-1, -1)
            f = int(self.feature[i])
            split = (f, [float(cuts[f][self.cut[i]])], -1) if inner else (-1, [], -1)
            rows[at] = (tree, (at, float(self.value[i]), sq / n - (s / n) ** 2, [n, s, sq], int(n), float(self.gain[i]), left, right, split))
            return at
        visit(1)
        return rows


_NODES = ("treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, "
          "gain double, leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>")


def _model(spark: SparkSession, est: GBTClassifier, trees: Sequence[_Tree], weights: Sequence[float], cuts: list[Any]) -> GBTClassificationModel:
    """MLlib's model of fitted trees, by way of its file format."""
    plain = {p.name: v for p, v in est.extractParamMap().items() if isinstance(v, (bool, int, float, str))}
    about = {"timestamp": 0, "sparkVersion": spark.version, "defaultParamMap": {}}
    tree = [json.dumps({**about, "class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "uid": f"{est.uid}_tree{i}", "paramMap": {}})
            for i in range(len(trees))]
    whole = json.dumps({**about, "class": "org.apache.spark.ml.classification.GBTClassificationModel", "uid": est.uid, "paramMap": plain,
                        "numFeatures": len(cuts), "numTrees": len(trees)})
    path = scratch_path(spark, "boosted-trees")
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(list(zip(range(len(trees)), tree, weights)), "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    nodes = [r for i, t in enumerate(trees) for r in t.table(i, cuts)]
    spark.createDataFrame(nodes, _NODES, verifySchema=False).coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)


def _grow(blocks: DataFrame, trees: Sequence[_Tree], round_: int, widths: Sequence[int], least: int, info: float) -> None:
    """All levels of one tree for each class."""
    import numpy as np
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nodes = [[1] for _ in trees]
    for level in range(trees[0].depth):
        task = _histograms([(t.feature, t.cut) for t in trees], [np.array(sorted(v), "i8") for v in nodes], level, round_, widths)
        tasks = -(-sum(map(len, nodes)) * sum(widths) * 16 // HIST_SHARE)  # a count and a sum a bin
        hist = blocks.mapInArrow(task, _HIST).repartition(max(1, min(parts, tasks)), "cls", "node")
        found = hist.mapInArrow(_best(widths, least), _SPLIT).toArrow().to_pydict()  # one row for each open node
        nodes = [[] for _ in trees]
        for c, i, n, s, f, b, gain, n_left, s_left, sq in zip(*found.values()):
            t = trees[c]
            t.value[i], t.stats[i] = s / n, (n, s, sq)
            if f < 0 or gain <= info or gain <= FLAT * (sq / n):
                continue
            t.feature[i], t.cut[i], t.gain[i] = f, b, gain
            for child, cn, cs in ((2 * i, n_left, s_left), (2 * i + 1, n - n_left, s - s_left)):
                t.value[child], t.stats[child] = cs / cn, (cn, cs, cs * cs if cn == 1 else np.nan)
                if cn >= 2 * least:
                    nodes[c].append(child)
        if not any(nodes):
            break


def fits_on_blocks(est: Any, dataset: DataFrame, n_classes: int = 1) -> bool:
    """Whether ``est`` is a ``BlockGBTClassifier`` whose settings and features blocks support, on rows enough to be worth it;
    others are left to MLlib."""
    if not isinstance(est, BlockGBTClassifier):
        return False
    same = (est.getSubsamplingRate() == 1.0 and est.getFeatureSubsetStrategy() == "all" and est.getMinWeightFractionPerNode() == 0.0
            and not est.isDefined("weightCol") and not est.isDefined("validationIndicatorCol") and est.getMaxBins() <= LEAF and est.getMaxDepth() > 0)
    nominal = dataset.schema[est.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {}).get("nominal", [])
    return same and not nominal and dataset.count() * n_classes >= WORTH


def fit_classes(est: GBTClassifier, dataset: DataFrame, classes: Sequence[float], known: Sequence[float] | None = None) -> list[GBTClassificationModel]:
    """One binary model for each of ``classes`` against all other rows; labels beyond ``known`` are an error."""
    spark, seed = dataset.sparkSession, est.getSeed()
    rows = dataset.select(F.col(est.getLabelCol()).cast("double").alias("y"), vector_to_array(est.getFeaturesCol()).alias("x"))
    n = max(1, rows.count())
    share = max(est.getMaxBins() ** 2, 10_000) / n  # MLlib's sample for the thresholds; every row is binned and counted
    sample = (rows if share >= 1 else rows.sample(False, share, seed)).select("x").toArrow().column(0).combine_chunks()
    cuts = thresholds(sample.flatten().to_numpy(zero_copy_only=False).reshape(len(sample), -1), est.getMaxBins())
    widths = [len(c) + 1 for c in cuts]
    blocks = rows.mapInArrow(_pack(cuts, classes, known), _BLOCK).persist(StorageLevel.MEMORY_AND_DISK)
    fitted: list[list[_Tree]] = []
    weights: list[float] = []
    try:
        for round_ in range(est.getMaxIter()):
            trees = [_Tree(est.getMaxDepth()) for _ in classes]
            _grow(blocks, trees, round_, widths, est.getMinInstancesPerNode(), est.getMinInfoGain())
            fitted.append(trees)
            weights.append(est.getStepSize() if round_ else 1.0)
            if round_ + 1 < est.getMaxIter():
                task = _add_trees([(t.feature, t.cut) for t in trees], [t.last_values() for t in trees], trees[0].depth, weights[-1], len(cuts))
                scored = blocks.mapInArrow(task, _BLOCK).persist(StorageLevel.MEMORY_AND_DISK)
                scored.count()
                blocks.unpersist()
                blocks = scored
    finally:
        blocks.unpersist()
    with ThreadPoolExecutor(max_workers=len(classes)) as pool:
        return list(pool.map(lambda c: est._copyValues(_model(spark, est, [t[c] for t in fitted], weights, cuts)), range(len(classes))))


class BlockGBTClassifier(GBTClassifier):
    """``GBTClassifier`` fitted on blocks; small tables and settings that blocks do not support are left to MLlib."""

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        if not fits_on_blocks(self, dataset):
            return super()._fit(dataset)
        return fit_classes(self, dataset, [1.0], [0.0, 1.0])[0]
