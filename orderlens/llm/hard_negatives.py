"""Operator 12: hard negatives of anchor vectors.

Vectors become whole numbers, ``floor(256 * x)``, and the score of two is their inner product.
Anchors and candidates meet in cells of an anchor block and a candidate stripe; a task streams
a cell's candidates past its anchors in tiles and multiplies each tile by Strassen's recursion
(operands padded with zeros, seven products of half the size, whole-number additions). Heaps
of the best ``keep`` entries per anchor, later per anchor and positive, are what a task emits;
heaps of the same anchor merge by keeping the best of their entries, before and after the
shuffle. The first pass finds the positives, the second the negatives in each positive's window.

Every anchor meets every row, so the work grows with their product; it is spread over
(anchor blocks * stripes) tasks, none of which holds more than a block of anchors and a tile.

Defined cases: rows with a NULL label, a NULL vector, or a NULL or non-finite entry take no
part; vectors of unequal length are padded with zeros; a row is never its own positive or
negative, but a copy of it is a row like any other, also with the same key; equal scores go by
the smaller key, NULL keys last, then by the row's place; an empty table, no anchors, or
anchors without positives or negatives give no rows; extra columns are ignored. Scores that
might not fit 60 bits are an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .common import with_place

SCALE = 256
POSITIVES = NEGATIVES = 5
LOW, HIGH = 80, 100  # per cent of the positive's score
ANCHORS = 4096  # anchors in a block
STRIPE = 4096  # candidates in a stripe, if the cluster has cores for as many cells; at most LONGEST of them
LONGEST = 1 << 20
TILE = 512
LEAF = 32  # Strassen's recursion stops at this size of any side
NO_KEY = np.iinfo(np.int64).max

ENTRY = "a_file long, a_at long, slot int, score long, no_key int, key long, file long, at long"
FIELDS = ["slot", "score", "no_key", "key", "file", "at"]


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of int64 matrices, exact as long as the result fits (additions wrap and wrap back)."""
    m, k, n = a.shape[0], a.shape[1], b.shape[0]
    if min(m, k, n) <= LEAF:
        return a @ b.T
    if m % 2 or k % 2 or n % 2:
        a, b = (np.pad(x, [(0, s % 2) for s in x.shape]) for x in (a, b))
        return strassen(a, b)[:m, :n]
    h, i, j = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b21, b12, b22 = b[:j, :i], b[:j, i:], b[j:, :i], b[j:, i:]  # b is transposed
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((m, n), np.int64)
    out[:h, :j] = p1 + p4 - p5 + p7
    out[:h, j:] = p3 + p5
    out[h:, :j] = p2 + p4
    out[h:, j:] = p1 - p2 + p3 + p6
    return out


class Heaps:
    """The best ``keep`` entries of each slot: greatest score first, then least key, NULL keys last, then place."""

    def __init__(self, slots: int, keep: int):
        self.keep = keep
        self.entries = {f: np.empty(0, np.int64) for f in FIELDS}
        # what an entry must reach to get into a full slot
        self.least = np.full(slots, np.iinfo(np.int64).min)
        self.last = np.full(slots, NO_KEY)

    def offer(self, **new: np.ndarray) -> None:
        e = {f: np.concatenate([self.entries[f], new[f]]) for f in FIELDS}
        order = np.lexsort((e["at"], e["file"], e["key"], e["no_key"], -e["score"], e["slot"]))
        slot = e["slot"][order]
        first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.r_[first, len(slot)]))
        kept = order[rank < self.keep]
        self.entries = {f: v[kept] for f, v in e.items()}
        full = order[rank == self.keep - 1]
        self.least[e["slot"][full]] = e["score"][full]
        self.last[e["slot"][full]] = e["key"][full]

    def merge_tile(self, scores: np.ndarray, allowed: np.ndarray, slots: np.ndarray, rows: dict[str, np.ndarray]) -> None:
        """Offers the ``allowed`` entries of a tile; ``slots`` has one slot per row of it, ``rows`` describes its columns."""
        least, last = self.least[slots][:, None], self.last[slots][:, None]
        i, j = np.nonzero(allowed & ((scores > least) | (scores == least) & (rows["key"] <= last)))
        if len(i):
            self.offer(slot=slots[i], score=scores[i, j], **{f: rows[f][j] for f in ("no_key", "key", "file", "at")})


def _matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """Scaled whole numbers, one row a vector, padded with zeros to the longest and to ``width``."""
    lengths = np.asarray(column.value_lengths())
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    if len(flat) and abs(flat).max() >= 2.0 ** 62:
        raise ValueError("embeddings too large: inner products would not fit a long")
    width = max(width, int(lengths.max(initial=0)))
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat.astype(np.int64)
    return out


def _rows(b: pa.RecordBatch) -> dict[str, np.ndarray]:
    key = b.column("key")
    return {"key": key.fill_null(NO_KEY).to_numpy(zero_copy_only=False),
            "no_key": key.is_null().to_numpy(zero_copy_only=False).astype(np.int64),
            **{f: b.column(f).to_numpy(zero_copy_only=False) for f in ("file", "at", "label")}}


class _Cell:
    """One anchor block and the candidates that stream past it."""

    def __init__(self, keep: int, low: int, high: int, second: bool):
        self.keep, self.low, self.high, self.second = keep, low, high, second
        self.batches: list[pa.RecordBatch] = []
        self.ready = False

    def anchors(self, b: pa.RecordBatch) -> None:
        self.batches.append(b)

    def _open(self) -> None:
        b = pa.Table.from_batches(self.batches).combine_chunks().to_batches()[0]
        self.vectors, self.info = _matrix(b.column("vec")), _rows(b)
        self.place = {p: i for i, p in enumerate(zip(self.info["file"].tolist(), self.info["at"].tolist()))}
        if self.second:
            windows = b.column("windows").to_pylist()
            self.width = max(len(w) for w in windows)
            top = np.array([[w[k] if k < len(w) else 0 for k in range(self.width)] for w in windows], np.int64)
            there = np.array([[k < len(w) for k in range(self.width)] for w in windows])
            # least <= score <= most of each window; an unused one takes none
            self.least = np.where(there, -(-self.low * top // 100), 1)
            self.most = np.where(there, self.high * top // 100, 0)
        else:
            self.width = 1
        self.heaps = Heaps(len(self.vectors) * self.width, self.keep)
        self.ready = True

    def candidates(self, b: pa.RecordBatch) -> None:
        if not self.batches:
            return
        if not self.ready:
            self._open()
        for at in range(0, b.num_rows, TILE):
            self._tile(b.slice(at, TILE))

    def _tile(self, b: pa.RecordBatch) -> None:
        rows = _rows(b)
        c = _matrix(b.column("vec"), self.vectors.shape[1])
        if c.shape[1] > self.vectors.shape[1]:
            self.vectors = np.pad(self.vectors, [(0, 0), (0, c.shape[1] - self.vectors.shape[1])])
        if float(abs(c).max(initial=0)) * float(abs(self.vectors).max(initial=0)) * c.shape[1] >= 2.0 ** 60 / 100:
            raise ValueError("embeddings too large: inner products would not fit a long")
        itself = [(i, j) for j, p in enumerate(zip(rows["file"].tolist(), rows["at"].tolist())) if (i := self.place.get(p)) is not None]
        for start in range(0, len(self.vectors), TILE):
            a = slice(start, start + TILE)
            scores = strassen(self.vectors[a], c)
            same = self.info["label"][a][:, None] == rows["label"]
            index = np.arange(start, start + len(scores))
            if not self.second:
                for i, j in itself:
                    if start <= i < start + len(scores):
                        same[i - start, j] = False
                self.heaps.merge_tile(scores, same, index, rows)
                continue
            for w in range(self.width):
                inside = ~same & (scores >= self.least[a, w][:, None]) & (scores <= self.most[a, w][:, None])
                self.heaps.merge_tile(scores, inside, index * self.width + w, rows)

    def result(self) -> pa.RecordBatch | None:
        if not self.ready or not len(self.heaps.entries["slot"]):
            return None
        e = self.heaps.entries
        anchor, slot = e["slot"] // self.width, e["slot"] % self.width
        key = pa.array(e["key"], mask=e["no_key"] > 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.info["file"][anchor]), pa.array(self.info["at"][anchor]), pa.array(slot.astype(np.int32)), pa.array(e["score"]),
             pa.array(e["no_key"].astype(np.int32)), key, pa.array(e["file"]), pa.array(e["at"])],
            [f.split()[0] for f in ENTRY.split(", ")])


def _task(keep: int, low: int, high: int, second: bool):
    """Over rows sorted by (cell, kind): anchors (kind 0) open a cell, candidates (kind 1) stream past them."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, None
        for b in batches:
            if not b.num_rows:
                continue
            at, kind = (b.column(c).to_numpy() for c in ("cell", "kind"))
            cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]) | (kind[1:] != kind[:-1])) + 1), b.num_rows]
            for s, e in zip(cuts[:-1], cuts[1:]):
                if at[s] != cell:
                    if held and (out := held.result()):
                        yield out
                    cell, held = at[s], _Cell(keep, low, high, second)
                (held.candidates if kind[s] else held.anchors)(b.slice(s, e - s))
        if held and (out := held.result()):
            yield out

    return run


def _best(entries: DataFrame, keep: int) -> DataFrame:
    """The merged heaps: ``rank`` 1 .. keep of each anchor and slot. Spark keeps the best of each task before the shuffle."""
    order = Window.partitionBy("a_file", "a_at", "slot").orderBy(F.desc("score"), "no_key", "key", "file", "at")
    return entries.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def mine(vectors: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` tells which rows are anchors (NULL: not), ``label`` is a column of whole numbers.
    For each of an anchor's first ``positives`` rows of its label, the first ``negatives`` rows of other labels whose
    score is between ``low`` and ``high`` per cent of the positive's.
    """
    spark = vectors.sparkSession
    own = F.col(label) if isinstance(label, str) else label
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))
    rows = with_place(vectors, "vectors", F.col(key).cast("long").alias("key"), own.cast("long").alias("label"),
                      F.col(vector).alias("vec"), F.coalesce(anchors, F.lit(False)).alias("is_anchor"))
    rows = rows.where(F.col("label").isNotNull() & F.col("vec").isNotNull() & F.forall("vec", finite))
    rows = rows.select("key", "label", "vec", "is_anchor", "row.file", "row.at")

    size = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if("is_anchor").alias("anchors")).first()
    blocks = max(1, -(-size["anchors"] // ANCHORS))
    cores = spark.sparkContext.defaultParallelism
    stripes = max(1, -(-size["rows"] // LONGEST), min(-(-size["rows"] // STRIPE), -(-4 * cores // blocks)))

    def met(anchor_rows: DataFrame, second: bool) -> DataFrame:
        """Every anchor block with every stripe, in one partition each."""
        hashed = lambda n: F.pmod(F.xxhash64("file", "at"), F.lit(n))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        left = anchor_rows.withColumn("stripe", every(stripes)).withColumn("block", hashed(blocks)).withColumn("kind", F.lit(0))
        right = rows.withColumn("stripe", hashed(stripes)).withColumn("block", every(blocks)).withColumn("kind", F.lit(1))
        right = right.withColumn("windows", F.lit(None).cast("array<long>"))
        cols = ["key", "label", "vec", "file", "at", "windows", "kind", (F.col("block") * stripes + F.col("stripe")).cast("int").alias("cell")]
        dealt = left.select(*cols).unionByName(right.select(*cols)).repartitionById(blocks * stripes, F.col("cell"))
        found = dealt.sortWithinPartitions("cell", "kind").mapInArrow(
            _task(negatives if second else positives, low, high, second), ENTRY)
        return _best(found, negatives if second else positives)

    chosen = rows.where("is_anchor")
    near = materialize(met(chosen.withColumn("windows", F.lit(None).cast("array<long>")), False).select(
        "a_file", "a_at", (F.col("rank") - 1).alias("slot"), "score", F.col("key").alias("positive_id")), "positives")
    tops = near.groupBy(F.col("a_file").alias("file"), F.col("a_at").alias("at")).agg(  # at most ``positives`` scores of an anchor
        F.transform(F.sort_array(F.collect_list(F.struct("slot", "score"))), lambda x: x["score"]).alias("windows"))
    hard = met(chosen.join(tops, ["file", "at"]), True).select(
        "a_file", "a_at", "slot", "rank", F.col("key").alias("negative_id"), F.col("score").alias("negative_score"))
    named = near.join(chosen.select(F.col("file").alias("a_file"), F.col("at").alias("a_at"), F.col("key").alias("anchor_id")), ["a_file", "a_at"])
    return hard.join(named, ["a_file", "a_at", "slot"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score")


SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, CAST(list_inner_product(a.e, v.e) AS BIGINT) AS score
    FROM v AS a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
WHERE 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 5
"""
