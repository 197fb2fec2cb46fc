"""Operator 9: a byte-level convolutional quality classifier in numpy.

Input channels per byte: a learned embedding of its value and a flag for "the last bytes
repeat those of a short distance before". Learned filters read 16-byte chunks that start
every 8 bytes, so chunks overlap and cover the whole text. Their rectified responses are
averaged over overlapping 512-byte segments, a hidden layer reads each segment, every hidden
unit is max-pooled over all segments and a logistic unit turns the maxima into one probability.

Fitting reads a bounded sample of labelled rows (``SAMPLE_PER_CLASS`` rows of each class with
the least key hashes, of texts up to ``SAMPLE_BYTES``), never the held-out fold, and runs on
the driver; scoring runs on Spark over every whole text. The score sees the bytes of the text
and nothing else. Seeds are fixed, so reruns agree.

Defined cases: NULL and empty texts score as a text of no bytes; labels that are NULL, repeated
or without a document are fine; without labels of both classes every score is the share of
good labels (0.5 without any); equal texts get equal scores; an empty table gives an empty
result; extra columns are ignored. A NULL doc_id is never held out and never used to learn.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

SAMPLE_PER_CLASS, SAMPLE_BYTES = 1500, 1 << 16
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
STEP, HALF = 8, 32  # bytes between chunk starts; chunks between segment starts
EMBED, FILTERS, HIDDEN = 7, 32, 16
PIECE = 1024  # half segments that scoring holds at once
PORTION = 1 << 18  # bytes of texts that training holds at once
LAGS, RUN = 40, 4  # a byte is flagged when it ends RUN bytes equal to those at most LAGS before


def repeats(codes: np.ndarray) -> np.ndarray:
    """True where the last RUN bytes equal the RUN bytes some 1 to LAGS places earlier."""
    out = np.zeros(len(codes), bool)
    for lag in range(1, min(LAGS, len(codes) - 1) + 1):
        same = codes[lag:] == codes[:-lag]
        if len(same) < RUN:
            break
        run = same[RUN - 1:].copy()
        for i in range(RUN - 1):
            run &= same[i:len(same) - RUN + 1 + i]
        out[lag + RUN - 1:] |= run
    return out


@dataclasses.dataclass
class Text:
    """Padded bytes of one text, their repeat flags and its number of chunks."""

    codes: np.ndarray
    flags: np.ndarray
    chunks: int

    @classmethod
    def of(cls, text: str | None) -> Text:
        raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        blocks = max(1, -(-len(raw) // STEP)) + 1
        codes = np.zeros(blocks * STEP, np.uint8)
        codes[:len(raw)] = raw
        flags = np.zeros(blocks * STEP, bool)
        flags[:len(raw)] = repeats(raw)
        return cls(codes, flags, blocks - 1)

    def pieces(self, halves: int) -> Iterator[Text]:
        """The text in stretches of at most ``halves`` half segments; neighbours share one, so no segment is cut."""
        total = -(-self.chunks // HALF)
        for a in range(0, max(1, total - 1), halves - 1):
            first, last = a * HALF, min((a + halves) * HALF, self.chunks)
            at = slice(first * STEP, (last + 1) * STEP)
            yield Text(self.codes[at], self.flags[at], last - first)


@dataclasses.dataclass
class Model:
    embed: np.ndarray  # 256 x EMBED
    first: np.ndarray  # (STEP * (EMBED + 1)) x FILTERS: the chunk's first half
    second: np.ndarray  # ... and its second half
    shift: np.ndarray  # FILTERS
    hidden: np.ndarray  # FILTERS x HIDDEN
    hidden_shift: np.ndarray
    out: np.ndarray  # HIDDEN
    out_shift: np.ndarray  # 1

    @classmethod
    def start(cls, rng: np.random.Generator) -> Model:
        width = STEP * (EMBED + 1)
        g = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        zeros = lambda n: np.zeros(n, np.float32)
        return cls(g(256, EMBED, scale=0.5), g(width, FILTERS, scale=width ** -0.5), g(width, FILTERS, scale=width ** -0.5),
                   zeros(FILTERS), g(FILTERS, HIDDEN, scale=FILTERS ** -0.5), zeros(HIDDEN),
                   g(HIDDEN, scale=HIDDEN ** -0.5), zeros(1))

    def forward(self, texts: list[Text]) -> tuple[np.ndarray, dict]:
        """Probability of label 1 for each text, and what the backward pass needs."""
        codes = np.concatenate([t.codes for t in texts])
        x = np.empty((len(codes), EMBED + 1), np.float32)
        x[:, :EMBED] = self.embed[codes]
        x[:, EMBED] = np.concatenate([t.flags for t in texts])
        blocks = x.reshape(-1, STEP * (EMBED + 1))
        chunks = np.array([t.chunks for t in texts])
        before = np.concatenate([[0], np.cumsum(chunks + 1)[:-1]])
        halves = -(-chunks // HALF)
        # chunk i of a text is made of its blocks i and i + 1; its last block starts no chunk
        at = np.concatenate([b + np.arange(c) for b, c in zip(before, chunks)])
        acts = np.maximum(((blocks @ self.first)[at] + (blocks @ self.second)[at + 1]) + self.shift, 0)
        starts = np.concatenate([[0], np.cumsum(chunks)[:-1]])
        cut = np.concatenate([s + HALF * np.arange(h) for s, h in zip(starts, halves)])
        n_half = np.diff(np.append(cut, len(acts)))
        sums = np.add.reduceat(acts, cut, axis=0)
        first_half = np.concatenate([[0], np.cumsum(halves)[:-1]])
        segments = np.maximum(halves - 1, 1)
        left = np.concatenate([f + np.arange(s) for f, s in zip(first_half, segments)])
        right = np.minimum(left + 1, np.repeat(first_half + halves - 1, segments))
        alone = (right == left)[:, None]
        weight = (n_half[left] + np.where(alone[:, 0], 0, n_half[right])).astype(np.float32)[:, None]
        seg = (sums[left] + np.where(alone, 0, sums[right])) / weight
        hid = np.maximum(seg @ self.hidden + self.hidden_shift, 0)
        seg_start = np.concatenate([[0], np.cumsum(segments)[:-1]])
        pooled = np.maximum.reduceat(hid, seg_start, axis=0)
        return self.probability(pooled), locals()

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(pooled @ self.out + self.out_shift[0], -30, 30)))

    def score(self, text: Text) -> float:
        """Probability of label 1 of a text of any length, a bounded stretch at a time."""
        pooled = [self.forward([piece])[1]["pooled"] for piece in text.pieces(PIECE)]
        return float(self.probability(np.max(pooled, axis=0))[0])

    def gradients(self, y: np.ndarray, p: np.ndarray, s: dict) -> list[np.ndarray]:
        """Of the mean log loss, in the order of the fields."""
        dz = ((p - y) / len(y)).astype(np.float32)
        d_out, d_out_shift = s["pooled"].T @ dz, dz.sum(keepdims=True)
        owner = np.repeat(np.arange(len(y)), s["segments"])
        top = (s["hid"] == s["pooled"][owner]) & (s["hid"] > 0)
        share = np.add.reduceat(top, s["seg_start"], axis=0, dtype=np.float32)
        d_hid = np.where(top, (dz[:, None] * self.out)[owner] / np.maximum(share, 1)[owner], 0).astype(np.float32)
        d_hidden, d_hidden_shift = s["seg"].T @ d_hid, d_hid.sum(axis=0)
        d_seg = (d_hid @ self.hidden.T) / s["weight"]
        d_sums = np.zeros_like(s["sums"])
        np.add.at(d_sums, s["left"], d_seg)
        np.add.at(d_sums, s["right"], np.where(s["alone"], 0, d_seg))
        d_acts = np.repeat(d_sums, s["n_half"], axis=0) * (s["acts"] > 0)
        at, blocks = s["at"], s["blocks"]
        d_first, d_second = blocks[at].T @ d_acts, blocks[at + 1].T @ d_acts
        d_blocks = np.zeros_like(blocks)
        d_blocks[at] += d_acts @ self.first.T
        d_blocks[at + 1] += d_acts @ self.second.T
        dx = d_blocks.reshape(-1, EMBED + 1)
        d_embed = np.stack([np.bincount(s["codes"], weights=dx[:, j], minlength=256) for j in range(EMBED)], axis=1)
        return [d_embed.astype(np.float32), d_first, d_second, d_acts.sum(axis=0), d_hidden, d_hidden_shift, d_out, d_out_shift]


def portions(rows: np.ndarray, data: list[Text]) -> Iterator[np.ndarray]:
    """``rows`` in runs of at most ``PORTION`` bytes (or one row): what the gradients hold in memory at once."""
    size = np.array([len(data[i].codes) for i in rows])
    start = 0
    for end in range(1, len(rows) + 1):
        if end == len(rows) or size[start:end + 1].sum() > PORTION:
            yield rows[start:end]
            start = end


def train(texts: list[str], labels: list[int], epochs: int = 10, batch: int = 32, rate: float = 4e-3, seed: int = 9) -> Model | float:
    """Adam on the log loss; the share of good labels when only one class is there."""
    y = np.array(labels, np.float32)
    if len(set(labels)) < 2:
        return float(y.mean()) if len(y) else 0.5
    rng = np.random.default_rng(seed)
    data = [Text.of(t) for t in texts]
    model = Model.start(rng)
    fields = [f.name for f in dataclasses.fields(model)]
    m = [np.zeros_like(getattr(model, f)) for f in fields]
    v = [np.zeros_like(getattr(model, f)) for f in fields]
    class_weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    step, steps = 0, epochs * -(-len(data) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            grads = [0.0] * len(fields)
            for part in portions(pick, data):
                p, state = model.forward([data[i] for i in part])
                target = y[part] + (p - y[part]) * (1 - class_weight[part])  # scales each row's gradient by its weight
                share = np.float32(len(part) / len(pick))
                grads = [a + share * g for a, g in zip(grads, model.gradients(target, p, state))]
            step += 1
            now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for f, g, a, b in zip(fields, grads, m, v):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                param = getattr(model, f)
                param -= now * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-7)
    return model


def scores(model: Model | float, texts: pd.Series) -> pd.Series:
    if not isinstance(model, Model):
        return pd.Series(np.full(len(texts), model))
    return pd.Series([model.score(Text.of(t)) for t in texts], dtype="float64")


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % FOLDS == HELD_OUT, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                    label: str = "quality", per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """(key, text, label) of at most ``per_class`` keys of each class outside the held-out fold, chosen by key hash
    among those with a document of allowed length; a repeated document counts once, by its least text."""
    usable = labels.select(key, F.col(label).cast("int").alias("y")).where(
        F.col(key).isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col(key))).distinct()
    order = F.md5(F.col(key).cast("string"))
    rows = docs.select(key, F.col(text).cast("string").alias("t")).where(F.octet_length(F.coalesce("t", F.lit(""))) <= SAMPLE_BYTES)
    there = usable.join(rows.select(key).distinct(), key)
    picks = [there.where(F.col("y") == c).orderBy(order, key).limit(per_class) for c in (0, 1)]
    picked = F.broadcast(picks[0].unionByName(picks[1]))  # at most 2 * per_class rows
    return rows.join(picked, key).groupBy(key, "y").agg(F.min("t").alias("t")).select(key, "t", "y").orderBy(order, key, "t", "y")


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model | float:
    rows = labelled_sample(docs, labels, key, text).collect()
    return train([r["t"] for r in rows], [r["y"] for r in rows])


def scored(docs: DataFrame, model: Model | float, text: str = "text") -> Column:
    """The score column for ``docs``."""
    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return scores(model, texts)

    return score(F.col(text).cast("string"))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) for every document."""
    model = fit(docs, labels, key, text)
    out = docs.select(key, held_out(F.col(key)).alias("held_out"), scored(docs, model, text).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def good_documents(docs: DataFrame, labelled: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that a model fitted on ``labelled`` and ``labels`` accepts, with all their columns."""
    model = fit(labelled, labels, key, text)
    return docs.where(scored(docs, model, text) >= THRESHOLD)
