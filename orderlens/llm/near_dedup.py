"""Operator 8: near-duplicate documents by SetSketch registers.

1. Sketch. A document's set of word shingles becomes ``REGISTERS`` SetSketch registers: each
   holds ``floor(1 - log_b(h))``, truncated to 16 bits, of the least of the set's exponentially
   distributed hashes ``h``. Registers of a union are the maxima of the parts' registers, and
   two sets agree in a register with a probability close to their Jaccard similarity.
2. Band. Texts with equal words share one node. Nodes that agree in all registers of a band
   meet in that band's bucket: a pair of similarity 0.8 misses all bands with probability 6e-7.
3. Estimate. Inside a bucket the similarity is estimated by maximum likelihood from how many
   registers are greater, equal or less, jointly with the known set sizes. A pair is dropped
   only when 0.8 or more is e**-12 times as likely as the best estimate.
4. Verify. Families of plausible pairs compare their full shingle sets exactly. Connected
   components of the verified links are the near-duplicate groups.

A bucket or family reaches tasks in blocks of bounded rows and bytes (a pair of blocks per
task), and a task emits a spanning forest of what it finds, never all pairs.

Defined cases: NULL and blank texts have an empty set and are linked with nothing; a text of
fewer words than a shingle is one shingle; equal rows share a component; documents with a
NULL id take part, and a component without any id has a NULL component_id and keeps its
rows; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import materialize
from .common import few_places, small_batches, with_place
from .components import components

BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1  # SetSketch b, a and q + 1
BANDS, ROWS = 36, 5
REGISTERS = BANDS * ROWS
SHINGLE, PERCENT = 4, 80
DOUBT = 12.0  # natural log of the likelihood ratio at which an estimate rules a pair out
BLOCK_NODES, BLOCK_BYTES = 1024, 8 << 20
FEW = 4  # nodes of a bucket whose pairs are estimated together with those of other buckets

_U = np.uint64
_rng = np.random.default_rng(20_231)
_FACTORS = _rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * _U(2) + _U(1)
_PLACES = _rng.integers(0, 1 << 63, 16, dtype=np.uint64) * _U(2) + _U(1)


class _WordIds(dict):
    """64-bit word hashes, remembered within a Python worker up to a fixed number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 17:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_ids = _WordIds()


def words_of(text: str) -> list[bytes]:
    """Lower-cased (A-Z) runs of characters other than ASCII white space."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingles(words: list[bytes], k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; the whole sequence when shorter than ``k``."""
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(_ids.__getitem__, words), np.uint64, len(words))
    width = min(k, len(words))
    n = len(words) - width + 1
    h = np.full(n, width, np.uint64)
    for i in range(width):
        h += ids[i:i + n] * _PLACES[i]
    h ^= h >> _U(30)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return np.unique(h)


def registers(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers (uint16) of a non-empty set of hashes."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        np.minimum(least, (hashes[None, at:at + 1024] * _FACTORS[:, None]).min(axis=1), out=least)
    h = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0 ** 64) / RATE
    return np.clip(np.floor(1 - np.log(h) / np.log(BASE)), 0, TOP).astype("<u2")


@F.pandas_udf(T.StructType().add("n", T.LongType()).add("digest", T.BinaryType()).add("regs", T.BinaryType()))
def _sketch(texts: pd.Series, k: pd.Series) -> pd.DataFrame:
    rows = []
    for text, width in zip(texts, k):
        words = words_of(text) if text else []
        if not words:
            rows.append((0, None, None))
            continue
        s = shingles(words, int(width))
        rows.append((len(s), hashlib.blake2b(b" ".join(words), digest_size=16).digest(), registers(s).tobytes()))
    return pd.DataFrame(rows, columns=["n", "digest", "regs"])


@F.pandas_udf(T.BinaryType())
def _set_bytes(texts: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series([shingles(words_of(t), int(w)).tobytes() for t, w in zip(texts, k)], dtype=object)


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)


def log_likelihood(j: np.ndarray, u: np.ndarray, greater: np.ndarray, less: np.ndarray, equal: np.ndarray) -> np.ndarray:
    """Of similarity ``j`` given register comparisons; ``u`` is the first set's share of both sizes."""
    v = 1 - u
    up, down = _p(u - v * j), _p(v - u * j)
    return greater * np.log(up) + less * np.log(down) + equal * np.log(np.clip(1 - up - down, 1e-12, 1))


def plausible(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, least: float = PERCENT / 100) -> np.ndarray:
    """Which rows of the sketches ``a`` and ``b`` may have similarity ``least`` or more with each other.

    ``a`` may be one row, held against every row of ``b``.
    """
    small, large = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    out = small >= least * large  # no larger similarity is possible otherwise
    at = np.flatnonzero(out)
    if not len(at):
        return out
    a = a if a.ndim == 1 else a[at]
    b = b[at]
    n_a, n_b = np.broadcast_to(n_a, out.shape)[at].astype(np.float64), n_b[at]
    greater, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = b.shape[1] - greater - less
    u = n_a / (n_a + n_b)
    ceiling = np.minimum(u / (1 - u), (1 - u) / u)
    grid = np.linspace(0, 1, 51)[:, None] * ceiling
    best = log_likelihood(grid, u, greater, less, equal)
    high = np.where(grid >= least, best, -np.inf).max(axis=0)
    high = np.maximum(high, log_likelihood(np.minimum(least, ceiling), u, greater, less, equal))
    out[at] = high >= best.max(axis=0) - DOUBT
    return out


def _forest(n: int, rows: np.ndarray, linked) -> list[tuple[int, int]]:
    """Spanning forest over ``n`` items; ``linked(i, unseen)`` tells which unseen items i is linked with."""
    unseen, out = np.ones(n, bool), []
    for start in rows:
        if not unseen[start]:
            continue
        unseen[start] = False
        queue = [int(start)]
        while queue:
            i = queue.pop()
            left = np.flatnonzero(unseen)
            if not len(left):
                return out
            for x in left[linked(i, left)]:
                unseen[x] = False
                out.append((i, int(x)))
                queue.append(int(x))
    return out


Group = tuple[np.ndarray, np.ndarray, list[bytes]]  # node, n and data of distinct nodes


def _groups(batches: Iterable[pd.DataFrame]) -> Iterator[Group]:
    """Consecutive rows with equal (unit, i, j), which may go on over batches; rows arrive sorted by them."""
    held: list[Group] = []
    last = None

    def whole() -> Group:
        node, n = (np.concatenate([h[x] for h in held]) for x in (0, 1))
        node, first = np.unique(node, return_index=True)
        data = [d for h in held for d in h[2]]
        return node, n[first], [data[i] for i in first]

    for b in batches:
        if not len(b):
            continue
        keys = b[["unit", "i", "j"]].to_numpy()
        node, n, data = b["node"].to_numpy(), b["n"].to_numpy(), b["data"].tolist()
        bounds = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(b)]
        for s, e in zip(bounds[:-1], bounds[1:]):
            if held and (keys[s] != last).any():
                yield whole()
                held = []
            held.append((node[s:e], n[s:e], data[s:e]))
            last = keys[s]
    if held:
        yield whole()


def _small_pairs(groups: list[Group]) -> pd.DataFrame:
    """Plausible pairs of many groups of a few nodes at once."""
    node = [(g[0][i], g[0][j]) for g in groups for i in range(len(g[0])) for j in range(i)]
    n = np.array([(g[1][i], g[1][j]) for g in groups for i in range(len(g[0])) for j in range(i)])
    a = np.frombuffer(b"".join(g[2][i] for g in groups for i in range(len(g[0])) for j in range(i)), "<u2").reshape(len(node), -1)
    b = np.frombuffer(b"".join(g[2][j] for g in groups for i in range(len(g[0])) for j in range(i)), "<u2").reshape(len(node), -1)
    return pd.DataFrame(np.array(node)[plausible(a, n[:, 0], b, n[:, 1])], columns=["a", "b"])


def _estimated(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Plausible pairs of each block pair (columns node, n, data = registers): all of them for up
    to ``FEW`` nodes, a spanning forest for more."""
    few: list[Group] = []
    for g in _groups(batches):
        node, n, data = g
        if len(node) < 2:
            continue
        if len(node) <= FEW:
            few.append(g)
            if len(few) == 2048:
                yield _small_pairs(few)
                few = []
            continue
        regs = np.frombuffer(b"".join(data), "<u2").reshape(len(node), -1)
        order = np.argsort(-n, kind="stable")
        pairs = _forest(len(node), order, lambda i, left: plausible(regs[i], n[i], regs[left], n[left]))
        if pairs:
            i, j = np.array(pairs).T
            yield pd.DataFrame({"a": node[i], "b": node[j]})
    if few:
        yield _small_pairs(few)


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Exact pairwise intersection sizes of sorted distinct arrays, by products of 0/1 matrices."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, where, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1
    column = np.cumsum(shared) - 1
    use = shared[where]
    owner, where = owner[use], column[where[use]]
    out = np.zeros((len(sets), len(sets)), np.float64)
    by = np.argsort(where, kind="stable")
    owner, where = owner[by], where[by]
    width = 4096
    for at in range(0, int(shared.sum()), width):
        s, e = np.searchsorted(where, [at, at + width])
        m = np.zeros((len(sets), width), np.float32)
        m[owner[s:e], where[s:e] - at] = 1
        out += m @ m.T  # at most 4096 per product: exact in float32
    return out.astype(np.int64)


def _verified(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spanning forests of the verified links of each block pair (columns node, n, data = shingle hashes)."""
    for node, n, data in _groups(batches):
        if len(node) < 2:
            continue
        sets = [np.frombuffer(x, np.uint64) for x in data]
        if len(sets) == 2:
            both = len(np.intersect1d(*sets, assume_unique=True))
            both = np.array([[0, both], [both, 0]])
        else:
            both = intersections(sets)
        links = 100 * both >= PERCENT * (n[:, None] + n[None, :] - both)
        pairs = _forest(len(node), np.arange(len(node)), lambda i, left: links[i, left])
        if pairs:
            i, j = np.array(pairs).T
            yield pd.DataFrame({"a": node[i], "b": node[j]})


def _in_block_pairs(members: DataFrame) -> DataFrame:
    """(unit, i, j, node, n, data): each unit's rows dealt to pairs of blocks of bounded size.

    ``members`` has unit, node, n, data. A unit that fits one block is one pair (0, 0). The
    blocks of a larger one are its nodes by hash; row counts per unit are bounded by
    rows * blocks, and every two rows meet in some pair.
    """
    size = members.groupBy("unit").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("data")).alias("bytes"))
    size = size.where("rows > 1").select("unit", F.greatest(
        F.ceil(F.col("rows") / BLOCK_NODES), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int").alias("blocks"))
    dealt = members.join(size, "unit").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.withColumn("other", other)
    return dealt.select("unit", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "n", "data")


def _by_unit(rows: DataFrame, task) -> DataFrame:
    dealt = _in_block_pairs(rows).repartition("unit", "i", "j").sortWithinPartitions("unit", "i", "j")
    return dealt.mapInPandas(task, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every document."""
    body = F.col(text).cast("string")
    sketched = docs.select(key, F.md5(F.encode(body, "UTF-8")).alias("raw"), _sketch(body, F.lit(k)).alias("s"))
    with small_batches(docs.sparkSession):
        sketched = materialize(sketched.select(key, "raw", "s.n", "s.digest", "s.regs"), "sketches")

    nodes = sketched.where("n > 0").groupBy("digest", "regs", "n").agg(F.min(key).alias("label"), F.min("raw").alias("raw"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "sketch-nodes")

    bands = F.array(*[F.xxhash64(F.lit(b), F.substring("regs", 2 * ROWS * b + 1, 2 * ROWS)) for b in range(BANDS)])
    met = nodes.select("node", F.explode(bands).alias("unit"))
    shared = met.groupBy("unit").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("unit")
    members = materialize(met.join(shared, "unit"), "band-buckets")

    with_regs = members.join(nodes.select("node", "n", F.col("regs").alias("data")), "node")
    likely = materialize(_by_unit(with_regs.select("unit", "node", "n", "data"), _estimated).distinct(), "plausible-pairs")

    families = materialize(components(likely), "families")
    wanted = families.join(nodes.select("node", "n", "raw"), "node")
    # the texts of the families again: first by a 64-bit hash, so that few texts are shuffled
    hashes = few_places(materialize(wanted.select(F.xxhash64("raw").alias("h")).distinct(), "wanted"))
    texts = docs.select(F.md5(F.encode(body, "UTF-8")).alias("raw"), body.alias("body"))
    texts = texts.withColumn("h", F.xxhash64("raw")).join(hashes, "h", "left_semi")
    texts = texts.groupBy("raw").agg(F.any_value("body").alias("body"))
    sets = texts.select("raw", _set_bytes("body", F.lit(k)).alias("data"))
    with small_batches(docs.sparkSession):
        full = materialize(wanted.join(sets, "raw").select(F.col("component").alias("unit"), "node", "n", "data"), "shingle-sets")
        links = materialize(_by_unit(full, _verified).distinct(), "verified-links")

    found = components(links)
    placed = nodes.select("node", "digest", "label").join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    ids = placed.groupBy("component").agg(F.min("label").alias("component_id"))
    by_digest = placed.join(ids, "component").select("digest", "component_id", F.lit(True).alias("known"))
    out = sketched.select(key, "n", "digest").join(by_digest, "digest", "left")
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col(key))
    return out.select(key, F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col(key).eqNullSafe(component).alias("kept"))


def unique_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = SHINGLE) -> DataFrame:
    """One row of ``docs`` for each near-duplicate group (the least key, NULL last), with all its columns.

    Documents with an empty set are in no group and all stay.
    """
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = with_place(docs, "near-documents", F.col(key).alias("key"), F.col(text).cast("string").alias("text"), doc)
    ranked = rows.select(F.struct(F.col("key").isNull(), "key", "row").alias("rank"), "text")
    gone = near_duplicates(ranked, "rank", "text", k).where(~F.col("kept")).select(F.col("rank.row").alias("row"))
    gone = few_places(materialize(gone, "near-copies"))
    return rows.select("doc", "row").join(gone, "row", "left_anti").select("doc.*")
