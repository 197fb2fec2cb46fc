"""Exact ranks by bracketed selection: medians and the point of a time split.

A mergeable quantile sketch (``percentile_approx``, bounded memory) brackets the wanted ranks,
one counting pass tells how many values lie below the bracket and up to its end, and only the
values inside it move: about ``4 / ACCURACY`` of them. Brackets with more than ``FEW`` values
are bracketed again. Every side of a bracket is counted before it is believed, so a sketch
that misses costs a round and never a wrong value.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000  # of the sketch: its rank error is at most a 10,000th of the rows
MARGIN = 2.0 / ACCURACY  # added to both sides of a wanted rank's share
FEW = 100_000  # values that a bracket may keep without another round
MAX_ROUNDS = 20


@dataclasses.dataclass
class Bracket:
    """Ranks ``first`` .. ``last`` of ``n`` values lie in ``low`` .. ``high``: ``below`` values are less
    than ``low``, ``upto`` are at most ``high``."""

    n: int
    first: int
    last: int
    low: float = -math.inf
    high: float = math.inf
    below: int = 0
    upto: int = 0

    @property
    def inside(self) -> int:
        return self.upto - self.below

    @property
    def open(self) -> bool:
        return self.inside > FEW and self.low < self.high

    def shares(self) -> list[float]:
        """The ranks as shares of the values inside, widened by ``MARGIN``."""
        return [max(0.0, (self.first - self.below) / self.inside - MARGIN), min(1.0, (self.last - self.below) / self.inside + MARGIN)]


def _sketch(value: Column, shares: Sequence[float]) -> Column:
    return F.percentile_approx(value, [float(s) for s in shares], ACCURACY)


def brackets(df: DataFrame, values: dict[str, Column], share: float, ranks: Callable[[int], tuple[int, int]]) -> dict[str, Bracket]:
    """A bracket for each double column of ``values`` (its NULLs do not count) around ``ranks(n)``, which lie
    near ``share`` of its ``n`` values. Columns without values, or whose ranks begin below 1, are left out.

    All columns share the passes: a sketch, a count, and so on. What reaches the driver is a few numbers a column.
    """
    names = list(values)
    found: dict[str, Bracket] = {}
    wide = [max(0.0, share - MARGIN), min(1.0, share + MARGIN)]
    row = df.agg(*[F.struct(F.count(v).alias("n"), _sketch(v, wide).alias("s")).alias(f"c{i}") for i, v in enumerate(values.values())]).first()
    guess = {}
    for i, c in enumerate(names):
        n = row[f"c{i}"]["n"]
        if n and ranks(n)[0] > 0:
            found[c], guess[c] = Bracket(n, *ranks(n), upto=n), row[f"c{i}"]["s"]
    for _ in range(MAX_ROUNDS):
        if not guess:
            break
        counts = df.agg(*[F.struct(F.count_if(values[c] < low).alias("less"), F.count_if(values[c] <= high).alias("upto")).alias(f"c{i}")
                          for i, (c, (low, high)) in enumerate(guess.items())]).first()
        narrower = []
        for i, (c, (low, high)) in enumerate(guess.items()):
            b, before = found[c], found[c].inside
            if counts[f"c{i}"]["less"] < b.first:
                b.low, b.below = low, counts[f"c{i}"]["less"]
            if counts[f"c{i}"]["upto"] >= b.last:
                b.high, b.upto = high, counts[f"c{i}"]["upto"]
            if b.open and b.inside < before:
                narrower.append(c)
        if not narrower:
            break
        row = df.agg(*[_sketch(F.when(values[c].between(found[c].low, found[c].high), values[c]), found[c].shares()).alias(f"c{i}")
                       for i, c in enumerate(narrower)]).first()
        guess = {c: row[f"c{i}"] for i, c in enumerate(narrower)}
    return found


def medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Exact median of every listed column (NULL and NaN ignored; even counts average the two middle values,
    as ``percentile(0.5)``); columns without values are left out."""
    values = {}
    for c in cols:
        x = F.col(c).cast("double")
        values[c] = F.when(~F.isnan(x), x)
    found = brackets(df, values, 0.5, lambda n: ((n + 1) // 2, n // 2 + 1))
    out = {c: b.low for c, b in found.items() if b.low == b.high}
    rest = [c for c in found if c not in out]
    if not rest:
        return out
    candidates = F.filter(F.array(*[F.struct(F.lit(c).alias("column"), values[c].alias("value"), F.lit(found[c].below).cast("bigint").alias("below"),
                                             F.lit(found[c].first).cast("bigint").alias("first"), F.lit(found[c].last).cast("bigint").alias("last"),
                                             values[c].between(found[c].low, found[c].high).alias("inside")) for c in rest]),
                          lambda s: s["inside"])
    counts = df.select(F.explode(candidates).alias("s")).select("s.*").groupBy("column", "value", "below", "first", "last").agg(
        F.count(F.lit(1)).alias("w"))
    upto = F.col("below") + F.sum("w").over(Window.partitionBy("column").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    hits = counts.withColumn("upto", upto)
    # how many of the two middle ranks fall on the value
    hit = lambda r: ((F.col(r) <= F.col("upto")) & (F.col(r) > F.col("upto") - F.col("w"))).cast("int")
    hits = hits.withColumn("hits", hit("first") + hit("last")).where("hits > 0")
    mids = hits.groupBy("column").agg((F.sum(F.col("value") * F.col("hits")) / 2).alias("median"))
    return out | {r["column"]: r["median"] for r in mids.collect()}  # one row a column
