"""Distributed running sums and exact rank selection.

Several reference operators need a running total over a sorted table: the Pareto
category cut, ROC/PR areas, ROC and lift points, ties of a time-ordered split. The naive plan (a window with no ``partitionBy``) moves every row into a
single task. Here the ordered key range is cut into buckets at approximate quantiles
(a bounded GK sketch per group, ``percentile_approx``); per-bucket totals (a table of
at most ``buckets`` rows per group) give each bucket's offset, and the running sum
inside a bucket is an ordinary window partitioned by ``(group, bucket)``. Every step is
a distributed DataFrame operation; nothing is collected (single-row results such as the
split points are scalar subqueries, planned once and inlined).

Callers aggregate first (one row per distinct sort key, e.g. per score or per value),
so a hot key is a single row and buckets hold about ``rows / buckets`` rows each.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

from orderlens.operators.bracket import medians

OrderSpec = Sequence[tuple]  # (column, ascending[, nulls_last])


def default_buckets(df: DataFrame) -> int:
    try:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # noqa: BLE001
        parts = 8
    return max(16, 2 * parts)


def _text_key(df: DataFrame, name: str) -> Column:
    """A double that never decreases along text ``name``: the six bytes after the prefix
    that all values share (found from the least and the greatest), read as one number."""
    ends = df.agg(F.min(name).alias("lo"), F.max(name).alias("hi")).first()  # one row
    lo, hi = (str(ends[x] or "").encode() for x in ("lo", "hi"))
    same = next((i for i, (a, b) in enumerate(zip(lo, hi)) if a != b), min(len(lo), len(hi)))
    six = F.rpad(F.hex(F.substring(F.encode(F.col(name), "UTF-8"), same + 1, 6)), 12, "0")
    return F.conv(six, 16, 10).cast("double")


def sort_key(df: DataFrame, name: str, ascending: bool, nulls_last: bool = True) -> Column:
    """A double that never decreases in the requested order of ``name`` (the window inside
    a bucket settles ties). As in Spark's own order NaN is the greatest number; it shares
    a key with infinity, and NULLs get the key of the end they sort to."""
    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, TimestampNTZType):
        # Seconds since the epoch from the wall-clock fields: no session time zone is
        # involved, so the key stays monotone even across daylight-saving gaps.
        v = (F.unix_date(c.cast("date")).cast("double") * 86400.0 + F.hour(c) * 3600.0
             + F.minute(c) * 60.0 + F.date_part(F.lit("SECOND"), c).cast("double"))
    elif isinstance(dt, TimestampType):
        v = F.unix_micros(c).cast("double")
    elif isinstance(dt, DateType):
        v = F.unix_date(c).cast("double")
    elif isinstance(dt, StringType):
        v = _text_key(df, name)
    else:
        v = c.cast("double")
        v = F.when(F.isnan(v), F.lit(float("inf"))).otherwise(v)
    if not ascending:
        v = -v
    return F.coalesce(v, F.lit(float("inf") if nulls_last else float("-inf")))


def _order_exprs(order_by: OrderSpec) -> list[Column]:
    out = []
    for spec in order_by:
        name, asc = spec[0], spec[1]
        nulls_last = spec[2] if len(spec) > 2 else True
        c = F.col(name)
        if asc:
            out.append(c.asc_nulls_last() if nulls_last else c.asc_nulls_first())
        else:
            out.append(c.desc_nulls_last() if nulls_last else c.desc_nulls_first())
    return out


def prefix_sums(df: DataFrame, order_by: OrderSpec, sums: Sequence[str],
                partition_by: Sequence[str] = (), buckets: int | None = None,
                accuracy: int | None = None, prefix: str = "cum_", few_groups: bool = False, tasks: int | None = None) -> DataFrame:
    """Add ``cum_<s>``: the inclusive running sum of ``s`` in ``order_by`` order within
    each ``partition_by`` group.

    The first ``order_by`` column must be numeric, text, date or timestamp; rows should be
    unique on the ordering key (aggregate first). ``few_groups`` says that the groups are a
    handful by construction (listed columns, split labels): the per-group split points and
    bucket offsets are then broadcast, so no row is shuffled on a group key.
    ``buckets`` defaults to twice the shuffle partitions (at least 16); the sketch's
    relative error is kept at a twentieth of a bucket, so buckets stay even. ``tasks`` deals the
    buckets to that many tasks (default: the shuffle partitions).
    """
    nb = buckets or default_buckets(df)
    accuracy = accuracy or max(10000, 20 * nb)
    groups = list(partition_by)
    lead, lead_asc = order_by[0][0], order_by[0][1]
    keyed = df.withColumn("_k", sort_key(df, lead, lead_asc, order_by[0][2] if len(order_by[0]) > 2 else True))

    probs = [i / nb for i in range(1, nb)]
    step = max(1, math.isqrt(nb - 1))
    sketch = F.percentile_approx("_k", probs, accuracy).alias("_splits")
    coarse = F.filter("_splits", lambda s, i: i % step == step - 1).alias("_coarse")
    if groups:  # one row of split points per group, joined on the group key
        points = keyed.groupBy(*groups).agg(sketch).select(*groups, "_splits", coarse)
        keyed = keyed.join(F.broadcast(points) if few_groups else points, groups)
    else:  # one row: a scalar subquery, computed once and inlined (in its own
        # projection: subqueries may not sit inside the lambdas below)
        one = keyed.agg(sketch).select(F.struct("_splits", coarse).alias("s")).scalar()
        keyed = keyed.withColumns({"_splits": one.getField("_splits"), "_coarse": one.getField("_coarse")})
    # Bucket = number of split points below the key, found in two steps of about
    # sqrt(buckets) comparisons each: first among every step-th split point, then
    # inside the one slice of `step` points that can still hold the boundary.
    below = lambda arr: F.size(F.filter(arr, lambda s: s < F.col("_k")))
    c = below("_coarse")
    fine = F.slice("_splits", c * step + 1, F.lit(step))
    bucketed = (keyed.withColumn("_b", c * step + below(fine))
                .drop("_splits", "_coarse", "_k"))

    totals = bucketed.groupBy(*groups, "_b").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    before = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*groups, "_b", *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_o_{s}")
                                             for s in sums])
    if not groups or few_groups:  # at most `buckets` rows for each group: a proven bound
        offsets = F.broadcast(offsets)

    out, keys = bucketed.join(offsets, [*groups, "_b"]), [*groups, "_b"]
    if tasks:  # the window's own partitioning: no further exchange (a window normalises floating keys, so they go as text)
        floating = {g: f"_g_{g}" for g in groups if out.schema[g].dataType.typeName() in ("double", "float")}
        out = out.withColumns({t: (F.col(g) + F.lit(0.0)).cast("string") for g, t in floating.items()}) if floating else out
        keys = [floating.get(g, g) for g in keys]
        out = out.repartition(tasks, *keys)
    running = (Window.partitionBy(*keys).orderBy(*_order_exprs(order_by))
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = out.withColumns({f"{prefix}{s}": F.col(f"_o_{s}") + F.sum(s).over(running) for s in sums})
    return out.drop("_b", *[k for k in keys if k not in groups], *[f"_o_{s}" for s in sums])


def rows_at_ranks(df: DataFrame, order_by: OrderSpec, weight: str, ranks: Column,
                  partition_by: Sequence[str] = (), few_groups: bool = False) -> DataFrame:
    """Rows of a weighted, key-unique table that hold the 1-based rank(s) ``ranks``
    (an array column, constant or per group). Adds ``hits`` (how many of the ranks fall
    on the row) and ``rank_before`` (total weight strictly before the row)."""
    cum = prefix_sums(df, order_by, [weight], partition_by, prefix="_cum_", few_groups=few_groups)
    lo = F.col(f"_cum_{weight}") - F.col(weight)
    hi = F.col(f"_cum_{weight}")
    hits = F.size(F.filter(ranks, lambda r: (r > lo) & (r <= hi)))
    return (cum.withColumns({"hits": hits, "rank_before": lo})
            .where(F.col("hits") > 0).drop(f"_cum_{weight}"))


def exact_medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, median)``: the exact median of every listed column that has values (see ``bracket``)."""
    return df.sparkSession.createDataFrame(list(medians(df, cols).items()), "column string, median double")
