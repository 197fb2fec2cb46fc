"""Grouped aggregation operators.

Every grouped aggregate is planned as partial aggregation per task, one exchange on
the grouping key, final aggregation: a hot group is pre-reduced before the shuffle.
Pivots always take an explicit value list, so no eager distinct-values job runs and
the output schema does not depend on the data. What the list leaves out (and NULL) is
gathered under ``other``, so a pivot's columns always add up to the ungrouped total.
"""

from __future__ import annotations

from typing import Any, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from orderlens import functions as X


def multi_flag(df: DataFrame, by: str | Sequence[str], id_col: str, out: str, yes: Any = "yes",
               no: Any = "no") -> DataFrame:
    """Per ``by`` group: ``yes`` when it holds more than one distinct ``id_col``;
    returns ``(by, out)``.

    A fixed-width id (number, date, timestamp) is one hash aggregate, ``min <> max``.
    Text ids would force a sort-based aggregate for ``min``/``max``, so they are first
    reduced to distinct ``(by, id)`` pairs (hash aggregate), then counted per group.
    """
    by = [by] if isinstance(by, str) else list(by)
    if isinstance(df.schema[id_col].dataType, (StringType, BinaryType)):
        pairs = df.select(*by, id_col).distinct()
        return pairs.groupBy(*by).agg(X.binary_recode(F.count(id_col) > 1, yes, no).alias(out))
    return df.groupBy(*by).agg(X.binary_recode(X.more_than_one(id_col), yes, no).alias(out))


OTHER = "other"


def is_other(col: str, values: Sequence[Any]) -> Column:
    """NULL, or none of ``values``."""
    return ~F.coalesce(F.col(col).isin(*values), F.lit(False))


def pivot_exprs(pivot_col: str, values: Sequence[Any], aggs: dict[str, tuple[str, str]],
                fill: Any = None, name: str = "{value}_{alias}", other: str | None = OTHER) -> list[Column]:
    """Conditional aggregates equal to ``groupBy().pivot(pivot_col, values).agg(...)``.

    ``aggs`` maps alias -> (function, column); function is one of sum, count, mean,
    min, max. Output names follow Spark's pivot with several aggregates,
    ``<value>_<alias>``; with one aggregate pass ``name='{value}'``. As plain
    aggregate expressions they fuse with other aggregates on the same key. ``other``
    names the columns of all unlisted values; None only where none can occur.
    """
    fn = {"sum": F.sum, "count": F.count, "mean": F.avg, "avg": F.avg, "min": F.min, "max": F.max}
    out = []
    hits = [(v, F.col(pivot_col) == F.lit(v)) for v in values]
    if other is not None:
        hits.append((other, is_other(pivot_col, values)))
    for v, hit in hits:
        for alias, (func, c) in aggs.items():
            e = fn[func](F.when(hit, F.col(c)))
            if fill is not None:
                e = F.coalesce(e, F.lit(fill))
            out.append(e.alias(name.format(value=v, alias=alias)))
    return out


def frequent_values(df: DataFrame, col: str, most: int = 50) -> list:
    """The ``most`` commonest values of a column (ties by value, NULL left out): the fitted columns of a pivot. One
    partial aggregate; at most ``most`` values reach the driver, and a pivot counts the others under ``other``."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return sorted(r[col] for r in counts.orderBy(F.desc("n"), col).limit(most).collect())


def pivot_agg(df: DataFrame, by: Sequence[str] | str, pivot_col: str, values: Sequence[Any],
              aggs: dict[str, tuple[str, str]], fill: Any = 0, name: str | None = None,
              other: str | None = OTHER) -> DataFrame:
    by = [by] if isinstance(by, str) else list(by)
    name = name or ("{value}" if len(aggs) == 1 else "{value}_{alias}")
    return df.groupBy(*by).agg(*pivot_exprs(pivot_col, values, aggs, fill, name, other))


def group_means(df: DataFrame, by: Sequence[str] | str, spec: dict[str, str], fill: Any = 0) -> DataFrame:
    """``{out: col}`` means per group; an all-NULL group mean becomes ``fill``."""
    by = [by] if isinstance(by, str) else list(by)
    aggs = [F.avg(c) if fill is None else F.coalesce(F.avg(c), F.lit(fill)) for c in spec.values()]
    return df.groupBy(*by).agg(*[a.alias(o) for a, o in zip(aggs, spec)])


def value_counts(df: DataFrame, col: str | Column, name: str | None = None, share: bool = False,
                 count_col: str = "count") -> DataFrame:
    """Rows per value (NULL is a value, as in ``groupBy().count()``). With ``share``,
    adds ``n / total``; the total is a scalar subquery over the aggregated table, so no
    window gathers the table into one task."""
    c = F.col(col) if isinstance(col, str) else col
    name = name or (col if isinstance(col, str) else None)
    out = df.groupBy(c.alias(name) if name else c).agg(F.count(F.lit(1)).alias(count_col))
    if share:
        total = out.agg(F.sum(count_col)).scalar()  # scalar subquery, computed once
        out = out.withColumn("share", F.col(count_col) / total)
    return out


def non_null_counts(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """The reference's ``groupBy(c).agg(count(c))``: the NULL group counts 0."""
    return df.groupBy(col).agg(F.count(col).alias(out or f"count_{col}"))


def crosstab(df: DataFrame, by: str, pivot_col: str, values: Sequence[Any], other: str = OTHER) -> DataFrame:
    """Counts of ``by`` x ``pivot_col`` with one column per listed value and one for all
    others; empty cells are 0. Spark pre-aggregates per task before the single exchange on ``by``."""
    return df.groupBy(by).agg(*[
        F.count(F.when(F.col(pivot_col) == F.lit(v), F.lit(1))).alias(str(v)) for v in values],
        F.count(F.when(is_other(pivot_col, values), F.lit(1))).alias(other))


def mean_by_score(df: DataFrame, value: str, score: str = "review_score", positive_only: bool = False,
                  exclude_score: Any = 0.0, sentinel: Any = None, out: str | None = None) -> DataFrame:
    """Mean of ``value`` per score, orders with score ``exclude_score`` left out.

    ``positive_only`` keeps only ``value > 0``. With ``sentinel`` the column's NULLs are
    read as that number first, reproducing the reference's 999 day counts.
    """
    v = F.col(value)
    if sentinel is not None:
        v = F.coalesce(v, F.lit(sentinel))
    cond = F.col(score) != F.lit(exclude_score)
    if positive_only:
        cond = cond & (v > 0)
    return df.where(cond).groupBy(score).agg(F.avg(v).alias(out or f"mean_{value}"))


def sum_by_score(df: DataFrame, cols: Sequence[str], score: str = "review_score",
                 exclude_score: Any = 0.0) -> DataFrame:
    return (df.where(F.col(score) != F.lit(exclude_score)).groupBy(score)
            .agg(*[F.sum(c).alias(f"sum_{c}") for c in cols]))


def column_totals(df: DataFrame, cols: Sequence[str], exact_scale: int | None = 2) -> DataFrame:
    """One row of column sums. Money columns are summed as decimals (exact and
    independent of the order in which partial sums meet), then returned as double."""
    def total(c):
        if exact_scale is None:
            return F.sum(c)
        return F.sum(F.col(c).cast(f"decimal(28,{exact_scale})")).cast("double")
    return df.agg(*[total(c).alias(f"sum_{c}") for c in cols])
