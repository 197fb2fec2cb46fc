"""Pareto category cut.

Fit: count rows per category, order by count descending (ties by name, NULL first),
keep the categories whose running total is below ``share`` of the grand total. The
reference does this with an unpartitioned window, a driver ``collect`` of the total and
a collected Python list shipped back as an ``IN`` literal. Here the running total is a
distributed prefix sum over the per-category table, the grand total a scalar subquery,
and the list stays a DataFrame.

Apply: left join of the rows to the fitted categories. The fitted table has at most one
row per category; no broadcast hint is forced on it, adaptive execution turns the join
into a broadcast at run time when the fitted side is measured small enough, and keeps a
shuffle join (with skew splitting of hot categories) otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators.prefix import prefix_sums

# The reference's flag labels (its "top 20" is an 80 %-of-rows cut).
IN_TOP = "in_top_20"
NOT_IN_TOP = "not_in_top_20"


def category_counts(df: DataFrame, category_col: str, count_col: str = "product_id") -> DataFrame:
    return df.groupBy(category_col).agg(F.count(count_col).alias("present_in"))


def _accumulate(counts: DataFrame, category_col: str) -> DataFrame:
    cum = prefix_sums(counts, [("present_in", False), (category_col, True, False)], ["present_in"])
    return cum.withColumnRenamed("cum_present_in", "accumulate")


def cumulative_counts(df: DataFrame, category_col: str, count_col: str = "product_id") -> DataFrame:
    """``(category, present_in, accumulate)``: non-NULL ``count_col`` per category and the
    running total in descending count order (ties by category, NULL first)."""
    return _accumulate(category_counts(df, category_col, count_col), category_col)


def pareto_fit(df: DataFrame, category_col: str, share: float = 0.8, count_col: str = "product_id") -> DataFrame:
    """The categories inside the cut: running total ``< share`` x grand total."""
    return pareto_fit_counts(category_counts(df, category_col, count_col), category_col, share)


def pareto_fit_counts(counts: DataFrame, category_col: str, share: float = 0.8) -> DataFrame:
    """:func:`pareto_fit` from a ``(category, present_in)`` count table."""
    total = counts.agg(F.sum("present_in")).scalar()  # scalar subquery: the reference's collect()
    cum = _accumulate(counts, category_col)
    return cum.where(F.col("accumulate") < total * F.lit(share)).select(category_col)


def pareto_apply(df: DataFrame, fitted: DataFrame, category_col: str, out: str | None = None,
                 in_label: str = IN_TOP, out_label: str = NOT_IN_TOP) -> DataFrame:
    """Replace (or add as ``out``) the category by the in/out label. A NULL category
    never matches, so it is always ``out_label`` (as ``isin`` on NULL in the reference)."""
    out = out or category_col
    marked = fitted.select(F.col(category_col).alias("_cat"), F.lit(True).alias("_in"))
    joined = df.join(marked, F.col(category_col) == F.col("_cat"), "left")
    label = F.when(F.col("_in"), F.lit(in_label)).otherwise(F.lit(out_label))
    return joined.withColumn(out, label).drop("_cat", "_in")
