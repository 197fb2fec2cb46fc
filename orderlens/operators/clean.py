"""Projection, cast, recode and null-handling operators.

All are narrow transformations (no exchange) except ``null_profile``/``row_count``,
which are one global aggregate with partial aggregation per task.
"""

from __future__ import annotations

from typing import Any, Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StringType

from orderlens import functions as X
from orderlens.session import apart, materialize

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Fixed values of the reference's missing-data encodings.
MISSING_DAYS = 999
MISSING_TIMESTAMP = "2080-01-01 01:00:00"


def preview_topn(df: DataFrame, n: int, order_cols: list[str | Column]) -> DataFrame:
    """Head preview with a total order (the limit is the feature: a top-n report).
    Spark plans it as ``TakeOrderedAndProject``: each task keeps its best ``n``."""
    return df.orderBy(*order_cols).limit(n)


def cast_timestamps(df: DataFrame, cols: Iterable[str], fmt: str = TIMESTAMP_FORMAT,
                    ntz: bool = True) -> DataFrame:
    """Per-column conditional map: parse listed string columns, pass the rest."""
    cols = set(cols)
    return df.select([X.parse_timestamp(c, fmt, ntz).alias(c) if c in cols else F.col(c)
                      for c in df.columns])


def format_timestamps(df: DataFrame, cols: Iterable[str], fmt: str = TIMESTAMP_FORMAT) -> DataFrame:
    cols = set(cols)
    return df.select([F.date_format(c, fmt).alias(c) if c in cols else F.col(c) for c in df.columns])


def datediff_features(df: DataFrame, spec: dict[str, tuple[str, str]]) -> DataFrame:
    """``{out: (end, start)}`` -> calendar-day differences ``datediff(end, start)``."""
    return df.withColumns({out: F.datediff(end, start) for out, (end, start) in spec.items()})


def recode(df: DataFrame, col: str, out: str, mapping: dict[Any, Any], default: Any = X.KEEP) -> DataFrame:
    return df.withColumn(out, X.recode(col, mapping, default))


def presence_flags(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """``{flag: col}`` -> 1 when ``col`` is present, else 0."""
    return df.withColumns({flag: X.presence_flag(c) for flag, c in spec.items()})


def dropna_all(df: DataFrame, subset: list[str]) -> DataFrame:
    """Drop rows where *every* listed column is NULL (``how='all'``)."""
    return df.dropna(how="all", subset=subset)


def sentinel_fill(df: DataFrame, fills: dict[str, Any], to_string: Iterable[str] = (),
                  string_fill: str = MISSING_TIMESTAMP) -> DataFrame:
    """The reference's sentinel encodings: numeric constants on a subset, then listed
    timestamp columns cast to string and their NULLs filled with ``string_fill``.

    (A string fill on a timestamp column is silently ignored by Spark, hence the cast.)
    """
    to_string = list(to_string)
    out = df.fillna(fills) if fills else df
    if to_string:
        keep = set(to_string)
        out = out.select([F.col(c).cast("string").alias(c) if c in keep else F.col(c) for c in out.columns])
        out = out.fillna(string_fill, subset=to_string)
    return out


def clean_orders(df: DataFrame, ts_cols: list[str], num_cols: list[str], sentinel: bool = True) -> DataFrame:
    """Drop orders with no timestamp at all; with ``sentinel`` also fill day counts with
    999 and missing timestamps with the 2080 string, as the reference does."""
    out = dropna_all(df, ts_cols)
    if sentinel:
        out = sentinel_fill(out, {c: MISSING_DAYS for c in num_cols}, to_string=ts_cols)
    return out


def _nulls(df: DataFrame) -> list[Column]:
    return [F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in df.columns] + [F.count(F.lit(1)).alias("rows")]


def clean_orders_profiled(df: DataFrame, ts_cols: list[str], num_cols: list[str], sentinel: bool = True) -> tuple[DataFrame, DataFrame]:
    """``clean_orders`` written to the shared folder, and its NULL profile ``(stage, column, nulls, rows)`` before and
    after. Both profiles are observed while the cleaned table is written, so the orders are read once."""
    before, after = Observation("before"), Observation("after")
    spark, df = df.sparkSession, apart(df)
    cleaned = clean_orders(df.observe(before, *_nulls(df)), ts_cols, num_cols, sentinel)
    written = materialize(cleaned.observe(after, *_nulls(cleaned)), "clean-orders", reader=spark)
    rows = [(stage, c, n, seen["rows"]) for stage, seen in (("before", before.get), ("after", after.get)) for c, n in seen.items() if c != "rows"]
    return written, spark.createDataFrame(rows, "stage string, column string, nulls bigint, rows bigint")


def null_profile(df: DataFrame) -> DataFrame:
    """One row, one bigint NULL count per column, in a single pass."""
    return df.select([F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in df.columns])


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def typed_column_select(df: DataFrame, drop_types=(DateType(), StringType()),
                        keep_names: Iterable[str] = ()) -> DataFrame:
    """Keep a column when its type is none of ``drop_types`` or its name is listed.
    As in the reference, timestamps are not a dropped type, so they pass."""
    keep_names = set(keep_names)
    names = [f.name for f in df.schema.fields
             if all(f.dataType != t for t in drop_types) or f.name in keep_names]
    return df.select(*names)


def array_expand(df: DataFrame, col: str, n: int, prefix: str | None = None,
                 keep: Iterable[str] = ()) -> DataFrame:
    """Array (or ``vector_to_array`` output) element i -> scalar column ``prefix_i``. An array
    of another length fails the job; a NULL array gives NULLs."""
    prefix = prefix or col
    wrong = F.raise_error(F.concat(F.lit(f"array_expand: {col} has not {n} elements but "), F.size(col).cast("string")))
    checked = F.when(F.col(col).isNull() | (F.size(col) == n), F.col(col)).otherwise(wrong)
    return df.select(*keep, *[checked[i].alias(f"{prefix}_{i}") for i in range(n)])


def round_doubles(df: DataFrame, digits: int, cols: Iterable[str]) -> DataFrame:
    """Round the listed double columns: those that add up floating-point terms, whose last
    bits depend on the order in which partial sums meet. All other columns stay as they are.

    Two steps through decimals: first to 9 places (absorbs last-bit noise from a
    different summation order), then half-up to ``digits``. NaN and infinities pass.
    """
    def rnd(c):
        x = F.col(c)
        return F.when(F.abs(x) < F.lit(1e28), F.round(x.cast("decimal(38,9)"), digits).cast("double")).otherwise(x)
    cols = set(cols)
    return df.select([rnd(f.name).alias(f.name) if isinstance(f.dataType, DoubleType) and f.name in cols else F.col(f.name)
                      for f in df.schema.fields])
