"""Splits, sampling and set difference.

The reference's time split is ``limit(int(0.7 n))`` on a time-sorted table followed by
``exceptAll``: a global sort, a limit that gathers the prefix in one place, and a
row-multiset difference. Here the 70 % point is found as the exact k-th key in
``(ts, id)`` order by bracketed selection: only the rows near the cutoff are sorted;
then both halves are plain complementary filters that push down into the scan. Only
the cutoff key (one row) and a few counts reach the driver.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from orderlens import functions as X
from orderlens.operators.bracket import FEW, brackets
from orderlens.operators.prefix import sort_key, rows_at_ranks

TWO_POW_32 = 4294967296


def _zoned(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, TimestampType)


def _kth_key_text(df: DataFrame, col: str, k: int, weight: str | None = None) -> tuple[Any, int]:
    """The k-th smallest ``col`` (NULLs last) in a form that rebuilds the exact value
    (text; epoch microseconds for zone-aware timestamps), and the weight before it."""
    if weight is None:
        df = df.withColumn("_w", F.lit(1).cast("bigint"))
        weight = "_w"
    hit = rows_at_ranks(df, [(col, True)], weight, F.array(F.lit(k).cast("bigint")))
    key = F.unix_micros(F.col(col)) if _zoned(df, col) else F.col(col).cast("string")
    row = hit.select(key.alias("key"), "rank_before").limit(1).collect()[0]
    return row["key"], int(row["rank_before"])


def _typed(df: DataFrame, col: str, key: Any) -> Column:
    """A literal of ``col``'s type rebuilt from ``_kth_key_text`` output: text casts are
    zone-free for every type but zone-aware timestamps, which come back from epoch
    microseconds. Both fold to constants, so the comparison still pushes down."""
    if _zoned(df, col):
        return F.timestamp_micros(F.lit(key).cast("bigint"))
    return F.lit(key).cast(df.schema[col].dataType)


def _narrowed(df: DataFrame, col: str, k: int, n: int) -> tuple[DataFrame, int, int]:
    """The rows whose ``col`` lies in a bracket around the k-th of ``n`` (NULLs last), the rank in it and its size."""
    b = brackets(df, {"k": sort_key(df, col, True)}, k / n, lambda n: (k, k))["k"]
    return df.where(sort_key(df, col, True).between(b.low, b.high)), k - b.below, b.inside


def _one_value(df: DataFrame, col: str) -> bool:
    """Whether all rows share one value of ``col``, NULL included."""
    ends = df.agg(F.min(col).eqNullSafe(F.max(col)).alias("same"), F.count(col).alias("some"), F.count(F.lit(1)).alias("all")).first()
    return ends["same"] and ends["some"] in (0, ends["all"])


def time_prefix_predicate(df: DataFrame, ts: str, id_col: str, share: float = 0.7) -> Column:
    """Predicate selecting the first ``int(share * n)`` rows in ``(ts NULLS LAST, id)``
    order (``id`` unique). Bracketed selection: a sketch and a count bracket the cutoff
    by its time, and by its id where many rows share the time; what is left is sorted."""
    rest = df.select(ts, id_col)
    left = rest.count()
    rank = int(left * share)
    if rank <= 0:
        return F.lit(False)
    rest, rank, left = _narrowed(rest, ts, rank, left)
    if left > FEW:
        if not _one_value(rest, ts):  # many times that share a sort key
            per_ts = rest.groupBy(ts).agg(F.count(F.lit(1)).alias("_w"))
            t_text, before = _kth_key_text(per_ts, ts, rank, "_w")
            rest = rest.where(F.col(ts).isNull() if t_text is None else F.col(ts) == _typed(df, ts, t_text))
            rank -= before
            left = rest.count()
        rest, rank, left = _narrowed(rest, id_col, rank, left)
    text = lambda c: (F.unix_micros(F.col(c)) if _zoned(df, c) else F.col(c).cast("string")).alias(c)
    if left > FEW:  # many ids that share a sort key
        t_text = rest.select(text(ts)).first()[0]
        id_text, _ = _kth_key_text(rest.select(id_col), id_col, rank)
    else:
        last = rest.orderBy(F.col(ts).asc_nulls_last(), F.col(id_col)).offset(rank - 1).limit(1).select(text(ts), text(id_col)).first()
        t_text, id_text = last[0], last[1]
    id_lit = _typed(df, id_col, id_text)
    if t_text is None:
        return F.col(ts).isNotNull() | (F.col(ts).isNull() & (F.col(id_col) <= id_lit))
    t_lit = _typed(df, ts, t_text)
    return F.col(ts).isNotNull() & ((F.col(ts) < t_lit) | ((F.col(ts) == t_lit) & (F.col(id_col) <= id_lit)))


def split_time_prefix(df: DataFrame, ts: str, id_col: str, share: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """``(first share of rows in time order, the rest)`` as two complementary filters."""
    pred = time_prefix_predicate(df, ts, id_col, share)
    return df.where(pred), df.where(~pred)


def complement(df: DataFrame, part: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``df`` whose id is not in ``part`` (left anti join on the id, instead of a
    whole-row difference)."""
    return df.join(part.select(id_col), [id_col], "left_anti")


def _fraction(stratum: str, fractions: dict[Any, float]) -> Column:
    lookup = F.create_map(*[x for k, v in fractions.items() for x in (F.lit(k), F.lit(float(v)))])
    frac = F.try_element_at(lookup, F.col(stratum))
    return F.when(frac.isNull(), F.raise_error(F.concat(
        F.lit(f"stratified_sample: no fraction for {stratum}="), F.col(stratum).cast("string")))).otherwise(frac)


def stratified_sample(df: DataFrame, id_col: str, stratum: str, fractions: dict[Any, float],
                      method: str = "hash", seed: int = 123) -> DataFrame:
    """Per-stratum sample. ``hash`` keeps a row when md5 of its id falls below
    ``fraction * 2^32``: reproducible on any cluster layout and SQL-checkable.
    ``bernoulli`` is ``sampleBy``'s ``rand(seed) < fraction``. Unlike ``sampleBy``, a
    stratum without a fraction fails the job instead of silently vanishing."""
    frac = _fraction(stratum, fractions)
    if method == "hash":
        return df.where(X.unit_hash(id_col) < frac * F.lit(TWO_POW_32))
    if method == "bernoulli":
        return df.where(F.rand(seed) < frac)
    raise ValueError(f"unknown method {method!r}")


def hash_folds(df: DataFrame, id_col: str, folds: int, out: str = "fold") -> DataFrame:
    """``out``: a fold from 0 to ``folds - 1`` by the md5 of the id, the same on any partition layout."""
    return df.withColumn(out, F.pmod(X.unit_hash(id_col), F.lit(folds)).cast("int"))


EXCEPT_CHUNK = 10_000


def except_all(df: DataFrame, other: DataFrame) -> DataFrame:
    """Multiset difference (``EXCEPT ALL``).

    Copies are counted per distinct row (+1 left, -1 right; partial aggregation). A row left
    over n times becomes n / ``EXCEPT_CHUNK`` chunks, which are dealt evenly to all tasks
    before each writes out its copies: a few distinct rows do not mean a few tasks.
    """
    cols = df.columns
    signed = df.withColumn("_n", F.lit(1)).unionByName(other.toDF(*cols).withColumn("_n", F.lit(-1)))
    left = signed.groupBy(*cols).agg(F.sum("_n").alias("_n")).where("_n > 0")
    starts = F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(EXCEPT_CHUNK).cast("long"))
    chunks = left.withColumn("_at", F.explode(starts)).withColumn("_n", F.least(F.lit(EXCEPT_CHUNK), F.col("_n") - F.col("_at")))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = chunks.repartition(tasks, *cols, "_at")
    return dealt.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).select(*cols)


def except_distinct(df: DataFrame, other: DataFrame) -> DataFrame:
    """Set difference (``EXCEPT``): a null-safe left anti join. Both sides drop their repeated
    rows first (partial aggregation), so the join moves distinct rows only."""
    df, other = df.distinct(), other.distinct()
    return df.subtract(other)
