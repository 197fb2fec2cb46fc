"""Scalar column expressions. All built-in Spark functions: they stay inside whole-stage
codegen and never cross into a Python worker."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

KEEP = object()  # recode default: pass the input value through unchanged


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def recode(c: str | Column, mapping: dict[Any, Any], default: Any = KEEP) -> Column:
    """Multi-branch ``CASE WHEN c = k THEN v ... ELSE default END``.

    ``default=KEEP`` keeps unmatched values (cast to the output type by Spark's CASE
    coercion); ``None`` maps them to NULL. A NULL input never matches a key.
    """
    c = col(c)
    out = None
    for k, v in mapping.items():
        out = (F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v)))
    if out is None:
        return c
    if default is KEEP:
        # Text labels over a non-text input keep the other values as their text form.
        if all(isinstance(v, str) for v in mapping.values()):
            return out.otherwise(c.cast("string"))
        return out.otherwise(c)
    return out.otherwise(F.lit(default))


def binary_recode(cond: Column, yes: Any, no: Any) -> Column:
    """Two-way recode; a NULL condition falls to ``no`` as in the reference's
    ``when().otherwise()``."""
    return F.when(cond, F.lit(yes)).otherwise(F.lit(no))


def presence_flag(c: str | Column) -> Column:
    """1 when the value is present, 0 when NULL."""
    return F.when(col(c).isNotNull(), F.lit(1)).otherwise(F.lit(0))


def safe_divide(num: str | Column, den: str | Column) -> Column:
    """Division that yields NULL for a zero or NULL divisor even under ANSI mode
    (the reference ran with ANSI off, where ``x / 0`` is NULL)."""
    return F.try_divide(col(num), col(den))


def parse_timestamp(c: str | Column, fmt: str, ntz: bool = True) -> Column:
    """String to timestamp with a fixed pattern; unparsable strings become NULL
    (``try_to_timestamp``) instead of failing the job under ANSI mode.

    The zone-less form parses the wall-clock text directly (``to_timestamp_ntz``, only
    on strings the pattern accepts), so no session time zone or daylight-saving gap can
    shift it.
    """
    ts = F.try_to_timestamp(col(c), F.lit(fmt))
    if not ntz:
        return ts
    return F.when(ts.isNotNull(), F.to_timestamp_ntz(col(c), F.lit(fmt)))


def sentiment(score: str | Column, positive_above: int = 3, none_value: int = 0) -> Column:
    """Three-way review sentiment: ``> 3`` Positive, ``= 0`` No Review, else Negative."""
    s = col(score)
    return (F.when(s > positive_above, F.lit("Positive"))
            .when(s == none_value, F.lit("No Review"))
            .otherwise(F.lit("Negative")))


def more_than_one(c: str | Column) -> Column:
    """Aggregate: TRUE when a group holds more than one distinct non-NULL value.

    ``min <> max`` is a plain (partial + final) aggregate in one exchange; a
    ``count(DISTINCT)`` would add a second exchange. NULL-only groups give NULL,
    which callers treat as "not more than one".
    """
    return F.min(col(c)) != F.max(col(c))


def unit_hash(c: str | Column) -> Column:
    """Deterministic uniform number in [0, 2^32) from the md5 of the value's string
    form. Same value in Spark and DuckDB, independent of partitioning."""
    return F.conv(F.substring(F.md5(col(c).cast("string")), 1, 8), 16, 10).cast("bigint")
