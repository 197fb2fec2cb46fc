"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialize

# A word is a run of characters that are not ASCII white space (contract of the numbered operators).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """One input table, pruned to ``cols`` at the scan."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def text_of(col: str = "text") -> Column:
    """The text, with NULL as the empty string."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def n_words(text: Column) -> Column:
    """Number of words of a non-NULL text as bigint."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def key_text(col: str) -> Column:
    """A record key as text; the NULL key is a value of its own, unlike any real key."""
    return F.coalesce(F.concat(F.lit("k:"), F.col(col).cast("string")), F.lit("n"))


def unit_from_md5(digest_hex: Column) -> Column:
    """A number strictly between 0 and 1 from the first 52 bits of an md5 hex digest."""
    return (F.conv(F.substring(digest_hex, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def fresh(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that an operator is about to add: results win over clashing inputs."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def with_place(docs: DataFrame, name: str, *cols: Column) -> DataFrame:
    """``cols`` of ``docs`` plus ``row``, the place of each row: (hash of its file, index in it).

    The same on every read, so it can join decisions back to rows that share all their values
    without a numbered copy of the texts. Rows that do not come straight from Parquet files
    are written to the shared folder first.
    """
    place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")).alias("row")
    hidden = docs._jdf.queryExecution().analyzed().metadataOutput()
    if "_metadata" not in [hidden.apply(i).name() for i in range(hidden.size())]:
        docs = materialize(docs, name)
    return docs.select(*cols, place)


PLACE = "struct<file:bigint,at:bigint>"
BROADCAST_PLACES = 100_000


def few_places(places: DataFrame) -> DataFrame:
    """A written table of places (or of one hash a row), marked for broadcast up to ``BROADCAST_PLACES`` rows."""
    return F.broadcast(places) if places.count() <= BROADCAST_PLACES else places


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """While open, Python workers get at most ``rows`` rows at once: whole texts can be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def with_window_hashes(df: DataFrame, words: str, out: str, k: int) -> DataFrame:
    """Adds ``out``: one 64-bit hash per ``k``-word window of the array column ``words`` (NULL if shorter).

    Hashes of 1, 2, 4 ... words are combined, so a window costs about log2(k) steps instead of
    k. Each level is a column of its own, because an expression inside a lambda is evaluated
    again for every element.
    """
    w = F.col(words)
    df = df.withColumn("_h1", F.when(F.size(w) >= k, F.transform(w, lambda x: F.xxhash64(x))))
    width = 1
    while width * 2 <= k:
        level, step = f"_h{width}", width
        df = df.withColumn(f"_h{2 * width}", F.transform(level, lambda h, i: F.xxhash64(h, F.get(level, i + step))))
        width *= 2
    parts, at = [], 0
    while width:  # the binary digits of k, largest first
        if k & width:
            parts.append((f"_h{width}", at))
            at += width
        width //= 2
    whole = F.slice(parts[0][0], F.lit(1), F.size(w) - (k - 1))
    if len(parts) > 1:
        whole = F.transform(whole, lambda h, i: F.xxhash64(h, *[F.get(F.col(c), i + o) for c, o in parts[1:]]))
    df = df.withColumn(out, F.when(F.size(w) >= k, whole))
    return df.drop(*[c for c in df.columns if c.startswith("_h") and c[2:].isdigit()])
