"""Operator 7: weighted rendezvous hashing of record keys over shards.

Every (key, shard) pair draws a uniform number from an md5 digest; the record goes to the
shard with the least ``-ln(u) / weight``. A shard's draws do not depend on the other shards,
so one more shard takes records only into itself, and a changed weight moves only the share
that the weights differ by. The law is ``key``: the key and the shards alone decide.

Slots number each shard's records 0, 1, 2 ... without gaps. They come from running counts
over (shard, digest prefix) buckets, so no task holds a whole shard.

Defined cases: a NULL key is one key of its own (all its rows share a shard); NULL text has
0 bytes, size 1 and the checksum of the empty text; equal rows get the same shard and
different slots; an empty table gives an empty result; input columns whose names clash with
result columns are replaced by the result's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import fresh, key_text, text_of, unit_from_md5, with_place

RESULT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Shard (0-based int) of a text key over ``len(weights)`` shards of positive weight."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights must be positive and not empty")
    draws = [F.struct((-F.log(unit_from_md5(F.md5(F.concat_ws("|", F.lit(str(i)), key)))) / F.lit(float(w))).alias("cost"),
                      F.lit(i).alias("shard")) for i, w in enumerate(weights)]
    return F.array_min(F.array(*draws))["shard"]


def shard_rows(rows: DataFrame, weights: Sequence[float], grown_weight: float | None = 1.0, key: str = "doc_id",
               text: str = "text", bucket_digits: int = 3) -> DataFrame:
    """The key and the columns of ``RESULT`` for every row.

    ``grown_weight`` is the weight of the shard added for ``grown_shard`` (None: NULL).
    ``bucket_digits`` hex digits of a digest of key, size and checksum split each shard for slot
    numbering: a window task holds about rows / shards / 16 ** digits rows, also of a key that
    many different texts share. Equal rows are counted before the shuffle and expanded after it.
    """
    kt = key_text(key)
    grown = rendezvous(kt, [*weights, grown_weight]) if grown_weight else F.lit(None)
    body = F.encode(text_of(text), "UTF-8")
    slim = rows.select(key, (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    slim = slim.withColumn("_digest", F.md5(F.concat_ws("|", kt, "size", "text_crc32")))
    cols = slim.columns
    same = slim.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    placed = (same.withColumn("shard", rendezvous(kt, weights).cast("int"))
              .withColumn("grown_shard", grown.cast("int"))
              .withColumn("_bucket", F.substring("_digest", 1, bucket_digits)))
    totals = placed.groupBy("shard", "_bucket").agg(F.sum("_n").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("shard", "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = (Window.partitionBy("shard", "_bucket").orderBy("_digest", *[c for c in cols if c != "_digest"])
              .rowsBetween(Window.unboundedPreceding, -1))
    # At most shards * 16 ** bucket_digits rows: bounded by parameters, not by data.
    first = placed.withColumn("_first", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(
        F.broadcast(starts), ["shard", "_bucket"])
    return (first.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
            .select(key, "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("_start") + F.col("_first") + F.col("_i")).cast("long").alias("slot"), "grown_shard"))


def shard_documents(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Equal-weight shards 0 .. shards - 1 for every document; with one more in ``grown_shard``."""
    return shard_rows(docs.select(key, text), [1.0] * shards, 1.0, key, text)


def with_shards(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every column of ``docs`` plus the columns of ``RESULT``.

    Slots follow a digest of key and place, so rows that share a key spread over the buckets;
    whole rows are shuffled once.
    """
    docs = fresh(docs, *RESULT)
    kt, weights = key_text(key), [1.0] * shards
    body = F.encode(text_of(text), "UTF-8")
    rows = with_place(
        docs, "shard-documents", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), kt.alias("kt"),
        (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    rows = rows.withColumn("digest", F.md5(F.concat_ws("|", "kt", "row.file", "row.at"))).select(
        "*", rendezvous(F.col("kt"), weights).cast("int").alias("shard"), F.substring("digest", 1, 3).alias("bucket"))
    totals = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("shard", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("digest"))
    placed = rows.withColumn("nth", inside).join(F.broadcast(starts), ["shard", "bucket"])  # shards * 4096 rows at most
    return placed.select("doc.*", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                         (F.col("start") + F.col("nth") - 1).cast("long").alias("slot"),
                         rendezvous(F.col("kt"), [*weights, 1.0]).cast("int").alias("grown_shard"))
