"""Operator 13: WARC archives, written from pages and read back by boundary-chain verification.

Writing: one record per page. Of equal payloads of at least ``MIN_REVISIT`` bytes the one with
the largest key is a response and the others are revisits that refer to it; smaller payloads
are always responses. Blocks are HTTP messages, so the payload is what follows their header.

Reading: tasks cut the files at every record magic, wherever it stands, and emit for each
candidate its offset and that of its successor (header length and Content-Length tell it).
Magic inside a payload makes false candidates. Pointer jumping from each file's start, with
hops that double every round, marks the reachable candidates; only these are records, and the
pieces between them go back into the payload they were cut from. A chain that does not end
exactly at its file's end is an error, so nothing is lost silently.

Defined cases: a NULL body is an empty payload; a NULL key or url writes no header for it and
comes back NULL, and sorts below every other key; rows with equal key and payload are records
of their own, one of them the response; an empty table writes no record; extra columns are
ignored. Line breaks in a url are percent-encoded, as a header line cannot hold them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import materialize, scratch_path
from .common import with_place

MIN_REVISIT = 1000  # bytes
MAX_RECORDS = 200_000  # of one file
MAGIC = "WARC/1."
CUT = "\n" + MAGIC  # no proper prefix of it is also a suffix, and no header line can begin so
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + END
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(place: Column) -> Column:
    digest = F.md5(F.concat_ws("|", place["file"].cast("string"), place["at"].cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a NULL value."""
    return F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value), F.lit(""))


def records(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html",
            date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One ``record`` text per page, without the blank line that ends it. ``date`` is the capture time of all."""
    rows = with_place(pages, "warc-pages", F.col(key).alias("key"), F.col(url).cast("string").alias("url"),
                      F.coalesce(F.col(body).cast("string"), F.lit("")).alias("body"))
    large = rows.where(F.octet_length("body") >= MIN_REVISIT).select(
        "row", F.struct(F.col("key").isNotNull().alias("some"), "key", "row").alias("rank"), F.sha2("body", 256).alias("digest"))
    # counted before the join, so a payload of many copies is one row a task here, and a join that adaptive execution splits
    first = large.groupBy("digest").agg(F.max("rank").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = large.join(first, "digest").where(F.col("row") != F.col("first.row")).select("row", F.col("first.row").alias("response"))
    rows = rows.join(materialize(again, "warc-revisits"), "row", "left")
    revisit = F.col("response").isNotNull()
    block = F.concat(F.lit(HTTP), F.when(revisit, F.lit("")).otherwise(F.col("body")))
    clean = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return rows.select(F.concat(
        F.lit(MAGIC + "1\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        _line("WARC-Record-ID", _record_id(F.col("row"))), _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", clean),
        _line("X-Page-ID", F.url_encode(F.col("key").cast("string"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("body"))),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("response")))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", F.octet_length(block).cast("string")), F.lit(END), block).alias("record"))


def write(pages: DataFrame, path: str, **names: str) -> None:
    """WARC 1.1 files (uncompressed, so that readers can split them) in the new folder ``path``."""
    (records(pages, **names).write.mode("errorifexists").option("lineSep", END)
     .option("maxRecordsPerFile", MAX_RECORDS).text(path))


def _pinned(spark: SparkSession) -> SparkSession:
    """A session that cuts files the same way at every scan, however many executors there are by then."""
    same = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if same.conf.isModifiable(k):
            same.conf.set(k, v)
    same.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return same


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The files below ``path`` cut at every ``CUT``: (file, size, block, seq, value). ``seq`` orders a block's pieces."""
    text = spark.read.option("lineSep", CUT).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"), "value")


def _head(value: Column) -> Column:
    return F.substring_index(value, END, 1)


def _field(head: Column, name: str) -> Column:
    pattern = rf"(?im)^{name}:[ \t]*([^\r\n]*)"
    return F.when(head.rlike(pattern), F.rtrim(F.regexp_extract(head, pattern, 1)))


def _carried(rows: DataFrame, value: str, agg, out: str) -> DataFrame:
    """``out``: the aggregate of ``value`` over all earlier rows of the same file.

    Blocks are aggregated first, so a window task holds one block's rows or one file's blocks.
    """
    per_block = rows.groupBy("file", "block").agg(agg(value).alias("_own"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    per_block = per_block.select("file", "block", agg("_own").over(earlier).alias("_before"))
    inside = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", agg(value).over(inside)).join(per_block, ["file", "block"])
    both = F.array(F.col("_before"), F.col("_inside"))
    total = F.aggregate(both, F.lit(None).cast("long"), lambda a, x: F.coalesce(a + x, a, x)) if agg is F.sum else F.array_max(both)
    return rows.withColumn(out, total).drop("_inside", "_before")


def candidates(cut: DataFrame) -> DataFrame:
    """(file, block, seq, at, ends, successor, size) of every piece: where the record that it may begin starts, where the
    piece ends, and where the next record starts (NULL when the piece begins no record)."""
    head = _head(F.col("value"))
    slim = cut.select(
        "file", "block", "seq", "size", F.octet_length("value").cast("long").alias("bytes"), F.octet_length(head).cast("long").alias("head"),
        F.col("value").rlike(r"\A(WARC/1[.])?[0-9]+\r\n").alias("begins"), F.startswith("value", F.lit(MAGIC)).alias("first"),
        _field(head, "Content-Length").try_cast("long").alias("content"))
    slim = materialize(slim.withColumn("step", F.col("bytes") + len(CUT)), "warc-pieces")
    placed = _carried(slim, "step", F.sum, "before").withColumn("start", F.coalesce("before", F.lit(0)))
    # all pieces but a file's first have lost the magic that they were cut at
    begins = F.col("begins") & (F.col("first") == (F.col("start") == 0)) & (F.col("head") < F.col("bytes")) & F.col("content").between(0, F.col("size"))
    return placed.select(
        "file", "block", "seq", F.when(F.col("start") == 0, F.lit(0)).otherwise(F.col("start") - len(MAGIC)).alias("at"),
        (F.col("start") + F.col("bytes")).alias("ends"),
        F.when(begins, F.col("start") + F.col("head") + F.col("content") + 2 * len(END)).alias("successor"), "size")


def reachable(found: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(file, at) of the candidates that the chain from their file's start passes through, by pointer jumping.

    Round k knows the first 2 ** k records of every file and each candidate's 2 ** k-th
    successor. Every round is written to the shared folder; the driver reads one number.
    """
    ends = found.select("file", F.col("at").alias("successor"), F.lit(True).alias("there"))
    state = found.join(ends, ["file", "successor"], "left").select(
        "file", "at", F.when(F.col("there"), F.col("successor")).alias("hop"), (F.col("at") == 0).alias("reached"))
    for _ in range(max_rounds):
        state = materialize(state, "warc-chain")
        ahead = state.where(F.col("reached") & F.col("hop").isNotNull()).select("file", F.col("hop").alias("at"), F.lit(True).alias("hit"))
        if ahead.isEmpty():
            return state.where("reached").select("file", "at")
        further = state.select("file", F.col("at").alias("hop"), F.col("hop").alias("then"))
        state = (state.join(further, ["file", "hop"], "left").join(ahead, ["file", "at"], "left")
                 .select("file", "at", F.col("then").alias("hop"), (F.col("reached") | F.col("hit").isNotNull()).alias("reached")))
    raise RuntimeError(f"chains did not end in {max_rounds} rounds")


def _check_chains(found: DataFrame, reached: DataFrame) -> None:
    """Every file's chain must begin at its first byte and end at its last."""
    known = found.join(reached, ["file", "at"])
    follows = known.select("file", F.col("at").alias("successor"), F.lit(True).alias("there"))
    broken = known.join(follows, ["file", "successor"], "left").where(
        F.col("successor").isNull() | F.col("there").isNull() & (F.col("successor") != F.col("size")))
    if rows := broken.select("file", "at").orderBy("file", "at").limit(5).collect():
        raise ValueError("no whole record at " + ", ".join(f"byte {r['at']} of {r['file']}" for r in rows))


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every record below ``path``: (record_id, type, url, key, refers_to, digest, payload).

    ``key`` is the text of ``X-Page-ID``, ``digest`` the payload digest that the header states,
    ``payload`` the block without its HTTP header as bytes (a revisit's is empty).
    """
    cut = pieces(_pinned(spark), path)
    found = materialize(candidates(cut), "warc-candidates")
    reached = reachable(found)
    _check_chains(found, reached)
    marked = found.join(reached.withColumn("record", F.lit(True)), ["file", "at"], "left")
    marked = marked.withColumn("start_at", F.when(F.col("record"), F.col("at")))
    # records in more than one piece, and the pieces that begin no record
    split = F.coalesce(F.col("record"), F.lit(False)) & (F.col("successor") <= F.col("ends") + 1)
    odd = _carried(marked, "start_at", F.max, "owner").where(~split).select(
        "file", "block", "seq", "at", F.coalesce("start_at", "owner").alias("owner"))
    odd = materialize(odd, "warc-parts")
    place = ["file", "block", "seq"]
    whole = cut.join(odd, place, "left_anti").select("value")
    parts = cut.join(odd, place).groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("parts"))
    joined = parts.select(F.array_join(F.col("parts.value"), CUT).alias("value"))  # as large as one record
    return _parsed(whole.unionByName(joined))


def _parsed(texts: DataFrame) -> DataFrame:
    head = _head(F.col("value"))
    rows = texts.select(head.alias("head"), F.col("value").cast("binary").alias("bytes"))
    rows = rows.withColumn("block", F.substr("bytes", F.octet_length("head") + len(END) + 1, _field(F.col("head"), "Content-Length").cast("int")))
    http = F.octet_length(_head(F.col("block").cast("string"))) + len(END) + 1
    is_http = F.lower(F.coalesce(_field(F.col("head"), "Content-Type"), F.lit(""))).startswith("application/http")
    payload = F.when(is_http, F.substr("block", http, F.octet_length("block"))).otherwise(F.col("block"))
    name = lambda n: _field(F.col("head"), n)
    return rows.select(
        name("WARC-Record-ID").alias("record_id"), name("WARC-Type").alias("type"), name("WARC-Target-URI").alias("url"),
        F.url_decode(name("X-Page-ID")).alias("key"), name("WARC-Refers-To").alias("refers_to"),
        name("WARC-Payload-Digest").alias("digest"), payload.alias("payload"))


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Writes ``pages`` as WARC files in the shared folder and describes what is read back.

    (key, payload_bytes, payload_digest, record_type, refers_to, verified): size and SHA-1 of the full
    payload, for a revisit those of the response it refers to; ``verified`` when the digest is that of the header.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write(pages, path, key=key, url=url, body=body)
    kind = pages.schema[key].dataType
    back = materialize(read(spark, path).select(
        "record_id", F.col("key").cast(kind).alias(key), "type", "refers_to", "digest",
        F.octet_length("payload").cast("long").alias("bytes"), F.sha1("payload").alias("sha1")), "warc-records")
    response = back.where("type = 'response'")
    response = response.join(back.select(F.col("refers_to").alias("record_id")).distinct(), "record_id", "left_semi").select(
        F.col("record_id").alias("refers_to"), F.col(key).alias("_of"), F.col("bytes").alias("_bytes"), F.col("sha1").alias("_sha1"))
    seen = F.col("type") == "revisit"
    full = back.join(response, "refers_to", "left").select(
        key, F.when(seen, F.col("_bytes")).otherwise(F.col("bytes")).alias("payload_bytes"),
        F.when(seen, F.col("_sha1")).otherwise(F.col("sha1")).alias("payload_digest"), F.col("type").alias("record_type"),
        F.col("_of").alias("refers_to"), "digest")
    return full.withColumn("verified", F.coalesce(F.col("digest") == F.concat(F.lit("sha1:"), "payload_digest"), F.lit(False))).drop("digest")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
     d AS (SELECT *, octet_length(encode(body)) AS n, max(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN n >= 1000 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND first <> page_id THEN first END AS refers_to, true AS verified
FROM d
"""
