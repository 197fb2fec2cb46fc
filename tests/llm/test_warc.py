"""Operator 13: round trips, sequential reading, and archives inside payloads."""

import glob
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from orderlens.llm import warc
from orderlens.llm.common import table

from .conftest import SF

PAGES = "page_id long, url string, html string"


def sequential(path):
    """[(headers, block)] of every record, read byte by byte from each file's start."""
    out = []
    for f in sorted(glob.glob(f"{path}/part-*")):
        data, at = open(f, "rb").read(), 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at)
            first, *lines = data[at:end].decode().split("\r\n")
            assert first == "WARC/1.1"
            head = dict(x.split(": ", 1) for x in lines)
            n = int(head["Content-Length"])
            assert data[end + 4 + n:end + 8 + n] == b"\r\n\r\n"
            out.append((head, data[end + 4:end + 4 + n]))
            at = end + 8 + n
    return out


def expected(rows):
    """(page_id, bytes, digest, type, refers_to) per row."""
    out, first = [], {}
    for i, (page, _, html) in enumerate(rows):
        body = (html or "").encode()
        rank = (page is not None, page or 0)
        if len(body) >= 1000:
            first[body] = max(first.get(body, (rank, i)), (rank, i))
    keep = {i for _, i in first.values()}
    for i, (page, _, html) in enumerate(rows):
        body = (html or "").encode()
        again = len(body) >= 1000 and i not in keep
        out.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response",
                    rows[first[body][1]][0] if again else None))
    return sorted(out, key=repr)


def result(df):
    out = df.collect()
    assert all(r["verified"] for r in out)
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out), key=repr)


def hostile():
    """Pages whose payloads hold magic, headers, whole archives and blank lines."""
    inner = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    long = "x" * 1500
    huge = "WARC/1.1\r\nContent-Length: 9223372036854775807\r\n\r\n"
    bodies = [inner, "\r\n\r\n" + inner, "\n" + inner * 3, "\nWARC/1.\nWARC/1.", "WARC/1.1\r\n", "\nWARC/1.1\r\nContent-Length: 4",
              huge, "\n" + huge, "\nWARC/1.WARC/1.1\r\nContent-Length: 0\r\n\r\n", "\r\n", "\n", "", None, long, long + "é", long + "\n" + inner,
              "\nWARC/1.1\r\nContent-Length: 0\r\n\r\n" * 50, "é \x00\x85" * 400, "HTTP/1.1 200 OK\r\n\r\nagain"]
    rows = [(i, f"http://e.example/{i}", b) for i, b in enumerate(bodies)]
    rows += [(900 + i, None, long) for i in range(30)] + [(901, "u", long), (901, "u", long), (None, "n", long), (None, "n", None)]
    rows += [(950, "", "short"), (951, "a\r\nWARC-Type: evil", "short"), (-5, "neg", long + "é")]
    return rows


@pytest.mark.parametrize("split", [None, 50_000, 1500, 333, 64])
def test_round_trip_of_hostile_pages(spark, split):
    rows = hostile()
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES + ", type string, row string").repartition(3)
    if split is None:
        assert result(warc.round_trip(df)) == expected(rows)
        return
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        assert result(warc.round_trip(df)) == expected(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_files_read_sequentially_and_payloads_come_back(spark, tmp_path):
    rows = hostile()
    path = str(tmp_path / "warc")
    warc.write(spark.createDataFrame(rows, PAGES).repartition(4), path)
    found = sequential(path)
    assert len(found) == len(rows) and len({h["WARC-Record-ID"] for h, _ in found}) == len(rows)
    for head, block in found:
        assert head["WARC-Payload-Digest"].startswith("sha1:") and block.startswith(b"HTTP/1.1 200 OK\r\n")
    back = {r["record_id"]: r for r in warc.read(spark, path).collect()}
    for head, block in found:
        r = back[head["WARC-Record-ID"]]
        assert bytes(r["payload"]) == block.split(b"\r\n\r\n", 1)[1]
        assert (r["type"], r["url"], r["refers_to"]) == (head["WARC-Type"], head.get("WARC-Target-URI"), head.get("WARC-Refers-To"))
        if r["type"] == "revisit":
            assert head["WARC-Refers-To"] in back and not r["payload"]


def test_rows_of_the_given_table(spark):
    pages = table(spark, SF, "pages")
    assert result(warc.round_trip(pages)) == expected([(r["page_id"], r["url"], r["html"]) for r in pages.collect()])


def test_a_third_of_the_rows_share_one_payload(spark):
    pages = spark.range(900).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(
        F.col("id") % 3 == 0, F.lit("same " * 300)).otherwise(F.concat(F.lit("own "), F.col("id").cast("string"))).alias("html"))
    out = warc.round_trip(pages).groupBy("record_type", "refers_to").count().collect()
    assert {(r["record_type"], r["refers_to"], r["count"]) for r in out} == {("response", None, 601), ("revisit", 897, 299)}


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("harm", ["cut", "shift", "start"])
def test_broken_archives_are_refused(spark, tmp_path, harm):
    warc.write(spark.createDataFrame([(i, "u", "text " * i) for i in range(20)], PAGES).coalesce(1), str(tmp_path / "w"))
    (f,) = glob.glob(str(tmp_path / "w" / "part-*"))
    data = open(f, "rb").read()
    data = {"cut": data[:-30], "shift": data.replace(b"text text \r\n", b"text \r\n", 1), "start": b"junk" + data}[harm]
    os.makedirs(tmp_path / "b")
    open(tmp_path / "b" / "a.warc", "wb").write(data)
    with pytest.raises(ValueError, match="no whole record at byte"):
        warc.read(spark, str(tmp_path / "b")).count()


def test_foreign_archives(spark, tmp_path):
    """Version 1.0, records that are no HTTP messages, header names in other cases, a repeated header."""
    block = b"GET / HTTP/1.0\r\n\r\n"
    data = (b"WARC/1.0\r\nWARC-Type: warcinfo\r\ncontent-length: 7\r\nWARC-Concurrent-To: <a>\r\nWARC-Concurrent-To: <b>\r\n\r\nformat!\r\n\r\n"
            + b"WARC/1.1\r\nWARC-Type:request\r\nContent-Type: application/http;msgtype=request\r\nContent-Length: %d\r\n\r\n" % len(block)
            + block + b"\r\n\r\n")
    open(tmp_path / "a.warc", "wb").write(data)
    out = {r["type"]: bytes(r["payload"]) for r in warc.read(spark, str(tmp_path)).collect()}
    assert out == {"warcinfo": b"format!", "request": b""}
