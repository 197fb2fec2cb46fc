"""Operator 10: benchmark decontamination by 13-word windows.

Benchmark items become normalised word windows. Every document is scanned once: each of its
windows is hashed and tested against a Bloom filter of the benchmark's window hashes (two bits a
window in a literal of 16 KB to 8 MB, so the scan needs no shuffle and emits no row per window; the
executors fill it). Of windows that are not in the benchmark 0.4 % pass up to 1.8 million
windows and 5 % with 7 million. Windows that pass are joined with the benchmark's by their words, which
verifies them. The join broadcasts the benchmark side while it is small (``BROADCAST_WINDOWS``);
beyond that it is a shuffled join that adaptive execution may split. Either way all cases are found.

Defined cases: NULL text has no words and is never contaminated; an item without words has no
window; a NULL item id counts as one item with the empty id; items sharing an id count once;
equal documents get equal rows; an empty benchmark leaves all documents clean; extra input
columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import few_places, text_of, with_place, with_window_hashes

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Runs of letters and digits; every character beyond ASCII counts as a letter.
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
CELLS_PER_WINDOW = 32
BITS = 7  # cells in a byte of the filter, so that each byte is an ASCII character
MIN_BYTES, MAX_BYTES = 1 << 14, 1 << 23  # of the filter; a fuller one only lets more windows through to the join
CHUNK = 1 << 12  # bytes of the filter that one group fills
BROADCAST_WINDOWS = 500_000


def item_words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(ITEM_WORD), F.lit(0))


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", k: int = WINDOW) -> DataFrame:
    """Distinct (item, len, words): all ``k``-word windows, or the whole of a shorter item."""
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), item_words(text_of(text)).alias("w"))
    items = items.where(F.size("w") > 0).withColumn("len", F.least(F.size("w"), F.lit(k)))
    windows = items.withColumn("pos", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1)))
    return windows.select("item", "len", F.array_join(F.slice("w", F.col("pos"), F.col("len")), " ").alias("words")).distinct()


def hashed(windows: DataFrame, lengths: list[int]) -> DataFrame:
    """Distinct window hashes, by the function that the scan of the documents uses."""
    windows = windows.select("len", "words").distinct().withColumn("w", F.split("words", " "))
    parts = [with_window_hashes(windows.where(F.col("len") == n), "w", "hashes", n).select(F.get("hashes", F.lit(0)).alias("hash"))
             for n in lengths]
    return reduce(DataFrame.unionByName, parts)


def cells_of(hash_: Column, size: int) -> list[tuple[Column, Column]]:
    """The two (byte, bit) places of a window hash in a filter of ``size`` bytes."""
    cells = [F.pmod(h, F.lit(size * BITS)) for h in (hash_, F.xxhash64(hash_))]
    return [(F.floor(c / BITS).cast("int"), F.pmod(c, F.lit(BITS)).cast("int")) for c in cells]


def bloom_filter(hashes: DataFrame, size: int) -> bytes:
    """``size`` bytes with the bits of all ``hashes`` set.

    Bits are gathered to bytes and bytes to chunks by two aggregates; the driver gets at most
    ``size / CHUNK`` chunks.
    """
    places = F.explode(F.array(*[F.struct(at.alias("at"), bit.alias("bit")) for at, bit in cells_of(F.col("hash"), size)]))
    filled = hashes.select(places.alias("p")).groupBy("p.at").agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("p.bit"))).alias("v"))
    byte = F.struct(F.pmod("at", F.lit(CHUNK)).alias("k"), F.lpad(F.hex("v"), 2, "0").alias("v"))
    chunk = filled.groupBy(F.floor(F.col("at") / CHUNK).cast("int").alias("chunk")).agg(F.map_from_entries(F.collect_list(byte)).alias("m"))
    digits = F.transform(F.sequence(F.lit(0), F.lit(CHUNK - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit("00")))
    out = bytearray(size)
    for r in chunk.select("chunk", F.unhex(F.array_join(digits, "")).alias("v")).toLocalIterator():
        out[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = r["v"]
    return bytes(out)


def may_hold(known: Column, hash_: Column, size: int) -> Column:
    """Whether the filter ``known`` has both bits of a hash; the second is read only where the first is set."""
    first, second = [F.getbit(F.ascii(F.substring(known, at + 1, F.lit(1)).cast("string")), bit) == 1 for at, bit in cells_of(hash_, size)]
    return F.when(first, second).otherwise(False)


def verified_hits(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                  k: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(all, hits): every document as (row, key, n_words), and (row, len, pos, item) per verified window.

    ``row`` numbers the documents; it is written with them, so later reads agree on it.
    """
    windows = materialize(benchmark_windows(benchmark, k=k), "benchmark-windows")
    sizes = {r["len"]: r["n"] for r in windows.groupBy("len").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most k rows
    size = MIN_BYTES
    while size < MAX_BYTES and size * BITS < CELLS_PER_WINDOW * sum(sizes.values()):
        size *= 2
    scan = docs.select(key, item_words(text_of(text)).alias("w"))
    scan = scan.withColumn("row", F.monotonically_increasing_id()).withColumn("found", F.array().cast("array<struct<len:int,pos:int,words:string>>"))
    if sizes:
        known = F.lit(bloom_filter(hashed(windows, sorted(sizes)), size))
        for n in sorted(sizes):
            scan = with_window_hashes(scan, "w", "hashes", n)

            def tested(h: Column, i: Column) -> Column:
                return F.when(may_hold(known, h, size), i)

            scan = scan.withColumn("at", F.filter(F.transform("hashes", tested), lambda i: i.isNotNull()))
            scan = scan.withColumn("found", F.when(F.size("at") > 0, F.concat("found", F.transform("at", lambda i: F.struct(
                F.lit(n).alias("len"), i.alias("pos"), F.array_join(F.slice("w", i + 1, F.lit(n)), " ").alias("words"))))
            ).otherwise(F.col("found"))).drop("hashes", "at")
    scan = materialize(scan.select("row", key, F.size("w").cast("long").alias("n_words"), "found"), "document-hits")
    found = scan.where(F.size("found") > 0).select("row", F.explode("found").alias("f")).select("row", "f.len", "f.pos", "f.words")
    listed = windows.select("words", "len", "item").distinct()
    if sum(sizes.values()) <= BROADCAST_WINDOWS:
        listed = F.broadcast(listed)
    return scan.select("row", key, "n_words"), found.join(listed, ["words", "len"]).select("row", "len", "pos", "item")


def covered(spans: Column) -> Column:
    """Number of positions in the union of (pos, len) structs."""
    return F.aggregate(
        F.sort_array(spans), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["pos"] + s["len"] - F.greatest(a["end"], s["pos"]))).alias("n"),
                              F.greatest(a["end"], s["pos"] + s["len"]).alias("end")),
        lambda a: a["n"])


def judged(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", k: int = WINDOW) -> DataFrame:
    """Contract columns for every document plus ``row`` (its number in this call)."""
    every, hits = verified_hits(docs, benchmark, key, text, k)
    per_doc = hits.groupBy("row").agg(covered(F.collect_set(F.struct("pos", "len"))).cast("long").alias("n_hit"),
                                      F.sort_array(F.collect_set("item")).alias("items"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return every.join(per_doc, "row", "left").select(
        "row", key, "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join(items, ","), "UTF-8"), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Contamination report: one row per document."""
    return judged(docs, benchmark, key, text).drop("row")


def clean_documents(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The uncontaminated documents, with all their columns. Decisions are joined back by place."""
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = with_place(docs, "decontaminated", F.col(text).cast("string").alias("text"), doc)
    told = judged(rows.select(F.col("row").alias("place"), "text"), benchmark, "place", "text")
    bad = materialize(told.where("contaminated").select(F.col("place").alias("row")), "contaminated")
    return rows.select("doc", "row").join(few_places(bad), "row", "left_anti").select("doc.*")


def without_spans(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, cut): the texts with every hit word, and the separator after it, cut out."""
    numbered = materialize(docs.select(F.monotonically_increasing_id().alias("_row"), key, text_of(text).alias("_t")), "numbered")
    every, hits = verified_hits(numbered, benchmark, "_row", "_t")
    at = F.flatten(F.collect_set(F.sequence("pos", F.col("pos") + F.col("len") - 1)))
    cuts = every.join(hits, "row").groupBy("_row").agg(F.array_distinct(at).alias("_at"))
    raw_word = ITEM_WORD.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")
    j = numbered.join(cuts, "_row", "left").withColumn("_w", F.regexp_extract_all("_t", F.lit(raw_word), F.lit(0)))
    j = j.withColumn("_gap", F.split("_t", raw_word, -1))
    left = F.array_except(F.sequence(F.lit(0), F.size("_w") - 1), "_at")  # a text with hits has words
    kept = F.transform(left, lambda i: F.concat(F.get("_w", i), F.get("_gap", i + 1)))
    cut = F.concat(F.get("_gap", F.lit(0)), F.array_join(kept, ""))
    return j.select(key, F.when(F.col("_at").isNull(), F.col("_t")).otherwise(cut).alias(text),
                    F.coalesce(F.size("_at"), F.lit(0)).cast("long").alias("cut"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS s
      FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
k AS (SELECT DISTINCT n FROM g),
x AS (SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
      FROM (SELECT r, w, k.n, unnest(range(1, CAST(len(w) - k.n + 2 AS BIGINT))) AS i FROM d, k WHERE len(w) >= k.n)),
h AS (SELECT x.r, x.i, x.n, g.item FROM x JOIN g USING (s, n)),
p AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS q FROM (SELECT DISTINCT r, i, n FROM h)) GROUP BY r),
t AS (SELECT r, list_sort(list(DISTINCT item)) AS items FROM h GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN t USING (r)
"""
