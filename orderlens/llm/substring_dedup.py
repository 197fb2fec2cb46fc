"""Operator 1: substring dedup by line hashing.

A unit is a piece of text that has a letter or digit: with ``unit="clause"`` (the query) a
sentence within a line or a part of one that ends in a comma, colon or semicolon, with
``unit="sentence"`` a sentence, with ``unit="line"`` a whole line. Units are normalised (lower
case; every run of other characters than letters and digits becomes one space) and hashed to 128
bits. Over the whole table the occurrence with the least (key, place, position) is the one that
stays; all others are repeats, within one document as well. Neighbouring repeats join into runs,
and runs of ``min_words`` words or more are removed (``LEAST`` by unit: 25 words of clauses, so
that list numbers, abbreviations, names and stock phrases stay; one word of sentences; 50 words
of lines). A repeated passage of over 50 words holds such a run unless its few clauses are very
long. Neighbours with the same keeper share a span, and a line that loses all its units goes with
its line break. Spans keep their offsets in the original text, in characters.

Digests are counted by their first half in one hash aggregate, so a unit that a third of all
documents share is one row per task before the shuffle. Digests seen once leave the table before
the keepers are found and the occurrences are joined back; these joins are plain ones between
written tables, whose large partitions adaptive execution splits. Both Python steps are written
in small batches, so a worker holds a thousand texts at most, however large its partition is.

Defined cases: NULL and empty texts have no units and never change; documents with a NULL key
rank last; rows with an equal key rank by their place; an empty table gives an empty result;
extra columns are ignored (``deduplicated`` keeps them).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import small_batches, with_place

LEAST = {"line": 50, "sentence": 1, "clause": 25}  # words of a run that is removed
OTHER = re.compile(r"[\W_]+")
STOP = re.compile(r"""[.!?\u2026\u061f\u0964]+["'\u00bb\u201d\u2019)\]]*\s+|[\u3002\uff01\uff1f]+""")  # ends of sentences

CLAUSE = re.compile(STOP.pattern.replace("[.!?", "[.!?,;:", 1).replace(r"\uff1f]+", r"\uff1f\uff0c\u3001]+"))
SAYS = re.compile(r"[^\W_]")

# ``keeper`` is an index into the row's list of repeats
CUT = "spans array<struct<start:bigint,end:bigint,words:bigint,keeper:int>>, cut string"


def normalised(line: str) -> str:
    return OTHER.sub(" ", line.lower()).strip()


def pieces_of(line: str, unit: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the clauses or sentences of a line, which cover it."""
    at = 0
    for m in (CLAUSE if unit == "clause" else STOP).finditer(line):
        yield at, m.end()
        at = m.end()
    if at < len(line):
        yield at, len(line)


def units_of(text: str, unit: str) -> Iterator[str]:
    """The normalised units in order; empty ones are pieces without a letter or digit."""
    for line in text.split("\n"):
        if unit == "line":
            yield normalised(line)
        else:
            for start, end in pieces_of(line, unit):
                yield normalised(line[start:end])


def digest_column(unit: str) -> Column:
    """(at, words, a, b): arrays of the places, word counts and both digest halves of a text's units that are not empty."""
    @F.pandas_udf("at array<int>, words array<int>, a array<long>, b array<long>")
    def digests(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            found = [(at, u) for at, u in enumerate(units_of(text or "", unit)) if u]
            raw = b"".join(xxhash.xxh3_128_digest(u.encode("utf-8", "surrogatepass")) for _, u in found)
            half = np.frombuffer(raw, "<i8").reshape(-1, 2)
            words = np.array([u.count(" ") + 1 for _, u in found], np.int32)
            out.append((np.array([at for at, _ in found], np.int32), words, half[:, 0].copy(), half[:, 1].copy()))
        return pd.DataFrame(out, columns=["at", "words", "a", "b"])

    return digests("text")


def spans_of(text: str, repeats: dict[int, int], min_words: int) -> list[tuple[int, int, int, int]]:
    """(start, end, words, first row) of the runs of repeated lines with ``min_words`` or more.

    ``repeats`` maps line numbers to the row that keeps the line. Lines without a unit belong to
    a run that goes on after them. A span covers its last line's separator, or, at the end of
    the text, the one before its first line.
    """
    out, run, start, words, first, at = [], [], 0, 0, None, 0
    lines = text.split("\n")

    def close() -> None:
        if words >= min_words:
            end = run[-1][1]
            out.append((start, end + 1, words, first) if end < len(text) else (max(start - 1, 0), end, words, first))

    for i, line in enumerate(lines):
        end = at + len(line)
        if i in repeats:
            if not run:
                start, words, first = at, 0, repeats[i]
            run.append((at, end))
            words += len(normalised(line).split(" "))
        elif run and normalised(line):
            close()
            run = []
        at = end + 1
    if run:
        close()
    return out


def without(text: str, spans: list[tuple[int, int]]) -> str:
    out, at = [], 0
    for start, end in spans:
        out.append(text[at:start])
        at = max(at, end)
    return "".join(out) + text[at:]


def piece_spans(text: str, unit: str, repeats: dict[int, int], counts: list[int], keepers: list[int], min_words: int) -> list[tuple[int, int, int, int]]:
    """(start, end, words, index of the first repeat) of the stretches of repeats with one keeper.

    ``repeats`` maps the numbers of clauses or sentences to indexes into ``counts`` (words) and
    ``keepers``. Lines of repeats alone go with their line break; where a line keeps something, its
    line break stays.
    """
    lines, run, gone, words, at, n = [], [], set(), 0, 0, 0
    for line in text.split("\n"):
        pieces = []  # (start, end, number, whether it is a unit)
        for start, end in pieces_of(line, unit):
            says = n in repeats or SAYS.search(line, start, end) is not None
            pieces.append((at + start, at + end, n, says))
            if n in repeats:
                run.append(n)
                words += counts[repeats[n]]
            elif says:
                if words >= min_words:
                    gone.update(run)
                run, words = [], 0
            n += 1
        lines.append((at, at + len(line), pieces))
        at += len(line) + 1
    if words >= min_words:
        gone.update(run)

    out: list[list[int]] = []

    def add(start: int, end: int, index: int) -> None:
        if out and out[-1][1] == start and keepers[out[-1][3]] == keepers[index]:
            out[-1][1], out[-1][2] = end, out[-1][2] + counts[index]
        else:
            out.append([start, end, counts[index], index])

    for first, end, pieces in lines:
        hit = [p for p in pieces if p[2] in gone]
        whole = bool(hit) and len(hit) == sum(p[3] for p in pieces)
        for i, p in enumerate(hit):
            if whole:  # the line's other characters go with its units
                add(first if i == 0 else p[0], hit[i + 1][0] if i + 1 < len(hit) else min(end + 1, len(text)), repeats[p[2]])
            else:
                add(p[0], p[1], repeats[p[2]])
    if out and out[-1][1] == len(text) and not text.endswith("\n") and (start := out[-1][0]) and text[start - 1] == "\n" and (len(out) < 2 or out[-2][1] < start):
        out[-1][0] -= 1
    return [tuple(s) for s in out]


def cut_column(unit: str, min_words: int) -> Column:
    """The removed spans of a text and what remains of it."""
    @F.pandas_udf(CUT)
    def cut(texts: pd.Series, ats: pd.Series, counts: pd.Series, keepers: pd.Series) -> pd.DataFrame:
        out = []
        for t, a, c, k in zip(texts, ats, counts, keepers):
            found = {at: i for i, at in enumerate(a.tolist())}
            spans = spans_of(t, found, min_words) if unit == "line" else piece_spans(t, unit, found, c.tolist(), k.tolist(), min_words)
            out.append(([dict(zip(("start", "end", "words", "keeper"), s)) for s in spans], without(t, [s[:2] for s in spans])))
        return pd.DataFrame(out, columns=["spans", "cut"])

    return cut("text", "ats", "counts", "keepers")


def repeats(rows: DataFrame, unit: str) -> DataFrame:
    """(row, at, words, first_key, keeper) of every unit that is not the first of its digest; ``keeper`` hashes the row that keeps it."""
    units = rows.select("row", "key", digest_column(unit).alias("d")).select("row", "key", F.explode(F.arrays_zip("d.at", "d.words", "d.a", "d.b")).alias("u"))
    with small_batches(rows.sparkSession):
        units = materialize(units.select("row", "key", "u.at", "u.words", "u.a", "u.b"), "units")
    often = materialize(units.groupBy("a").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("a"), "often")
    again = materialize(units.join(often, "a", "left_semi"), "again")
    groups = again.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct(F.col("key").isNull().alias("none"), "key", "row", "at")).alias("first"))
    groups = materialize(groups.where("c > 1").select("a", "b", "first"), "groups")
    found = again.join(groups, ["a", "b"]).where((F.col("row") != F.col("first.row")) | (F.col("at") != F.col("first.at")))
    return found.select("row", "at", "words", F.col("first.key").alias("first_key"), F.xxhash64("first.row").alias("keeper"))


def _rows(docs: DataFrame, key: str, text: str, *more: Column) -> DataFrame:
    return with_place(docs, "documents", F.col(key).alias("key"), F.col(text).cast("string").alias("text"), *more)


def _edits(rows: DataFrame, unit: str, min_words: int) -> DataFrame:
    """(row, key, r, spans, cut) of the rows that lose text; ``r`` lists their repeats."""
    per_row = repeats(rows, unit).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("at", "words", "first_key", "keeper"))).alias("r"), F.sum("words").alias("n"))
    # rows with fewer repeated words hold no run that goes
    hit = rows.select("row", "key", "text").join(per_row.where(F.col("n") >= min_words).drop("n"), "row")
    hit = hit.withColumns({"ats": F.col("r.at"), "counts": F.col("r.words"), "keepers": F.col("r.keeper")}).withColumn("x", cut_column(unit, min_words))
    with small_batches(rows.sparkSession):
        return materialize(hit.select("row", "key", "r", "x.spans", "x.cut").where(F.size("spans") > 0), "edits")


def edits(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int | None = None, unit: str = "line") -> DataFrame:
    """One row per document that loses text: (key, first keys, removed spans, removed words, remaining text)."""
    first = lambda s: F.get("r", s["keeper"])["first_key"]
    removed = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), first(s).alias(f"first_{key}")))
    return _edits(_rows(docs, key, text), unit, LEAST[unit] if min_words is None else min_words).select(
        F.col("key").alias(key), F.array_sort(F.array_distinct(F.transform("spans", first))).alias(f"first_{key}s"),
        removed.alias("removed"), F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["words"]).alias("removed_words"),
        F.col("cut").alias(text))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int | None = None, unit: str = "line") -> DataFrame:
    """All rows and columns of ``docs`` with repeated spans cut from the text."""
    rows = _rows(docs, key, text, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    out = rows.join(_edits(rows, unit, LEAST[unit] if min_words is None else min_words).select("row", "cut"), "row", "left")
    return out.select(*[F.coalesce("cut", "text").alias(c) if c == text else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
