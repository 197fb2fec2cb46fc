"""Operator 4: mixing sources to target weights by entropy balancing.

Sources in code point order weigh 1, 2, 3, repeating, and share all words; no target exceeds
``MOST`` times its source's size (the excess goes to the others by weight). Among all rates
between 0 and ``MOST`` whose words meet the targets, the mix takes those closest to "every
document once" in relative entropy. Their dual has one multiplier per source, and the rates
are exponentially tilted: ``rate = min(MOST, exp(lambda * size / mean size))``. Safeguarded
Newton iterations find the multipliers; each is one aggregate over (source, size) counts,
and every multiplier stays in a DataFrame with its source.

Rates become whole copies: everyone takes the whole part, and one more copy goes to documents
in the order of ``u - fraction`` (``u`` a uniform number from a digest of key and text) until the
target's words are reached. The cut is found from running sums over 2 ** 16 buckets of that
order, then inside one bucket, so no task sorts a whole source. A few documents that still
fit then fill up what is left of the target.

Defined cases: a NULL source is a source of its own, last in order; NULL text has no words and
is taken as it is (0 words); documents with a NULL id draw by their text; equal rows share size
and source and may differ in copies; an empty table gives an empty result; extra
columns are ignored (or carried along by ``mixed_documents``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .common import PLACE, key_text, n_words, text_of, unit_from_md5, with_place

MOST = 3
WEIGHTS = 3  # 1, 2, ... WEIGHTS, repeating
BUCKETS = 1 << 16
FILL_ROUNDS = 8
OVERSTEP = 0.01  # share of a target by which the document at the cut may overstep it
TOLERANCE = 0.25  # words by which a source's expected words may miss its target


def source_key(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("s:"), F.col(source).cast("string")), F.lit("n"))


def targets(sources: DataFrame) -> DataFrame:
    """(src, source_size, target) from one row per source (src, source, source_size).

    The water level is the greatest of the levels reached by capping the first i sources in
    the order of size per weight; the windows run over one row per source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighed = sources.withColumn("w", ((rank - 1) % WEIGHTS + 1).cast("double")).withColumn("cap", F.col("source_size") * float(MOST))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), "src")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    levelled = weighed.withColumn("level", level).withColumn("level", F.max("level").over(Window.partitionBy()))
    return levelled.select("src", "source_size", F.least(F.col("w") * F.col("level"), "cap").alias("target"))


def rate(size: Column, mean: Column, multiplier: Column) -> Column:
    """The tilted rate of a document; 1 for empty documents and sources."""
    tilt = F.coalesce(multiplier * size / mean, F.lit(0.0))
    return F.least(F.lit(float(MOST)), F.exp(F.least(tilt, F.lit(math.log(MOST) + 1))))


def multipliers(counts: DataFrame, goals: DataFrame, rounds: int = 60) -> DataFrame:
    """``goals`` (src, source_size, target) plus mean and multiplier, from (src, size, n) counts."""
    shape = counts.where("size > 0").groupBy("src").agg(F.sum("n").alias("filled"), F.min("size").alias("smallest"))
    state = goals.join(shape, "src", "left").withColumn("mean", F.col("source_size") / F.col("filled"))
    x = F.col("smallest") / F.col("mean")
    state = materialize(state.select(
        "src", "source_size", "target", "mean", F.lit(0.0).alias("multiplier"),
        F.least(F.lit(0.0), F.ln(F.greatest(F.col("target") / F.col("source_size"), F.lit(1e-300))) / x).alias("low"),
        (F.lit(math.log(MOST)) / x).alias("high"), F.lit(None).cast("double").alias("miss")), "mix-state")
    for _ in range(rounds):
        at = counts.where("size > 0").join(state.select("src", "mean", "multiplier"), "src")
        r = rate(F.col("size"), F.col("mean"), F.col("multiplier"))
        words = F.col("n") * F.col("size") * r
        slope = F.when(r < MOST, words * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = at.groupBy("src").agg(F.sum(words).alias("words"), F.sum(slope).alias("slope"))
        moved = state.drop("miss").join(sums, "src", "left").withColumn("miss", F.col("words") - F.col("target"))
        moved = moved.withColumn("low", F.when(F.col("miss") < 0, F.col("multiplier")).otherwise(F.col("low")))
        moved = moved.withColumn("high", F.when(F.col("miss") > 0, F.col("multiplier")).otherwise(F.col("high")))
        newton = F.col("multiplier") - F.col("miss") / F.nullif(F.col("slope"), F.lit(0.0))
        middle = (F.col("low") + F.col("high")) / 2
        step = F.when(newton.between(F.col("low"), F.col("high")), newton).otherwise(middle)
        done = F.abs("miss") <= TOLERANCE
        moved = moved.withColumn("multiplier", F.when(F.col("miss").isNull() | done, F.col("multiplier")).otherwise(step))
        state = materialize(moved.select("src", "source_size", "target", "mean", "multiplier", "low", "high", "miss"), "mix-state")
        if (state.agg(F.max(F.abs("miss"))).first()[0] or 0.0) <= TOLERANCE:
            break
    # rounded, since the last bits depend on the order in which tasks' sums meet
    return state.select("src", "source_size", "target", "mean", F.round("multiplier", 9).alias("multiplier"))


def placed(rows: DataFrame) -> DataFrame:
    """Rows (row, src, u, size) joined with their source's plan: adds rate, whole, order and bucket."""
    r = rate(F.col("size"), F.col("mean"), F.col("multiplier"))
    d = rows.withColumn("rate", r).withColumn("whole", F.floor(F.col("rate") + 1e-9).cast("long"))
    d = d.withColumn("order", F.col("u") - F.greatest(F.col("rate") - F.col("whole"), F.lit(0.0)))
    return d.withColumn("bucket", F.floor((F.col("order") + 1) * (BUCKETS // 2)).cast("int"))


def extra() -> Column:
    """Copies beyond the whole part for a placed row joined with its source's cut (bigint)."""
    first = F.col("cut_bucket").isNull() | (F.col("bucket") < F.col("cut_bucket")) | (
        (F.col("bucket") == F.col("cut_bucket")) & F.coalesce(F.struct("order", "size", "row") <= F.col("cut_at"), F.lit(False)))
    filled = F.size(F.filter("fills", lambda row: row == F.col("row")))
    return ((F.col("whole") < MOST) & first).cast("long") + filled


def cuts(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` plus cut_bucket, cut_at and fills: who takes one more copy in each source."""
    d = materialize(placed(rows.join(plan, "src")), "mix-placed")
    whole = d.groupBy("src").agg(F.sum(F.col("size") * F.col("whole")).alias("base"))
    # whole words, so that the last bits of a target decide nothing
    need = plan.join(whole, "src").select("src", F.round(F.col("target") - F.col("base")).cast("long").alias("need"))
    open_ = d.where(F.col("whole") < MOST)
    sums = open_.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    sums = sums.withColumn("upto", upto).join(need, "src").where("upto > need")
    cut = sums.groupBy("src").agg(F.min(F.struct("bucket", F.expr("upto - words").alias("before"), "need")).alias("c"))
    cut = materialize(cut.select("src", F.col("c.bucket").alias("cut_bucket"), "c.before", "c.need"), "mix-cuts")
    inside = open_.select("src", "bucket", "order", "row", "size").join(
        cut, (open_["src"] == cut["src"]) & (open_["bucket"] == cut["cut_bucket"])).drop(cut["src"])
    run = F.sum("size").over(Window.partitionBy("src").orderBy("order", "size", "row").rowsBetween(Window.unboundedPreceding, 0))
    inside = inside.withColumn("run", F.col("before") + run)
    at = F.struct("order", "size", "row")
    last = inside.groupBy("src").agg(F.max(F.when(F.col("run") <= F.col("need"), at)).alias("last"),
                                     F.max(F.when(F.col("run") <= F.col("need"), F.col("run"))).alias("run"),
                                     F.min(F.when(F.col("run") > F.col("need"), F.struct(at, "run", "size"))).alias("next"))
    out = plan.join(cut, "src", "left").join(last, "src", "left").withColumn("fills", F.array().cast(f"array<{PLACE}>"))
    # the document at the cut is taken too where it oversteps the target by little
    over = F.col("next.run") - F.col("need")
    step = F.coalesce((2 * over <= F.col("next.size")) & (over <= OVERSTEP * F.col("target")), F.lit(False))
    out = out.withColumn("cut_at", F.when(step, F.col("next.col1")).otherwise(F.col("last")))
    out = out.withColumn("left", F.when(step, 0).otherwise(F.col("need") - F.coalesce("run", "before")))
    out = out.drop("before", "need", "run", "last", "next")
    out = materialize(out, "mix-plan")
    for _ in range(FILL_ROUNDS):
        cols = out.drop("fill", "source_size", "target", "mean", "multiplier")
        fits = d.join(cols, "src").withColumn("copies", F.col("whole") + extra())
        fits = fits.where((F.col("copies") < MOST) & (F.col("size") > 0) & (F.col("size") <= F.col("left")))
        # the largest that fits, among documents that the cut left out if any of them fits
        best = fits.groupBy("src").agg(F.max(F.struct(F.col("copies") <= F.col("whole"), "size", "u", "row")).alias("fill"))
        out = out.join(best, "src", "left")
        out = out.withColumn("fills", F.when(F.col("fill").isNull(), F.col("fills")).otherwise(F.array_append("fills", F.col("fill.row"))))
        more = F.coalesce(F.max(F.col("fill").isNotNull()), F.lit(False))
        out = materialize(out.withColumn("left", F.col("left") - F.coalesce("fill.size", F.lit(0))), "mix-plan")
        if not out.agg(more).first()[0]:
            break
        out = out.drop("fill")
    return out.drop("fill")


def mix_plan(rows: DataFrame) -> DataFrame:
    """Per-source plan for rows (row, src, source, u, size)."""
    counts = materialize(rows.groupBy("src", "source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    sources = counts.groupBy("src", "source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    return cuts(rows.drop("source"), multipliers(counts, targets(sources)))


def numbered(docs: DataFrame, key: str, source: str, text: str, *more: Column) -> DataFrame:
    """Rows (key, source, src, size, row, u and ``more``); rows without a key draw by their text.

    ``row`` only tells apart rows that agree in all that the result shows, so reruns agree.
    """
    d = with_place(docs, "mix-documents", F.col(key).alias("key"), F.col(source).cast("string").alias("source"),
                   source_key(source).alias("src"), n_words(text_of(text)).alias("size"),
                   F.when(F.col(key).isNull(), F.concat(F.lit("n|"), F.md5(F.encode(text_of(text), "UTF-8"))))
                   .otherwise(F.concat_ws("|", key_text(key), F.crc32(F.encode(text_of(text), "UTF-8")))).alias("own"), *more)
    # by key and text, so that different texts of one key spread over the buckets
    return d.withColumn("u", unit_from_md5(F.md5(F.concat(F.lit("mix|"), F.col("own"))))).drop("own")


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(key, size, source_size, target, taken, source, rate, copies) for every document."""
    rows = materialize(numbered(docs, key, source, text), "mix-rows")
    out = placed(rows.join(mix_plan(rows.drop("key")), "src")).withColumn("copies", F.col("whole") + extra())
    return out.select(F.col("key").alias(key), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                      "source", "rate", "copies")


def mixed_documents(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mix itself: every document's row as often as it is taken, with the columns of ``docs``."""
    kept = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = numbered(docs, key, source, text, kept)
    slim = materialize(rows.drop("doc"), "mix-rows")
    out = placed(rows.join(mix_plan(slim.drop("key")), "src")).withColumn("copies", F.col("whole") + extra())
    copies = out.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.nullif("copies", F.lit(0))))).select("doc.*")
    return copies
