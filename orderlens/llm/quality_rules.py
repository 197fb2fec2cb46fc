"""Operator 6: quality rules combined by weak supervision.

Base counts come from one pass over the whole texts, built from JVM functions only. Each rule
then votes good (1), bad (-1) or abstains (0) on every document. The rules' reliabilities are
not given: expectation-maximisation fits, for each rule, how often it votes bad on good and on
bad documents, and the share of good documents. A document is kept when its posterior
probability of being good is at least 0.5, so one reliable bad vote can outweigh several
weak good ones and no rule has a veto (unlike all-must-pass filtering).

The fit reads every document, as counts of vote patterns: at most 3 ** len(RULES) rows,
whatever the input's size. Each EM round is one aggregate over that table.

Defined cases: NULL or blank text has no words, fails the base rules and is not kept; equal
rows get equal results; an empty table gives an empty result; extra input columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import WORD, text_of, with_window_hashes

SYMBOLS = "[#*$%&|<>]"
CAPITALS = "[A-ZÄÖÜÀÂÇÉÈÊËÎÏÔÛÙÁÍÓÚÑ]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

RULES = ("symbols", "capitals", "shouts", "duplicate_lines", "repeats", "word_length", "function_words", "closed_lines")

# Frequent function words of English, German, French and Spanish.
FUNCTION_WORDS = """
a an and are as at be by for from have in is it not of on or that the this to was were which with you
als auch auf das dem den der des die ein eine für im ist mit nicht sich sie und von zu
au aux avec ce dans de des du elle en est et il la le les ne pas pour que qui sur un une
al con del el ella en es esta la las lo los más no para pero por que se su un una y
""".split()


def with_repeated_words(df: DataFrame, words: str, out: str, k: int = WINDOW) -> DataFrame:
    """Adds ``out``: words of the array column ``words`` in a ``k``-word window found twice or more in it.

    Windows are compared by 64-bit hash. Texts whose windows all differ stop after a hash-set
    test; only the others sort their windows. Each array is a column of its own, because an
    expression inside a lambda is evaluated again for every element.
    """
    windows, ranked = F.col("_windows"), F.col("_ranked")
    df = with_window_hashes(df, words, "_windows", k)
    df = df.withColumn("_ranked", F.when(
        F.size(F.array_distinct(windows)) < F.size(windows),
        F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))))
    same = lambda s, j: F.coalesce(F.get(ranked, j)["h"] == s["h"], F.lit(False))
    marked = F.transform(ranked, lambda s, j: F.when(same(s, j - 1) | same(s, j + 1), s["at"]))
    covered = F.aggregate(
        F.sort_array(F.filter(marked, lambda x: x.isNotNull())),
        F.struct(F.lit(0).alias("n"), F.lit(-k).alias("last")),
        lambda acc, at: F.struct((acc["n"] + F.least(F.lit(k), at - acc["last"])).alias("n"), at.alias("last")),
        lambda acc: acc["n"])
    return df.withColumn(out, F.coalesce(covered, F.lit(0)).cast("long")).drop("_windows", "_ranked")


def base_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the contract's counts plus those that only the votes need."""
    d = docs.select(key, text_of(text).alias("_t"))
    d = d.select(key, "_t", F.regexp_extract_all("_t", F.lit(WORD), F.lit(0)).alias("_w"),
                 F.filter(F.split("_t", "\n"), lambda x: x.rlike(WORD)).alias("_lines"))
    d = with_repeated_words(d, "_w", "n_repeat_words")
    t, w, lines = F.col("_t"), F.col("_w"), F.col("_lines")
    return d.select(
        key,
        F.size(w).cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0), lambda n, x: n + F.length(x)).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size(lines).alias("_n_lines"),
        F.regexp_count(t, F.lit(CAPITALS)).alias("_n_upper"),
        F.regexp_count(t, F.lit("[!?]")).alias("_n_shouts"),
        F.size(F.filter(w, lambda x: x.isin(FUNCTION_WORDS))).alias("_n_function"),
        F.size(F.filter(lines, lambda x: F.rtrim(x).rlike(r"""[.!?:;…"'”»)]$"""))).alias("_n_closed"))


def vote(value: Column, good: float, bad: float) -> Column:
    """1 up to ``good``, -1 from ``bad`` on, else 0; for ``good`` > ``bad`` the other way round."""
    low, high = (value <= good, value >= bad) if good < bad else (value >= good, value <= bad)
    return F.when(low, 1).when(high, -1).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes over the columns of ``base_counts``; a text without words is only voted down by length."""
    words, chars, lines = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1)), F.greatest("_n_lines", F.lit(1))
    mean = F.col("word_chars") / words
    votes = {
        "symbols": vote(F.col("n_symbols") / words, 0.02, 0.1),
        "capitals": vote(F.col("_n_upper") / chars, 0.12, 0.3),
        "shouts": vote(F.col("_n_shouts") / words, 0.1, 0.3),
        "duplicate_lines": vote(F.col("n_dup_lines") / lines, 0.1, 0.3),
        "repeats": vote(F.col("n_repeat_words") / words, 0.05, 0.15),
        "word_length": F.when(mean.between(3, 8), 1).when((mean < 2.5) | (mean > 10), -1).otherwise(0),
        "function_words": F.when(F.col("n_words") < MIN_WORDS, 0).otherwise(vote(F.col("_n_function") / words, 0.1, 0.03)),
        "closed_lines": F.when(F.col("n_words") < MIN_WORDS, 0).otherwise(vote(F.col("_n_closed") / lines, 0.5, 0.2)),
    }
    return {k: F.when(F.col("n_words") == 0, 0).otherwise(votes[k]).cast("tinyint") for k in RULES}


class Reliability:
    """Share of good documents and, for each rule, P(votes bad | class) given that it votes."""

    def __init__(self, good: float, bad_if_good: dict[str, float], bad_if_bad: dict[str, float]):
        self.good, self.bad_if_good, self.bad_if_bad = good, bad_if_good, bad_if_bad

    def posterior(self) -> Column:
        """P(good | votes) of a row with one column per rule."""
        logit = F.lit(math.log(self.good / (1 - self.good)))
        for r in self.bad_if_good:
            g, b = self.bad_if_good[r], self.bad_if_bad[r]
            logit = logit + F.when(F.col(f"v_{r}") == -1, math.log(g / b)).when(
                F.col(f"v_{r}") == 1, math.log((1 - g) / (1 - b))).otherwise(0.0)
        return 1 / (1 + F.exp(-logit))


def fit(patterns: DataFrame, names: tuple[str, ...] = RULES, rounds: int = 40, tolerance: float = 1e-4) -> Reliability:
    """EM over vote-pattern counts (columns ``v_<rule>`` and ``n``); starts with bad votes that are
    rare on good documents. Rates are smoothed by one vote each way, and a rule's bad votes may
    not become likelier on good documents than on bad ones (that would swap the classes)."""
    state = Reliability(0.8, dict.fromkeys(names, 0.05), dict.fromkeys(names, 0.4))
    for _ in range(rounds):
        p, n = F.col("p"), F.col("n")
        sums = [F.sum(n * p).alias("good"), F.sum(n).alias("all")]
        for r in names:
            v = F.col(f"v_{r}")
            sums += [F.sum(F.when(v == -1, n * p).otherwise(0.0)).alias(f"{r}_bg"),
                     F.sum(F.when(v != 0, n * p).otherwise(0.0)).alias(f"{r}_g"),
                     F.sum(F.when(v == -1, n * (1 - p)).otherwise(0.0)).alias(f"{r}_bb"),
                     F.sum(F.when(v != 0, n * (1 - p)).otherwise(0.0)).alias(f"{r}_b")]
        s = patterns.withColumn("p", state.posterior()).agg(*sums).first()
        if not s["all"]:
            return state
        g = {r: (s[f"{r}_bg"] + 1) / (s[f"{r}_g"] + 2) for r in names}
        b = {r: max((s[f"{r}_bb"] + 1) / (s[f"{r}_b"] + 2), g[r]) for r in names}
        new = Reliability(min(max(s["good"] / s["all"], 0.01), 0.99), g, b)
        moved = max([abs(new.good - state.good)] + [abs(g[r] - state.bad_if_good[r]) + abs(b[r] - state.bad_if_bad[r]) for r in names])
        state = new
        if moved < tolerance:
            break
    return state


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Base counts, ``base_failed``, ``kept`` and ``p_good`` of every document."""
    counts = materialize(base_counts(docs, key, text).select(
        "*", *[v.alias(f"v_{k}") for k, v in rules().items()]), "quality-votes")
    votes = [f"v_{r}" for r in RULES]
    patterns = materialize(counts.groupBy(*votes).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "vote-patterns")
    reliability = fit(patterns)
    p = reliability.posterior()
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counts.select(key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), (~failed & (p >= 0.5)).alias("kept"), F.round(p, 6).alias("p_good"))
