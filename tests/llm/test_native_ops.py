"""Operators 4, 6, 7 and 10 against plain Python versions and on odd inputs."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import decontaminate, mixing, quality_rules, sharding
from orderlens.llm.common import table

from . import brute
from .conftest import DOC, SF

LONG = " ".join(f"w{i % 700}" for i in range(30_000))
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "a b c d e f g h a b c d e f g h"), (4, "a b c d e f g h a b c d e f g h"),
       (5, "x " * 40), (None, "one two three"), (None, None), (6, LONG), (7, "ñandú 日本 語 𝔘nicode 𝔘"), (8, "l1 w\nl1 w\n\nl1 w")]


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_base_counts(spark, make):
    docs = make(ODD)
    got = quality_rules.judge(docs)
    assert got.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    have = sorted(((r["doc_id"], *[r[f] for f in fields]) for r in rows(got)), key=repr)
    assert have == sorted(((d, *brute.base_counts(t)) for d, t in ODD), key=repr)
    for r in rows(got):
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_base_counts_on_documents(spark):
    docs = table(spark, SF, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rows(quality_rules.base_counts(docs)):
        assert brute.base_counts(texts[r["doc_id"]]) == (
            r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])


def test_rules_agree_with_labels(spark):
    """Held against labels that the rules never see."""
    kept = quality_rules.judge(table(spark, "/root/testdata/sf0.01", "documents"))
    both = kept.where("not base_failed").join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id")
    n, right = both.selectExpr("count(*)", "sum(int(kept = (quality = 1)))").first()
    assert right >= 0.98 * n


def test_em_recovers_reliabilities(spark):
    """Three independent rules over a known mixture."""
    rng = np.random.default_rng(0)
    good = rng.random(20_000) < 0.7
    cols = {}
    for name, bg, bb in (("a", 0.02, 0.6), ("b", 0.05, 0.4), ("c", 0.1, 0.7)):
        cols[f"v_{name}"] = np.where(rng.random(20_000) < np.where(good, bg, bb), -1, 1)
    import pandas as pd
    counts = pd.DataFrame(cols).value_counts().rename("n").reset_index()
    fit = quality_rules.fit(spark.createDataFrame(counts).cache(), ("a", "b", "c"), rounds=60)
    assert abs(fit.good - 0.7) < 0.05 and abs(fit.bad_if_bad["c"] - 0.7) < 0.07 and fit.bad_if_good["a"] < 0.06


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOC)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert quality_rules.judge(empty).count() == 0
    assert sharding.shard_documents(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert mixing.mixed_documents(empty).count() == 0
    assert decontaminate.decontaminate(empty, bench).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [(r["n_words"], r["contaminated"]) for r in rows(decontaminate.decontaminate(one, bench))] == [(2, False)]


def test_shards(spark, make):
    docs = make(ODD)
    got = rows(sharding.shard_documents(docs))
    assert len(got) == len(ODD)
    assert sorted((r["size"], r["text_crc32"]) for r in got) == sorted(
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in ODD)
    by_key = {}
    for r in got:
        by_key.setdefault(r["doc_id"], set()).add((r["shard"], r["grown_shard"]))
        assert 0 <= r["shard"] < 8 and r["grown_shard"] in (r["shard"], 8) and r["law"] == "key"
    assert all(len(v) == 1 for v in by_key.values())
    for s in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    full = sharding.with_shards(docs)
    assert set(docs.columns) <= set(full.columns) and full.count() == len(ODD)


def test_weighted_shards_move_little(spark):
    ids = spark.range(20_000).select(F.col("id").alias("doc_id"))
    key = F.concat(F.lit("k:"), F.col("doc_id").cast("string"))
    both = ids.select(sharding.rendezvous(key, [1, 2, 1]).alias("a"), sharding.rendezvous(key, [1, 2, 1, 4]).alias("b"))
    counts = {(r["a"], r["b"]): r["count"] for r in both.groupBy("a", "b").count().collect()}
    assert all(a == b or b == 3 for a, b in counts)
    share = {s: sum(n for (a, _), n in counts.items() if a == s) / 20_000 for s in range(3)}
    assert abs(share[1] - 0.5) < 0.02 and abs(share[0] - 0.25) < 0.02
    with pytest.raises(ValueError):
        sharding.rendezvous(key, [1, 0])


ITEMS = [(1, "The quick brown fox jumps over the lazy dog and then runs away home again today"), (2, "Short item"), (3, None),
         (4, "!!!"), (None, "wholly unnamed benchmark item of eleven words is this one here ok"), (10, "Short item"),
         (5, "naïve Élan 日本 " * 6)]


def test_contamination(spark, make):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    quick = ITEMS[0][1]
    docs = [(1, f"prefix {quick.upper()} suffix"), (2, "a short, ITEM indeed " + "pad " * 100), (3, None), (4, ""), (5, LONG),
            (6, " ".join(quick.split()[:13])), (7, " ".join(quick.split()[:12])), (8, f"{quick} {quick}"), (8, f"{quick} {quick}"),
            (None, ITEMS[4][1]), (9, "naïve Élan 日本 " * 7), (11, "naïve élan 日本 " * 7)]
    got = decontaminate.decontaminate(make(docs), bench)
    fields = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted(((r["doc_id"], *[r[f] for f in fields]) for r in rows(got)), key=repr) == sorted(
        ((d, *brute.contamination(t, ITEMS)) for d, t in docs), key=repr)
    clean = decontaminate.clean_documents(make(docs), bench)
    assert clean.columns == make(docs).columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in rows(clean)) == sorted(
        (d or 0, t or "") for d, t in docs if not brute.contamination(t, ITEMS)[4])
    cut = {r["doc_id"]: r for r in rows(decontaminate.without_spans(make(docs, extra=False), bench))}
    assert cut[1]["text"] == "prefix suffix" and cut[7]["text"] == docs[6][1] and cut[6]["cut"] == 13


def test_contamination_without_broadcast(spark, make, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    monkeypatch.setattr(decontaminate, "MAX_BYTES", decontaminate.MIN_BYTES)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = rows(decontaminate.decontaminate(make([(1, ITEMS[0][1])]), bench))
    assert got[0]["contaminated"] and got[0]["n_hit"] == 16


def test_mix(spark, make):
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(["w"] * int(rng.integers(0, 60))), f"s{i % 5}") for i in range(600)]
    docs += [(1000 + i, "tiny one", "a") for i in range(3)] + [(None, "null id here", "s1")] * 4 + [(2000, None, "s2"), (2001, "no source", None)]
    df = make([d[:2] + (d[2],) for d in docs]).selectExpr("*").replace("zz", "zz")
    got = rows(mixing.mix(df))
    assert len(got) == len(docs)
    sizes, taken, target = {}, {}, {}
    for r in got:
        s = r["source"]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        target[s] = r["target"]
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
    expected = brute.mix_targets(sizes)
    for s in sizes:
        assert abs(target[s] - expected[s]) < 1e-6 * max(1, expected[s])
        assert abs(taken[s] - target[s]) <= max(3, 0.01 * target[s]), s
    again = rows(mixing.mix(df))
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r["copies"] for r in got)


def test_mix_rates_are_the_dual_solution(spark, make):
    """Rates equal exp(lambda * size / mean) with the multiplier that numpy finds by bisection."""
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(["w"] * int(n)), f"s{i % 2}") for i, n in enumerate(rng.integers(1, 200, 400))]
    got = rows(mixing.mix(make(docs)))
    for s in ("s0", "s1"):
        mine = [r for r in got if r["source"] == s]
        size = np.array([r["size"] for r in mine], float)
        low, high = -50.0, 50.0
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if (size * np.minimum(3, np.exp(np.clip(mid * size / size.mean(), -700, 10)))).sum() < mine[0]["target"] else (low, mid)
        rates = np.minimum(3, np.exp(low * size / size.mean()))
        assert np.allclose([r["rate"] for r in mine], rates, atol=1e-3)


def test_no_python_on_the_main_path(spark):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    for df in (quality_rules.base_counts(docs), sharding.shard_documents(docs), mixing.mix(docs), decontaminate.decontaminate(docs, bench)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"))


def test_bloom_filter_of_the_benchmark(spark):
    """Every hash of the benchmark passes, and few others; the filter is the one plain Python builds."""
    size = decontaminate.MIN_BYTES
    hashes = spark.range(3000).select(F.xxhash64("id").alias("hash"))
    known = decontaminate.bloom_filter(hashes, size)
    cells = hashes.select(*[c.alias(f"c{i}") for i, (at, bit) in enumerate(decontaminate.cells_of(F.col("hash"), size))
                            for c in (at * decontaminate.BITS + bit,)]).collect()
    plain = bytearray(size)
    for r in cells:
        for c in r:
            plain[c // decontaminate.BITS] |= 1 << c % decontaminate.BITS
    assert known == bytes(plain) and max(known) < 128
    test = spark.range(60_000).select("id", decontaminate.may_hold(F.lit(known), F.xxhash64("id"), size).alias("maybe"))
    got = {r["maybe"]: r["n"] for r in test.where("id >= 3000").groupBy("maybe").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert test.where("id < 3000 AND NOT maybe").count() == 0
    assert 0 < got[True] < 0.01 * sum(got.values())
    assert decontaminate.bloom_filter(hashes.where("hash IS NULL"), size) == bytes(size)
