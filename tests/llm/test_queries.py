"""Registered queries of the subpackage: SQL twins, and the pipeline against brute force."""

import hashlib

import duckdb
import pytest

import corpus_pipeline
from orderlens.llm import queries

from . import brute
from .conftest import SF


def canon(tbl):
    names = sorted(tbl.column_names)
    rows = sorted(repr(tuple(r[n] for n in names)) for r in tbl.select(names).to_pylist())
    return names, len(rows), hashlib.sha256("\n".join(rows).encode()).hexdigest()


@pytest.mark.parametrize("key", sorted(queries.SQL))
def test_matches_duckdb(spark, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert canon(queries.QUERIES[key](spark, SF).toArrow()) == canon(con.sql(queries.SQL[key]).to_arrow_table())


def test_one_query_per_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "near-dedup", "decontamination", "source mix", "sharding"]


def test_pipeline_stage_by_stage(spark):
    """Each stage on the rows that the one before kept, against plain Python versions."""
    from orderlens.llm import quality_cnn
    from orderlens.llm.common import table
    from orderlens.session import materialize
    docs = materialize(table(spark, SF, "documents"), "test-documents")
    columns = docs.columns
    stage = dict(corpus_pipeline.STAGES)
    texts = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}

    good = materialize(stage["quality classifier"](spark, docs, SF), "test-good")
    scored = quality_cnn.classify(docs, table(spark, SF, "labels"))
    assert set(texts(good)) == {r["doc_id"] for r in scored.where("predicted = 1").collect()} and good.columns == columns

    alone = materialize(stage["near-dedup"](spark, good, SF), "test-alone")
    have = sorted(texts(good).items())
    group = brute.near_groups([t for _, t in have])
    assert set(texts(alone)) == {have[g][0] for g in set(group.values())} and alone.columns == columns

    clean = materialize(stage["decontamination"](spark, alone, SF), "test-clean")
    items = [tuple(r) for r in table(spark, SF, "benchmark", "item_id", "text").collect()]
    assert set(texts(clean)) == {d for d, t in texts(alone).items() if not brute.contamination(t, items)[4]}

    mixed = materialize(stage["source mix"](spark, clean, SF), "test-mixed")
    assert mixed.columns == columns
    size = {r["doc_id"]: len(brute.WORD.findall(r["text"] or "")) for r in clean.collect()}
    by_source, taken = {}, {}
    for r in clean.collect():
        by_source[r["source"]] = by_source.get(r["source"], 0) + size[r["doc_id"]]
    for r in mixed.collect():
        taken[r["source"]] = taken.get(r["source"], 0) + size[r["doc_id"]]
    for s, target in brute.mix_targets(by_source).items():
        least = min(size[r["doc_id"]] for r in clean.collect() if r["source"] == s and size[r["doc_id"]])  # whole copies of about seven documents
        assert abs(taken.get(s, 0) - target) <= max(least, 0.05 * target), s
    assert mixed.groupBy("doc_id").count().where("count > 3").count() == 0

    final = stage["sharding"](spark, mixed, SF)
    assert final.columns[:5] == columns and final.count() == mixed.count()
    for r in final.groupBy("shard").agg({"slot": "max", "*": "count"}).collect():
        assert r["max(slot)"] + 1 == r["count(1)"]


def test_run_agrees_with_its_stages(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
