"""Long texts in pieces, components, and columns whose names clash with helpers."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import components, decontaminate, quality_cnn, sharding


@pytest.mark.parametrize("halves", [2, 3, 1024])
def test_scores_in_pieces_equal_the_whole_forward_pass(monkeypatch, halves):
    monkeypatch.setattr(quality_cnn, "PIECE", halves)
    r = random.Random(1)
    model = quality_cnn.Model.start(np.random.default_rng(3))
    for n in (0, 1, 8, 9, 255, 256, 257, 513, 5000, 30_000):
        text = quality_cnn.Text.of("".join(r.choice("abcde fgh.") for _ in range(n)))
        assert abs(model.score(text) - model.forward([text])[0][0]) < 1e-6


def union_find(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


def test_components_equal_union_find(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(60)]
    edges += [(-7, 900 + i) for i in range(100)] + [(500, 500)]  # a hub that a third of the links share
    got = {x["node"]: x["component"] for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == union_find(edges)


def test_clean_documents_keep_every_column(spark):
    words = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, words, "mine", "a"), (2, "fine text", "mine", "b"), (2, "fine text", "mine", "b"), (3, None, None, None)],
                                 "doc_id long, text string, _digest string, row string")
    bench = spark.createDataFrame([("i", words)], "item_id string, text string")
    out = sorted(map(tuple, decontaminate.clean_documents(docs, bench).collect()))
    assert out == [(2, "fine text", "mine", "b"), (2, "fine text", "mine", "b"), (3, None, None, None)]


def test_slots_of_a_key_with_a_third_of_the_rows(spark):
    docs = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"),
                                   F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    out = sharding.shard_documents(docs).collect()
    assert len(out) == 900 and len({r["shard"] for r in out if r["doc_id"] == 7}) == 1
    for s in range(8):
        slots = sorted(r["slot"] for r in out if r["shard"] == s)
        assert slots == list(range(len(slots)))


def _unit_components(spark, sets):
    import numpy as np
    from orderlens.llm import near_dedup as N
    from orderlens.llm.components import components
    data = [(7, i, len(s), np.array(sorted(s), np.uint64).tobytes()) for i, s in enumerate(sets)]
    rows = spark.createDataFrame(data, "unit long, node long, n long, data binary")
    found = {r.node: r.component for r in components(N._by_unit(rows, N._verified)).collect()}
    return [found.get(i, i) for i in range(len(sets))]


def _brute_components(sets):
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


def test_large_unit_links_across_blocks(spark, monkeypatch):
    """Chains, several clusters and single bridges between blocks: no link is lost."""
    import random
    from orderlens.llm import near_dedup
    monkeypatch.setattr(near_dedup, "BLOCK_NODES", 9)
    rng = random.Random(3)
    chain = [set(range(4 * i, 4 * i + 40)) for i in range(60)]  # only neighbours are linked
    star = [set(range(1000, 1040)) - {1000 + i % 40} | {2000 + i} for i in range(50)]
    far = [set(rng.sample(range(5000, 9000), 30)) for _ in range(20)]
    bridge = [set(range(1000, 1020)) | set(range(3000, 3020)), set(range(1000, 1022)) | set(range(3000, 3020))]
    sets = chain + star + far + bridge
    rng.shuffle(sets)
    assert _unit_components(spark, sets) == _brute_components(sets)


def test_op1_workers_get_small_batches(spark, monkeypatch):
    """Both Python steps of the substring dedup run within small batches of whole texts."""
    from orderlens.llm import substring_dedup as SD
    seen, write = {}, SD.materialize
    monkeypatch.setattr(SD, "materialize", lambda df, name, *a: seen.update({name: int(df.sparkSession.conf.get(
        "spark.sql.execution.arrow.maxRecordsPerBatch"))}) or write(df, name, *a))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    line = "a passage of some words, "
    docs = spark.createDataFrame([(i, line * 9 + str(i)) for i in range(3)], "doc_id long, text string")
    assert SD.edits(docs, unit="clause").count() > 0
    assert seen["units"] <= 1000 and seen["edits"] <= 1000
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
