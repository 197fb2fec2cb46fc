"""Operators 1, 2, 3, 5, 8 and 9 against plain Python versions and on odd inputs."""

import html
import random

import numpy as np
import pytest

from orderlens.llm import chat, licenses, main_text, near_dedup, quality_cnn, substring_dedup
from orderlens.llm.common import table
from orderlens.llm.components import components

from . import brute
from .conftest import DOC, SF

LONG = " ".join(f"w{i % 700}x{i // 900}" for i in range(30_000))


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def words(seed, n):
    r = random.Random(seed)
    return [f"{r.choice('bcdfgh')}{r.randrange(5000)}" for _ in range(n)]


def edited(base, k, seed):
    r = random.Random(seed)
    out = list(base)
    for i in r.sample(range(len(out)), k):
        out[i] = f"edit{seed}-{i}"
    return " ".join(out)


# --- near duplicates -----------------------------------------------------------------------

@pytest.fixture(scope="module")
def near_docs():
    base, other = words(1, 160), words(2, 60)
    docs = [edited(base, k, 10 + k) for k in range(0, 14)] + [edited(base, k, 50 + k) for k in range(0, 9)]
    docs += [edited(other, k, 90 + k) for k in range(4)] + [" ".join(other).upper(), "  " + "\n".join(other)]
    docs += [None, "", " \t ", "a b", "A  b", "a b c", LONG, LONG + " more", LONG] + [" ".join(words(100 + i, 30)) for i in range(20)]
    return docs


def expected_near(ids, docs):
    group = brute.near_groups(docs)
    least = {}
    for i, g in group.items():
        least[g] = min((x for x in (least.get(g), ids[i]) if x is not None), default=None)
    return [(d, len(brute.shingle_set(t)), least[group[i]] if brute.shingle_set(t) else d) for i, (d, t) in enumerate(zip(ids, docs))]


def test_near_duplicates(make, near_docs):
    ids = [3 * i for i in range(len(near_docs))]
    random.Random(4).shuffle(ids)
    got = rows(near_dedup.near_duplicates(make(list(zip(ids, near_docs)))))
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(expected_near(ids, near_docs))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_in_many_blocks(make, near_docs, monkeypatch):
    """Every bucket and family is cut into blocks; the groups must not change."""
    monkeypatch.setattr(near_dedup, "BLOCK_NODES", 3)
    ids = list(range(len(near_docs)))
    got = rows(near_dedup.near_duplicates(make(list(zip(ids, near_docs)), extra=False)))
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(expected_near(ids, near_docs))


def test_near_duplicates_null_and_repeated_ids(make, near_docs):
    text = near_docs[0]
    docs = [(None, text), (None, near_docs[1]), (None, None), (7, text), (7, text), (9, ""), (None, "only one here now")]
    got = rows(near_dedup.near_duplicates(make(docs)))
    assert sorted((repr(r["doc_id"]), repr(r["component_id"]), r["kept"]) for r in got) == sorted(
        [("None", "7", False)] * 2 + [("None", "None", True)] * 2 + [("7", "7", True)] * 2 + [("9", "9", True)])
    kept = rows(near_dedup.unique_documents(make(docs)))
    assert sorted(repr(r["doc_id"]) for r in kept) == ["7", "9", "None", "None"]


def test_near_duplicates_empty(spark):
    assert near_dedup.near_duplicates(spark.createDataFrame([], DOC)).count() == 0
    assert near_dedup.unique_documents(spark.createDataFrame([], DOC)).count() == 0


def test_sketch_estimates_and_merges():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = pool[:2000], pool[500:2500]  # similarity 0.6
    ra, rb = near_dedup.registers(a), near_dedup.registers(b)
    assert (np.maximum(ra, rb) == near_dedup.registers(np.union1d(a, b))).all()
    grid = np.linspace(0, 1, 201)
    up, down = (ra > rb).sum(), (ra < rb).sum()
    best = grid[np.argmax(near_dedup.log_likelihood(grid, np.float64(0.5), up, down, len(ra) - up - down))]
    assert abs(best - 0.6) < 0.12
    near = np.concatenate([pool[:1900], pool[2900:]])
    assert near_dedup.plausible(ra, len(a), near_dedup.registers(near)[None], np.array([len(near)]))[0]
    far = pool[1900:2900]
    assert not near_dedup.plausible(ra, len(a), near_dedup.registers(far)[None], np.array([len(far)]))[0]


def test_exact_intersections():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 6000, n).astype(np.uint64)) for n in (10, 4000, 5500, 1, 300)]
    got = near_dedup.intersections(sets)
    assert all(got[i, j] == len(np.intersect1d(a, b)) for i, a in enumerate(sets) for j, b in enumerate(sets) if i != j)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 300), (300, 200), (7, 7), (41, 40), (500, 500)]
    got = {r["node"]: r["component"] for r in rows(components(spark.createDataFrame(chain, "a long, b long")))}
    assert got == {**{i: 0 for i in range(42)}, 100: 100, 200: 100, 300: 100, 500: 500}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- classifier ----------------------------------------------------------------------------

def test_classifier_on_held_out_rows(spark):
    d = "/root/testdata/sf0.1"
    got = quality_cnn.classify(table(spark, d, "documents"), table(spark, d, "labels"))
    assert got.dtypes[1:] == [("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    both = got.where("held_out").join(table(spark, d, "labels"), "doc_id")
    n, right, lost, good = both.selectExpr("count(*)", "sum(int(predicted = quality))", "sum(int(quality = 1 and predicted = 0))",
                                           "sum(quality)").first()
    assert right >= 0.98 * n and lost <= 0.01 * good


def test_classifier_odd_rows(spark, make):
    import zlib
    bad, good = "BUY!! NOW!! " * 30, " ".join(words(5, 80))
    docs = [(i, bad if i % 2 else good + f" {i}") for i in range(120)] + [(500, None), (501, ""), (502, LONG), (None, good), (3, bad)]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(120)] + [(None, 1), (5, None), (900, 0), (3, 0)], "doc_id long, quality int")
    got = rows(quality_cnn.classify(make(docs), labels))
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    right = [r["predicted"] == 1 - r["doc_id"] % 2 for r in got if r["doc_id"] is not None and r["doc_id"] < 120]
    assert sum(right) >= 0.97 * len(right)
    again = rows(quality_cnn.classify(make(docs), labels))
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    none = rows(quality_cnn.classify(make(docs), labels.limit(0)))
    assert {r["score"] for r in none} == {0.5}
    assert quality_cnn.classify(spark.createDataFrame([], DOC), labels).count() == 0
    assert quality_cnn.good_documents(make(docs), make(docs), labels).columns == make(docs).columns


def test_held_out_labels_are_not_learned(spark, make):
    docs = make([(i, f"text {i}") for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    import zlib
    ids = {r["doc_id"] for r in rows(quality_cnn.labelled_sample(docs, labels))}
    assert ids == {i for i in range(200) if zlib.crc32(str(i).encode()) % 5}
    assert quality_cnn.labelled_sample(docs, labels, per_class=10).count() == 20


def test_repeated_labelled_documents_leave_room_for_the_others(spark, make):
    docs = make([(i, f"text {i}") for i in range(400)] + [(i, f"copy {i} {j}") for i in (1, 2, 3, 4) for j in range(200)] + [(600, "x" * 70_000)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(900)], "doc_id long, quality int")
    got = rows(quality_cnn.labelled_sample(docs, labels, per_class=20))
    assert sorted(r["y"] for r in got) == [0] * 20 + [1] * 20 and len({r["doc_id"] for r in got}) == 40
    every = rows(quality_cnn.labelled_sample(docs, labels, per_class=1000))
    assert len(every) == len({r["doc_id"] for r in every}) and {1, 2, 3, 4} & {r["doc_id"] for r in every}


def test_gradients():
    """Numeric derivatives of the loss for a few weights of each layer."""
    rng = np.random.default_rng(0)
    model = quality_cnn.Model.start(rng)
    texts = [quality_cnn.Text.of(" ".join(words(i, 150))) for i in range(3)] + [quality_cnn.Text.of(""), quality_cnn.Text.of("ab")]
    y = np.array([1, 0, 1, 0, 1], np.float32)
    for name in ("embed", "first", "second", "shift", "hidden", "hidden_shift", "out", "out_shift"):
        setattr(model, name, getattr(model, name).astype(np.float64))
    model.shift += 0.1
    model.hidden_shift += 0.1

    def loss():
        p, _ = model.forward(texts)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    p, state = model.forward(texts)
    for name, g in zip(("embed", "first", "second", "shift", "hidden", "hidden_shift", "out", "out_shift"), model.gradients(y, p, state)):
        w = getattr(model, name)
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        keep, step = w[at], 1e-4
        w[at] = keep + step
        up = loss()
        w[at] = keep - step
        down = loss()
        w[at] = keep
        assert abs((up - down) / (2 * step) - g[at]) < 0.05 * abs(g[at]) + 1e-4, name


# --- main text -----------------------------------------------------------------------------

def article_text(page):
    """The article of the test pages, whose markup is regular."""
    import re
    body = page.split("<article>", 1)[1].split("</article>")[0].replace("<br>", " ")
    blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
    return "\n".join(b for b in blocks if b)


def test_main_text(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    got = rows(main_text.extract(pages.selectExpr("*", "'x' AS text", "1 AS n_chars")))
    assert len(got) == len(source)
    assert all(r["text"] == article_text(source[r["page_id"]]) and r["n_chars"] == len(r["text"]) for r in got)


PAGES = [
    (None, ""), ("", ""), ("no markup &amp; one block", "no markup & one block"),
    ("<body><nav><a href='/'>Home</a></nav><div class=content><h1>T</h1><p>One two three four five six.</p><div class='share'>Share it"
     "</div><p>Seven&nbsp;eight &lt;b&gt;.</p></div><div id='comments'><p>First! Great post by all of you.</p></div><footer>f</footer>",
     "T\nOne two three four five six.\nSeven eight <b>."),
    ("<main><p>a<b>b</b>c<br>d</p><form><input>name</form><script>if (a<b) x('<p>no</p>')</script><style>p{}</style><!-- <p>no</p> -->"
     "<ul><li>x y</li><li>z</li></ul></main><aside>side side side</aside>", "abc d\nx y\nz"),
    ("<article><p>Unclosed <i>one<p>Two<div class='ad'>buy buy</div><p>Three</article><p>out out out</p>", "Unclosed one\nTwo\nThree"),
    ("<nav>menu<article><h2>Inside</h2><p>an unclosed menu</p></article>", "Inside\nan unclosed menu"),
    ("<article title='a > b'><p>x &amp;amp; y &#233; &#x41;</p><noscript>js</noscript><section id=comments>c</section></article>", "x &amp; y é A"),
    ("<div><p>" + "long text " * 50_000 + "</p></div>", ("long text " * 50_000).strip()),
]


def test_main_text_of_odd_pages(spark):
    df = spark.createDataFrame([(i, f"u{i}", p) for i, (p, _) in enumerate(PAGES)], "page_id long, url string, html string")
    labelled = table(spark, SF, "pages").selectExpr("page_id + 1000 AS page_id", "url", "html")  # pages to learn from
    got = {r["page_id"]: r["text"] for r in rows(main_text.extract(df.union(labelled)))}
    for i, (_, want) in enumerate(PAGES):
        assert got[i] == want, i
    assert main_text.extract(df.limit(0)).count() == 0


MARKED = [
    ("<article><header class='entry-header'><h1>Head line</h1></header><p>One two three four.</p><section id='discussion'><h2 id='related-work'>"
     "Prior art</h2><p>Five six seven.</p></section><h2 id='search-and-rescue'>Sea</h2><p class='warning'>Mind the gap.</p>"
     "<div class='share-price'>Ten euros</div><div class='share-buttons'>Share it</div><section id='comments'>First!</section></article>",
     "Head line\nOne two three four.\nPrior art\nFive six seven.\nSea\nMind the gap.\nTen euros"),
    ("<body><form id='aspnetForm'><input><div class='menu'>Home</div><article><h1>T</h1><p>One two three.</p></article></form></body>", "T\nOne two three."),
    ("<body><form><input><p>" + "some long story " * 20 + "</p></form></body>", ("some long story " * 20).strip()),
    ("<main><h1>Story</h1><p>" + "the whole long story " * 20 + "</p></main><div><article class='card'><a href='/1'>Other one</a><p>A short card."
     "</p></article><article class='card'><p>Another card.</p></article></div>", "Story\n" + ("the whole long story " * 20).strip()),
    ("<main><h1>Head</h1><p>A lead.</p><article><p>" + "the text itself " * 10 + "</p></article></main>", "Head\nA lead.\n" + ("the text itself " * 10).strip()),
    ("<article><p>" + "part one " * 20 + "</p></article><div>" + "between " * 90 + "</div><article><p>" + "part two " * 20 + "</p></article>",
     ("part one " * 20).strip() + "\n" + ("part two " * 20).strip()),
]


@pytest.mark.parametrize("page, want", MARKED)
def test_marked_pages_keep_their_text(page, want):
    assert main_text.main_text(page, main_text.weights(main_text.example_weights())) == want


def test_best_region_is_maximal():
    """The linear scan against all contiguous regions."""
    rng = random.Random(7)
    weight = {"word:plain": 1.0, "word:noise": -1.5, "word:link": -0.7, "tag:p": -0.4, "tag:div": -1.1}
    for _ in range(200):
        found = [main_text.Run("w " * rng.randrange(1, 5), rng.random() < 0.3, False, rng.random() < 0.3, "",
                               rng.choices(["p", "div"], k=rng.randrange(4))) for _ in range(rng.randrange(1, 9))]
        word = [max(len(r.text.split()) * weight[f"word:{main_text.context(r, False)}"], -main_text.ASIDE if r.noise else -99) for r in found]
        tag = [sum(weight[f"tag:{t}"] for t in r.tags) for r in found]
        best = max([0.0] + [word[s] + sum(word[i] + tag[i] for i in range(s + 1, e)) for s in range(len(found)) for e in range(s + 1, len(found) + 1)])
        s, e = main_text.best_region(found, False, weight)
        have = word[s] + sum(word[i] + tag[i] for i in range(s + 1, e)) if e > s else 0.0
        assert have >= best - 1e-9 or abs(have - best) < 1e-9


# --- chat ----------------------------------------------------------------------------------

def conversation_table(spark, convs):
    data = [(c, i, "user" if i % 2 == 0 else "assistant", t) for c, turns in convs for i, t in enumerate(turns)]
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string")


def test_chat_collapse(spark):
    convs = [(1, "ab"), (2, "abcd"), (3, "abcd"), (4, "abx"), (5, "a"), (6, "xabcd"), (7, "q"), (8, "q"), (9, "abcde" * 500), (10, "bc")]
    df = conversation_table(spark, convs).selectExpr("*", "'x' AS at", "1 AS block")
    got = {r["conv_id"]: r for r in rows(chat.format_conversations(df))}
    distinct = {}
    for c, t in convs:
        distinct.setdefault(t, []).append(c)
    want = {min(ids): (len(t), len(ids)) for t, ids in distinct.items() if not any(u != t and u.startswith(t) for u in distinct)}
    assert {c: (r["n_turns"], r["n_copies"]) for c, r in got.items()} == want
    assert got[4]["text"] == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n<|im_start|>user\nx<|im_end|>"


def test_chat_blocks_agree(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 2)
    got = {r["conv_id"]: r["n_turns"] for r in rows(chat.format_conversations(conversation_table(spark, [(1, "abcde"), (2, "abcdefg"), (3, "abcdf")])))}
    assert got == {2: 7, 3: 5}


def test_chat_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    data = [(None, 0, "user", "x"), (None, 0, "user", "x"), (None, 1, None, None), (1, None, "user", "late"), (1, 0, "user", "x"),
            (1, 0, "user", "x"), (2, 0, "", "x"), (3, 0, None, "x")]
    got = rows(chat.format_conversations(spark.createDataFrame(data, schema)))
    assert sorted((repr(r["conv_id"]), r["n_turns"], r["n_copies"]) for r in got) == [
        ("1", 3, 1), ("2", 1, 1), ("3", 1, 1), ("None", 1, 1)]
    assert chat.format_conversations(spark.createDataFrame([], schema)).count() == 0


# --- substring dedup -----------------------------------------------------------------------

def test_substring_dedup(spark, make):
    passage, parts = " ".join(words(9, 60)), [" ".join(words(20 + i, 20)) for i in range(3)]
    long_line = " ".join(words(30, 20_000))
    docs = [(5, f"intro five\n{passage}\nend five"), (2, f"{passage.upper()}!\nalone two"), (3, "\n".join(["own three", *parts])),
            (4, "\n".join([parts[0], "", parts[1] + ".", parts[2], "tail"])), (6, parts[0]), (7, None), (8, ""), (9, f"{passage}\n{passage}"),
            (None, passage), (10, long_line), (11, f"é {long_line}"), (12, long_line), (10, long_line)]
    got = {}
    for r in rows(substring_dedup.edits(make(docs))):
        got.setdefault(r["doc_id"], []).append(r)
    assert set(got) == {5, 4, 9, None, 12, 10}
    assert got[5][0]["text"] == "intro five\nend five" and got[5][0]["first_doc_ids"] == [2]
    start, end = got[5][0]["removed"][0]["start"], got[5][0]["removed"][0]["end"]
    assert docs[0][1][start:end] == passage + "\n"
    assert got[4][0]["text"] == "tail" and got[9][0]["text"] == "" and got[12][0]["text"] == "" and len(got[10]) == 1
    whole = rows(substring_dedup.deduplicated(make(docs)))
    assert len(whole) == len(docs) and list(whole[0]) == make(docs).columns
    assert sorted(r["text"] for r in whole if r["doc_id"] in (2, 3, 6)) == sorted([docs[1][1], docs[2][1], docs[4][1]])
    assert [r["text"] for r in whole if r["doc_id"] == 7] == [None]
    assert substring_dedup.edits(spark.createDataFrame([], DOC)).count() == 0


def test_substring_dedup_on_documents(spark):
    docs = table(spark, SF, "documents")
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    first, want = {}, {}
    for d in sorted(text):
        for at, line in enumerate(text[d].split("\n")):
            if u := substring_dedup.normalised(line):
                first.setdefault(u, (d, at))
    for d, t in text.items():
        rep = {at: first[u][0] for at, line in enumerate(t.split("\n")) if (u := substring_dedup.normalised(line)) and first[u] != (d, at)}
        if s := substring_dedup.spans_of(t, rep, 50):
            want[d] = substring_dedup.without(t, [x[:2] for x in s])
    assert {r["doc_id"]: r["text"] for r in rows(substring_dedup.edits(docs))} == want


def test_every_repeated_sentence_goes(spark, make):
    """Short repeats, repeats inside lines and passages that a near copy's edit breaks up."""
    lines = [f"The first {i} says {' '.join(words(40 + i, 9))}. Then {' '.join(words(60 + i, 9))}!" for i in range(4)]
    near = [x.replace("Then", "Then edited", 1) if i == 2 else x for i, x in enumerate(lines)]
    docs = [(1, "\n".join(lines)), (2, "Own start. " + " ".join(near) + " Own end."), (3, "Yes.\nown three"), (4, "own four\nyes\n"),
            (5, f"Mine. {lines[0]}\nown five"), (6, "\n".join([lines[0], "own six", lines[1]])), (7, None), (None, "Yes!"), (8, "again. Again. x")]
    got = {r["doc_id"]: r for r in rows(substring_dedup.edits(make(docs), unit="sentence"))}
    kept = near[2].split(". ", 1)[1]
    assert {d: r["text"] for d, r in got.items()} == {
        2: f"Own start. {kept} Own end.", 4: "own four\n", 5: "Mine. \nown five", 6: "own six", None: "", 8: "again. x"}
    assert got[2]["first_doc_ids"] == [1] and got[4]["first_doc_ids"] == [3] and got[8]["first_doc_ids"] == [8]
    text = dict(docs)
    for d, r in got.items():
        assert substring_dedup.without(text[d], [(s["start"], s["end"]) for s in r["removed"]]) == r["text"]
    whole = rows(substring_dedup.deduplicated(make(docs), unit="sentence"))
    assert sorted(repr(r["text"]) for r in whole) == sorted(repr(got[d]["text"] if d in got else t) for d, t in docs)


def test_clauses_in_short_runs_stay(spark, make):
    """Numbers, initials, abbreviations and stock phrases are repeats of few words; long runs of clauses go."""
    a, b, c = (" ".join(words(70 + i, 9)) for i in range(3))
    docs = [(1, f"1. First item\n2. Dr. J. Smith, of course.\nYes.\n{a}, {b}; then {c}."), (2, "1. Other item\n2. Another item, of course.\nYes.\nDr. Jones"),
            (3, f"Own three, and {a.upper()}: so {b}. {a}, {b}! {a}; 1. ({b}) own end"), (4, f"{a}, {b}; then {c}"), (5, f"{a}, {b} own five"),
            (6, f"x\n{a},\n--\n{b};\nthen {c}.\ny"), (7, None), (8, ""), (None, f"{a}, {b}, then {c}")]
    got = {r["doc_id"]: r for r in rows(substring_dedup.edits(make(docs), unit="clause"))}
    assert {d: r["text"] for d, r in got.items()} == {3: f"Own three, and {a.upper()}: so {b}. ({b}) own end", 4: "", 6: "x\n--\ny", None: ""}
    assert got[4]["removed_words"] == 28 and got[4]["first_doc_ids"] == [1] and got[6]["first_doc_ids"] == [1]
    text = dict(docs)
    assert all(substring_dedup.without(text[d], [(s["start"], s["end"]) for s in r["removed"]]) == r["text"] for d, r in got.items())


def plain_edits(docs, least=25):
    """What the registered query returns, by characters: a document's text without the runs of repeated clauses."""
    import re
    first, units, out = {}, {}, {}
    for d in sorted(docs):
        units[d] = []
        for m in re.finditer(r"[^\n]*(?:\n|$)", docs[d] or ""):
            line = m[0].rstrip("\n")
            cuts = [0] + [x.end() for x in re.finditer(r"""[.!?,;:…؟।]+["'»”’)\]]*\s+|[。！？，、]+""", line)] + [len(line)]
            for s, e in zip(cuts, cuts[1:]):
                w = re.findall(r"[^\W_]+", line[s:e].lower())
                if w:
                    first.setdefault(tuple(w), (d, len(units[d])))
                    units[d].append((m.start(), m.start() + s, m.start() + e, tuple(w)))
    for d, mine in units.items():
        again = [first[u[3]] != (d, i) for i, u in enumerate(mine)]
        gone, i = set(), 0
        while i < len(mine):
            j = i
            while j < len(mine) and again[j]:
                j += 1
            if sum(len(u[3]) for u in mine[i:j]) >= least:
                gone.update(range(i, j))
            i = max(j, i + 1)
        if gone:
            kept_lines = {u[0] for i, u in enumerate(mine) if i not in gone}
            out[d] = (sum(len(mine[i][3]) for i in gone), sorted({first[mine[i][3]][0] for i in gone}),
                      [u[1:3] for i, u in enumerate(mine) if i in gone and u[0] in kept_lines], {u[0] for i, u in enumerate(mine) if i in gone} - kept_lines)
    return out


def test_the_query_against_plain_python(spark):
    """The registered query on the whole table: which documents, how many words, whose, and what is left."""
    from orderlens.llm.queries import QUERIES
    text = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    want = plain_edits(text)
    got = {r["doc_id"]: r for r in rows(QUERIES["op1_substring_dedup"](spark, SF))}
    assert got.keys() == want.keys() and len(want) > 20
    for d, (n, firsts, spans, lines) in want.items():
        left, at = [], 0  # lines that go as a whole, and spans in those that stay
        for line in text[d].split("\n"):
            if at not in lines:
                end = at + len(line)
                inner = [(s - at, e - at) for s, e in spans if at <= s < end]
                left.append(substring_dedup.without(line, inner))
            at += len(line) + 1
        assert got[d]["removed_words"] == n and got[d]["first_doc_ids"] == firsts
        assert got[d]["text"].rstrip("\n") == "\n".join(left).rstrip("\n"), d


def test_clean_documents_and_passages(spark):
    """At least 0.95 of the documents that share a 51-word passage with an earlier one lose text, at most 0.1 of the others.

    Others share long runs of clauses, but no 51 words in a row.
    """
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    seen, share = set(), set()
    for d in sorted(text):
        w = text[d].lower().split()
        mine = {" ".join(w[i:i + 51]) for i in range(len(w) - 50)}
        if not mine.isdisjoint(seen):
            share.add(d)
        seen |= mine
    got = {r["doc_id"] for r in rows(substring_dedup.edits(docs, unit="clause").select("doc_id"))}
    assert len(share & got) >= 0.95 * len(share) and len(got - share) <= 0.1 * len(text.keys() - share)


def test_recall_of_repeated_passages(spark):
    """Against a search of 51-word passages: documents that share one with an earlier document must lose text."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    seen, share = set(), set()
    for d in sorted(text):
        w = text[d].lower().split()
        mine = {" ".join(w[i:i + 51]) for i in range(len(w) - 50)}
        if not mine.isdisjoint(seen):
            share.add(d)
        seen |= mine
    got = {r["doc_id"] for r in rows(substring_dedup.edits(docs, unit="sentence").select("doc_id"))}
    assert share and len(share - got) <= 0.02 * len(share)


# --- licences ------------------------------------------------------------------------------

def test_licenses(spark, make):
    mit = f"MIT License\n\nCopyright (c) 2020 Some Body\n\n{licenses._GRANT_MIT}\n\n{licenses._AS_IS_MIT}\n"
    isc = f"(c) 1999 X\n{licenses._ISC}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{licenses._ISC_AS_IS}"
    docs = [(1, mit), (2, mit.upper().replace('"', "''")), (3, isc), (4, "Prose.\nReleased under the MIT Licence.\nMore prose."),
            (5, "x\r\nlicensed under CC BY-NC 4.0\r\ny"), (6, None), (7, ""), (8, "SPDX-License-Identifier: Apache-2.0"),
            (None, "All rights reserved."), (9, mit + " and more"), (10, "the word license alone " * 2000), (4, "nothing"),
            (11, "This work is licensed under the GNU General Public License, version 3.\nLicensed under the Apache License, Version 2.0.")]
    got = {}
    for r in rows(licenses.scan(make(docs))):
        got.setdefault(r["doc_id"], []).append((r["license"], r["notices"], r["n_matches"]))
    assert got[1] == [("MIT", ["MIT"], 0)] and got[2] == [("MIT", ["MIT"], 0)] and got[3] == [("ISC", ["ISC"], 0)]
    assert sorted(got[4], key=repr) == sorted([(None, ["MIT"], 1), (None, [], 0)], key=repr)
    assert got[5] == [(None, ["CC-BY-NC-4.0"], 1)] and got[6] == got[7] == got[10] == [(None, [], 0)]
    assert got[8] == [("Apache-2.0", ["Apache-2.0"], 1)] and got[None] == [("Proprietary", ["Proprietary"], 1)]
    assert got[9] == [(None, [], 0)] and got[11] == [(None, ["Apache-2.0", "GPL-3.0-only"], 2)]
    assert licenses.scan(spark.createDataFrame([], DOC)).count() == 0


def test_every_known_text_has_a_marker(spark):
    from pyspark.sql import functions as F
    known = spark.createDataFrame(licenses.KNOWN, "license string, text string")
    assert known.where(~F.col("text").rlike(licenses.MARKER)).count() == 0
    forms = known.select("license", licenses.canonical(licenses.replaced(F.col("text"), licenses.PREPARE)).alias("c"))
    assert forms.where(~F.col("c").rlike("licens|rights reserved|permission|warrant|redistribut|under ")).count() == 0
    assert forms.groupBy("c").agg(F.count_distinct("license").alias("n")).where("n > 1").count() == 0


def test_equivalent_spellings_without_the_word_licence(make):
    docs = {"Released under CC BY 4.0.": "CC-BY-4.0", "Distributed under Apache 2.0": "Apache-2.0", "Available under CC0 1.0": "CC0-1.0",
            "This work is published under GPLv3": "GPL-3.0-only", "Released under MIT.": "MIT", "Made available _under_ MPL 2.0": "MPL-2.0",
            "All  rights -- reserved": "Proprietary"}
    got = {r["doc_id"]: r["notices"] for r in rows(licenses.scan(make(list(enumerate(docs)))))}
    assert got == {i: [x] for i, x in enumerate(docs.values())}


BSD3 = f"{licenses._BSD_HEAD}\n\n{licenses._BSD_THIRD}\n\n{licenses._BSD_AS_IS}"
MIT = f"MIT License\n\nCopyright (c) 2020 Some Body\n\n{licenses._GRANT_MIT}\n\n{licenses._AS_IS_MIT}\n"


def commented(text, leader, first="", last=""):
    return first + "\n".join(f"{leader} {x}".rstrip() for x in text.split("\n")) + last


SPELLINGS = [  # text, licence of the whole text, notices, lines that name one
    (MIT.replace("NONINFRINGEMENT", "NON-INFRINGEMENT"), "MIT", ["MIT"], 0),
    (MIT.replace("OR COPYRIGHT\nHOLDERS", "OR\nCOPYRIGHT HOLDERS"), "MIT", ["MIT"], 0),
    ("Copyright 2020, A. B.\nAll rights reserved.\n\n" + BSD3, "BSD-3-Clause", ["BSD-3-Clause"], 0),
    ("All Rights Reserved\n(c) 2020 A. B.\n\n" + BSD3, "BSD-3-Clause", ["BSD-3-Clause"], 0),
    ("BSD 3-Clause License\n\nCopyright 2020 A.\nCopyright 2021 B.\n  All rights reserved.  \n\n" + BSD3, "BSD-3-Clause", ["BSD-3-Clause"], 0),
    (commented(MIT, "#"), "MIT", ["MIT"], 0), (commented(MIT, "//"), "MIT", ["MIT"], 0), (commented(MIT, ";;"), "MIT", ["MIT"], 0),
    (commented(MIT, " *", "/*\n", "\n */"), "MIT", ["MIT"], 0), (commented(MIT, "dnl"), "MIT", ["MIT"], 0), (f"<!--\n{MIT}-->", "MIT", ["MIT"], 0),
    ("# SPDX-License-Identifier: GPL-2.0-or-later\nx = 1", None, ["GPL-2.0-or-later"], 1),
    ("/* SPDX-License-Identifier: MIT OR Apache-2.0 */\nint x;", None, ["Apache-2.0", "MIT"], 1),
    ("// SPDX-License-Identifier: (GPL-2.0 WITH Linux-syscall-note) AND (ISC or GPL-3.0+)\nint x;", None, ["GPL-2.0-only", "GPL-3.0-or-later", "ISC"], 1),
    ("SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0-only", ["GPL-2.0-only"], 1),
    ("SPDX-License-Identifier: LicenseRef-Mine OR Unheard-Of", None, [], 0),
    ("x\nLicensed under the MIT license (see LICENSE).\ny", None, ["MIT"], 1),
    ("x\nReleased under the Apache License, Version 2.0. See the LICENSE file for details.\ny", None, ["Apache-2.0"], 1),
    (licenses._ZLIB.replace("acknowledgment", "acknowledgement"), "Zlib", ["Zlib"], 0), (licenses._UNLICENSE.replace("recognize", "recognise"), "Unlicense", ["Unlicense"], 0),
    ("Copyright 2020 A. B.\nAll rights reserved.\nProse about a licence.", None, [], 0), ("All rights reserved.", "Proprietary", ["Proprietary"], 1),
]


def test_licence_spellings(make):
    got = {r["doc_id"]: (r["license"], r["notices"], r["n_matches"]) for r in rows(licenses.scan(make([(i, x[0]) for i, x in enumerate(SPELLINGS)])))}
    assert got == {i: x[1:] for i, x in enumerate(SPELLINGS)}


def test_licences_against_plain_python(spark):
    """The registered query on the whole table, line by line."""
    import regex
    from orderlens.llm.queries import QUERIES

    def replaced(text, steps):
        for pattern, replacement in steps:
            text = regex.sub(pattern, replacement.replace("$", "\\"), text)
        return text

    canonical = lambda t: replaced(t.lower(), licenses.STEPS).strip(" ")
    known = {}
    for license, text in licenses.KNOWN:
        c = canonical(replaced(text, licenses.PREPARE))
        known[c] = min(license, known.get(c, license))
    want = {}
    for r in table(spark, "/root/testdata/sf0.01", "documents").collect():
        text = replaced(r["text"] or "", licenses.PREPARE)
        lines = [known[c] for x in text.split("\n") if (c := canonical(x)) in known]
        parts = [known[c] for x in regex.split(r"\n[ \t\r]*\n", text) if (c := canonical(x)) in known]
        want[r["doc_id"]] = (known.get(canonical(text)), sorted({*lines, *parts, *filter(None, [known.get(canonical(text))])}), len(lines))
    assert any(n for _, _, n in want.values())
    got = {r["doc_id"]: (r["license"], r["notices"], r["n_matches"]) for r in rows(QUERIES["op2_licenses"](spark, "/root/testdata/sf0.01"))}
    assert got == want


def test_full_licence_texts(make):
    texts = {}
    for license, text in licenses.KNOWN:
        if len(text) > 5000:
            texts.setdefault(license, text)
    assert {"Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-3.0-only", "MPL-2.0", "CC0-1.0"} <= set(texts)
    docs = list(enumerate(t.upper().replace("\n", "\r\n") for t in texts.values()))
    docs += [(100, texts["GPL-3.0-only"].split("END OF TERMS")[0]), (101, texts["MPL-2.0"] + " and more")]
    got = {r["doc_id"]: r["license"] for r in rows(licenses.scan(make(docs)))}
    assert got == {**dict(enumerate(texts)), 100: "GPL-3.0-only", 101: None}


def test_known_texts_of_the_caller(spark, make):
    known = spark.createDataFrame([("House", "Take it, share it."), ("Empty", "...")], "license string, text string")
    got = {r["doc_id"]: (r["license"], r["notices"]) for r in rows(licenses.scan(make([(1, "TAKE it; share it"), (2, "x\nTake it, share it!\n"), (3, "..."), (4, "MIT License")]), known=known))}
    assert got == {1: ("House", ["House"]), 2: (None, ["House"]), 3: (None, []), 4: (None, [])}
