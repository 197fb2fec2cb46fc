"""Operator 3: main text of HTML pages by maximum-scoring subsequence.

A page is read as a sequence of words and tags. Words score positive where they stand like
article words and negative where they stand like boilerplate; tags score negative. A linear
scan finds the contiguous run with the greatest sum, which is the article; what lies inside
it but belongs to menus, adverts, forms, notices, scripts or reader comments is left out: elements
of such a kind, and those whose class, id or role says nothing else. Where a name says noise among
other things (``notice-of-sale``), its words score negative, so they go at the edges and stay within
the article, unless the element holds ``MOST`` plain words of the page. All steps take linear time.

The weights are log odds from labelled pages: pages whose own markup names the article
(``<article>`` or ``<main>``), a bounded sample of ``SAMPLE`` rows with the least key hashes,
counted on the executors, plus a few built-in pages (``EXAMPLES``) for tags the sample lacks.

Defined cases: NULL and empty HTML give an empty text; HTML without markup is one block;
unclosed elements end with their parents, and boilerplate that is never closed ends at the
next block; character references are decoded once; an empty table gives an empty result;
equal rows get equal texts; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import html as entities
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from .common import with_place

SAMPLE = 2000
ASIDE = 1  # one stretch of boilerplate costs at most what so many article words gain, so it splits no article

NAMED = 20  # a stretch of words under a doubtful name costs at most what so many article words gain
MISFITS = 8  # after so many tags whose quotes never close, tags end at their first ">"
MOST = 0.8  # an element with this share of a page's plain words is a wrapper, whatever its name says

# A quote opens a value only after "=", as the HTML standard reads attributes.
_VALUE = r"""\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|(?=>))"""
_OTHER = r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"""
_TAG = r"<(/?)([a-zA-Z][^\s/>]*+)"
TOKEN = re.compile(rf"{_OTHER}|{_TAG}((?:[\s/]++|[^\s/>][^\s/>=]*+(?:{_VALUE})?+)*+)>|{_TAG}([^>]*+)>", re.S)
PLAIN_TOKEN = re.compile(rf"{_OTHER}|{_TAG}([^>]*+)>", re.S)
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+""")
NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
PIECE = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")

# Names from the HTML standard, and class names in common use.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCK = set("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table
tbody tfoot thead title tr ul""".split())
SPACE = set("br td th img".split())
NEVER = set("""applet aside audio button canvas datalist dialog embed footer form frameset head iframe input menu nav noembed
noframes noscript object option script select style svg template textarea title video xmp""".split())
ARTICLE = {"article", "main"}
BARRIER = ARTICLE | set("body div section table td th aside nav footer header form li ul ol dl blockquote".split())
NOISE_NAMES = set("""ad ads adsense advert adverts advertisement advertisements advertising banner banners breadcrumb breadcrumbs
byline cmp comment comments complementary consent contentinfo cookie cookies dialog discussion disqus dropdown footer footers
gdpr login masthead menu menubar menus modal nav navbar navigation newsletter notice notices notification notifications
overlay pager pagination paywall popup promo promos promoted promotion recommendations recommended related replies reply respond
search share sharing sidebar sidebars signup skip social sponsor sponsored sponsors subscribe subscription teaser teasers
toolbar warning widget widgets alert alerts header headers""".split())
# Inside an article these often name parts of it: they count only for elements whose words are mostly links.
DOUBTFUL = set("""alert alerts banner banners byline dialog discussion header headers masthead menu menus notice notices notification
notifications overlay respond search skip social warning""".split())
PLAIN_PIECES = set("""area bar block blog bottom box btn button buttons col container content form global google group icons inner item
items left links list main module outer page panel post posts primary reader readers right row secondary section site slot story
stories top unit user users website wrap wrapper""".split())
HEADING = set("h1 h2 h3 h4 h5 h6".split())
EXAMPLES = [
    """<html><head><title>t</title></head><body><header><div class="logo">Daily Site</div><nav><ul><li><a href="/">Home</a></li>
    <li><a href="/n">News of today</a></li></ul></nav></header><div id="wrap"><p>Welcome back</p><article><h1>A long day at sea</h1>
    <p>The boat left early and came <a href="/h">home</a> late, as the <em>wind</em> had turned.</p><h2>Later</h2><ul><li>First we
    slept</li><li>then we ate what was left</li></ul><blockquote>It was all worth it, said the old man to the crowd.</blockquote>
    <aside>See also other stories</aside><p>Nobody was hurt<br>and the boat is whole.</p></article><aside class="sidebar"><h3>Most
    read</h3><ol><li><a href="/1">One</a></li></ol></aside><div class="comments"><p>Great story!</p></div></div><footer><p>All
    rights reserved</p><form><label>Mail</label><input><button>Send</button></form></footer></body></html>""",
    """<body><div class="cookie-notice"><p>We use cookies.</p><button>OK</button></div><main><h1>Soup</h1><p>Cut the onions and
    fry them slowly in <b>butter</b> until they are soft and brown.</p><table><tr><th>Salt</th><td>two spoons of it</td></tr></table>
    <figure><img src="s"><figcaption>The soup in its bowl</figcaption></figure><pre>stir   well</pre><p>Serve it hot with fresh
    bread.</p></main><div>Call us</div><div><a href="/i">Imprint</a> <a href="/c">Contact</a> <span>2020</span></div></body>""",
]


@dataclass
class Run:
    """A stretch of text, how it stands (see ``context``) and the tags right before it."""

    text: str
    noise: bool
    inside: bool
    link: bool
    breaks: str  # "\n" at a block boundary, " " at a line break or cell, else ""
    tags: list[str] = field(default_factory=list)
    named: bool = False  # a class, id or role around it says noise among other things


def attributes_of(source: str) -> dict[str, str]:
    """A tag's attributes by lower-case name; the first of a name counts."""
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(source):
        out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out


def tokens(attributes: dict[str, str]) -> list[list[str]]:
    """The pieces of each class, id and role."""
    return [[p.lower() for p in PIECE.findall(token)] for a in ("class", "id", "role") for token in attributes.get(a, "").split()]


def noisy(name: str, attributes: dict[str, str], inside: bool, linked: bool = False) -> bool:
    """Whether an element is something other than the article, by its kind or because a class, id or role
    says nothing but noise names (``share-buttons``, not ``share-price``).

    Inside an article headings are exempt and ``DOUBTFUL`` names need ``linked`` words.
    """
    if name in NEVER or (name == "header" and not inside):
        return True
    if name in ("html", "body") or name in ARTICLE:
        return name == "article" and any(w in ("comment", "comments", "reply", "teaser", "related") for p in tokens(attributes) for w in p)
    if "hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true" or NO_DISPLAY.search(attributes.get("style", "")):
        return True
    if inside and name in HEADING:
        return False
    spared = DOUBTFUL if inside and not linked else set()
    return any(not (hits := NOISE_NAMES.intersection(pieces)) <= spared and all(p in hits or p in PLAIN_PIECES or p.isdigit() for p in pieces)
               for pieces in tokens(attributes))


def doubtful(name: str, attributes: dict[str, str]) -> bool:
    """Whether a class, id or role says noise among other things."""
    return name not in HEADING | ARTICLE | {"html", "body"} and any(not NOISE_NAMES.isdisjoint(p) for p in tokens(attributes))


def elements(page: str) -> list[tuple[int, int, str, dict[str, str], bool, int]]:
    """Tags of a page: (start, end, name, attributes, closing, position of the matching tag in the list or -1)."""
    tags: list[list] = []
    stack: list[int] = []
    open_at: dict[str, list[int]] = {}  # name -> its places in the stack
    barriers: list[int] = []  # places of barriers in the stack
    at, misfits = 0, 0
    last = page.rfind(">") + 1  # no tag is complete beyond
    while m := (TOKEN if misfits < MISFITS else PLAIN_TOKEN).search(page, at, last):
        at = m.end()
        plain = misfits >= MISFITS
        slash, name, source = (m[1], m[2], m[3]) if plain or m[2] else (m[4], m[5], m[6])
        misfits += not plain and m[5] is not None
        name, closing = (name or "").lower(), bool(slash)
        if not name and at == last and m[0].startswith(("<!--", "<![CDATA[")) and not m[0].endswith(("-->", "]]>")):
            at = len(page)
        tags.append([m.start(), at, name, attributes_of(source) if source and not closing else {}, closing, -1])
        here = len(tags) - 1
        if not name:
            continue
        if closing:
            if open_at.get(name):
                depth = open_at[name][-1]
                if name in BARRIER or name in NEVER or not barriers or barriers[-1] < depth:
                    tags[stack[depth]][5], tags[here][5] = here, stack[depth]
                    while len(stack) > depth:
                        other = tags[stack.pop()][2]
                        open_at[other].pop()
                        if other in BARRIER:
                            barriers.pop()
        elif name in RAW:
            end = re.compile(rf"</{re.escape(name)}[^>]*>", re.I).search(page, at, max(at, last))
            stop = (end.start(), end.end()) if end else (len(page), len(page))
            tags.append([stop[0], stop[1], name, {}, True, here])
            tags[here][5] = len(tags) - 1
            at = stop[1]
        elif name not in VOID and not (source or "").endswith("/"):
            open_at.setdefault(name, []).append(len(stack))
            if name in BARRIER:
                barriers.append(len(stack))
            stack.append(here)
        if at >= last:
            break
    return [tuple(t) for t in tags]


class Words:
    """Word counts between tags as prefix sums: all words that are not in scripts and the like, and those in links."""

    def __init__(self, page: str, tags: list[tuple]) -> None:
        self.total, self.linked = [0], [0]
        link, skip = False, -1
        for i, (_, at, name, _, closing, match) in enumerate(tags):
            if name == "a":
                link = not closing
            if name in RAW and not closing:
                skip = match
            n = len(page[at:tags[i + 1][0] if i + 1 < len(tags) else len(page)].split()) if i >= skip else 0
            self.total.append(self.total[-1] + n)
            self.linked.append(self.linked[-1] + n * link)

    def plain(self, first: int, last: int) -> int:
        return self.between(first, last) - (self.linked[last] - self.linked[first])

    def between(self, first: int, last: int) -> int:
        return self.total[last] - self.total[first]

    def mostly_links(self, first: int, last: int) -> bool:
        return 2 * (self.linked[last] - self.linked[first]) > self.between(first, last)


def among(starts: list[int], first: int, last: int) -> bool:
    """Whether one of the sorted ``starts`` lies strictly between two tags."""
    k = bisect.bisect_right(starts, first)
    return k < len(starts) and starts[k] < last


def chosen_parts(tags: list[tuple], words: Words) -> dict[int, int]:
    """Start and end tags of the elements that make up the article.

    Articles win over a <main> that holds them, with the headings and paragraphs of the <main> before
    them, unless most plain words of the <main> lie outside its articles. A <main> without articles
    of its own wins over articles elsewhere when it has more plain words than all of them.
    """
    end_of = lambda i: tags[i][5] if tags[i][5] >= 0 else len(tags)
    starts = [i for i, t in enumerate(tags) if t[2] in ARTICLE and not t[4] and not noisy(t[2], t[3], True)]
    mains = [i for i in starts if tags[i][2] == "main"]
    outer, until = [], -1  # articles that lie in no other article
    for i in starts:
        if tags[i][2] == "article" and i >= until:
            outer.append(i)
            until = end_of(i)
    if not outer or not mains:
        return {i: end_of(i) for i in outer or mains}
    sums = [0]
    for i in outer:
        sums.append(sums[-1] + words.plain(i, end_of(i)))
    out: dict[int, int] = {}
    for m in mains:
        a, b = bisect.bisect_right(outer, m), bisect.bisect_left(outer, end_of(m))
        mine = sums[max(a, b)] - sums[a]
        if words.plain(m, end_of(m)) - mine > (mine if a < b else sums[-1]):
            out[m] = end_of(m)
    if out:
        return out
    out, done = {i: end_of(i) for i in outer}, 0
    for m in mains:
        a = bisect.bisect_right(outer, m)
        first = outer[a] if a < len(outer) and outer[a] < end_of(m) else m
        out |= {i: end_of(i) for i in range(max(m + 1, done), first) if tags[i][2] in HEADING | {"p"} and not tags[i][4] and 0 <= tags[i][5] < first}
        done = max(done, first)
    return out


def runs(page: str) -> tuple[list[Run], bool]:
    """The page's text runs in order, and whether its markup names an article."""
    tags = elements(page)
    words = Words(page, tags)
    ends = chosen_parts(tags, words)
    chosen = sorted(ends)
    out: list[Run] = []
    pending: list[str] = []
    under: list[tuple[int, int]] = []  # elements with doubtful names, as bounds in ``out``
    open_names: list[tuple[int, int]] = []  # (end tag, first run) of those still open
    breaks, at, link = "\n", 0, 0
    noise_until = inside_until = -1
    noise_block = False
    for i, (s, e, name, attributes, closing, match) in enumerate([*tags, (len(page), len(page), "", {}, False, -1)]):
        if s > at and (text := page[at:s]) and not text.isspace():
            out.append(Run(text, noise_until > i - 1 or noise_block, i - 1 < inside_until, link > 0, breaks, pending))
            breaks, pending = "", []
        elif s > at:
            breaks = breaks or " "
        at = e
        while open_names and open_names[-1][0] <= i:
            under.append((open_names.pop()[1], len(out)))
        if not name:
            continue
        inside = i < inside_until
        if i in ends:
            inside_until = max(inside_until, ends[i])
        if name in BLOCK:
            breaks, noise_block = "\n", False
        elif name in SPACE:
            breaks = breaks or " "
        if name == "a":
            link = 0 if closing else 1
        hidden = noise_until > i
        if not closing and not hidden and name not in VOID:
            by_links = match >= 0 and words.mostly_links(i, match)
            named = not inside and bool(attributes) and doubtful(name, attributes)
            if noisy(name, attributes, inside) or inside and by_links and noisy(name, attributes, True, True) or named and by_links:
                end = match if match >= 0 else -1
                if end < 0:
                    noise_block = name in NEVER or name in BLOCK
                elif name == "form" and (among(chosen, i, end) if chosen else 2 * words.between(i, end) > words.total[-1]):
                    pass  # a form is only a wrapper when it contains the article, or most words of a page that marks none
                elif name in NEVER or not among(chosen, i, end):
                    noise_until, hidden = end, True
            elif named and match >= 0 and not among(chosen, i, match):
                open_names.append((match, len(out)))
        if not hidden and i != noise_until:  # the tags of an aside count as part of it
            pending.append(name)
    while open_names:
        under.append((open_names.pop()[1], len(out)))
    believe(out, under, bool(chosen))
    return out, bool(chosen)


def believe(found: list[Run], under: list[tuple[int, int]], marked: bool) -> None:
    """Marks the runs under doubtful names, but not those of elements that hold ``MOST`` plain words of an unmarked page."""
    if not under:
        return
    plain = [0]
    for r in found:
        plain.append(plain[-1] + (0 if r.noise or r.link else len(r.text.split())))
    steps = [0] * (len(found) + 1)
    for first, last in under:
        if marked or plain[last] - plain[first] < MOST * plain[-1]:
            steps[first] += 1
            steps[last] -= 1
    depth = 0
    for r, step in zip(found, steps):
        depth += step
        r.named = depth > 0


def context(run: Run, marked: bool) -> str:
    if run.noise:
        return "dropped" if run.inside else "noise"
    if run.named and not run.inside:
        return "noise"
    if marked:
        return "inside" if run.inside else "outside"
    return "link" if run.link else "plain"


def evidence(page: str, counts: dict[str, list[int]]) -> None:
    """Adds a labelled page's counts: feature -> [within the article, elsewhere]."""
    found, marked = runs(page)
    if not marked:
        return
    for r in found:
        good = r.inside and not r.noise
        n = len(r.text.split())
        as_plain = "noise" if (r.noise or r.named) and not r.inside else "link" if r.link else "plain"
        for feature, k in [(f"word:{context(r, True)}", n), (f"word:{as_plain}", n), *[(f"tag:{t}", 1) for t in r.tags]]:
            counts.setdefault(feature, [0, 0])[0 if good else 1] += k


def weights(counts: dict[str, list[int]]) -> dict[str, float]:
    """Log odds of a feature within the article against elsewhere; tags always cost a little."""
    out = {}
    for kind in ("word", "tag"):
        mine = {f: c for f, c in counts.items() if f.startswith(kind)}
        inside = sum(c[0] for c in mine.values()) + 1
        outside = sum(c[1] for c in mine.values()) + 1
        for f, (a, b) in mine.items():
            out[f] = math.log((a + 0.5) / inside) - math.log((b + 0.5) / outside)
            if kind == "tag":
                out[f] = max(min(out[f], 0.0), -3.0) - 0.05
    for f, floor in (("word:inside", 1.0), ("word:plain", 0.5)):
        out[f] = max(out.get(f, 0.0), floor)
    for f in ("word:outside", "word:noise"):
        out[f] = min(out.get(f, -3.0), -1.0)
    out["word:link"] = out.get("word:link", -0.5)
    out["word:dropped"] = 0.0
    return out


def example_weights() -> dict[str, list[int]]:
    counts: dict[str, list[int]] = {}
    for page in EXAMPLES:
        evidence(page, counts)
    return counts


def best_region(found: list[Run], marked: bool, weight: dict[str, float]) -> tuple[int, int]:
    """Bounds of the contiguous runs with the greatest score; (0, 0) when no word scores."""
    gain_of_word = weight.get("word:plain", 1.0)
    best, bounds, score, start = 0.0, (0, 0), 0.0, 0
    for i, r in enumerate(found):
        score += sum(weight.get(f"tag:{t}", -0.3) for t in r.tags)
        if score <= 0:
            score, start = 0.0, i
        gain = len(r.text.split()) * weight[f"word:{context(r, marked)}"]
        if r.noise or marked and not r.inside:
            gain = max(gain, -ASIDE * gain_of_word)
        elif r.named:
            gain = max(gain, -NAMED * gain_of_word)
        score += gain
        if score > best:
            best, bounds = score, (start, i + 1)
    return bounds


def main_text(page: str | None, weight: dict[str, float]) -> str:
    """The article's blocks, one per line."""
    if not page:
        return ""
    found, marked = runs(page)
    start, end = best_region(found, marked, weight)
    blocks, parts = [], []
    for r in found[start:end]:
        if "\n" in r.breaks and parts:
            blocks.append("".join(parts))
            parts = []
        if not r.noise and (r.inside or not marked):
            parts += [" " if r.breaks == " " else "", entities.unescape(r.text)]
    blocks.append("".join(parts))
    return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def learn(pages: DataFrame, key: str = "page_id", html: str = "html", sample: int = SAMPLE) -> dict[str, float]:
    """Weights from at most ``sample`` labelled rows and the built-in pages; the driver reads only summed counts."""
    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, list[int]] = {}
        for b in batches:
            for page in b["html"]:
                evidence(page, counts)
        known = BLOCK | SPACE | NEVER | VOID | RAW | set("a abbr b cite code em i label q s small span strong sub sup u".split())
        rows = [(f, a, b) for f, (a, b) in counts.items() if not f.startswith("tag:") or f[4:] in known]
        yield pd.DataFrame(rows, columns=["feature", "within", "elsewhere"])

    rows = with_place(pages, "pages", F.col(html).cast("string").alias("html"), F.md5(F.col(key).cast("string")).alias("order"))
    marked = rows.where(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    # the places first (at most ``sample`` small rows from each task), then their pages where they lie
    picked = marked.select("order", "row").orderBy("order", "row").limit(sample).select("row")
    rows = rows.join(F.broadcast(picked), "row", "left_semi").select("html")
    sums = rows.mapInPandas(count, "feature string, within long, elsewhere long").groupBy("feature").agg(
        F.sum("within").alias("within"), F.sum("elsewhere").alias("elsewhere"))
    counts = example_weights()
    for r in sums.collect():  # one row per known feature
        have = counts.setdefault(r["feature"], [0, 0])
        have[0] += r["within"]
        have[1] += r["elsewhere"]
    return weights(counts)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text, n_chars) for every page."""
    weight = learn(pages, key, html)

    @F.pandas_udf(T.StringType())
    def text_of_page(column: pd.Series) -> pd.Series:
        return pd.Series([main_text(page, weight) for page in column], dtype=object)

    out = pages.select(key, url, text_of_page(F.col(html).cast("string")).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
