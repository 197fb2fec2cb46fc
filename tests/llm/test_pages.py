"""Page extraction: attributes, names, unmarked layouts, linear time."""

from __future__ import annotations

import time

import pytest

from orderlens.llm import main_text

WEIGHTS = main_text.weights(main_text.example_weights())
STORY = " ".join(f"story{i}" for i in range(70))
SECOND = " ".join(f"second{i}" for i in range(40))


def text_of(page):
    return main_text.main_text(page, WEIGHTS)


def test_attributes_by_the_html_rules():
    assert main_text.attributes_of(""" title=it's CLASS = "a b" hidden data-x='1>2' id=x/y class=late""") == {
        "title": "it's", "class": "a b", "hidden": "", "data-x": "1>2", "id": "x/y"}
    assert text_of(f"<article><p title=it's>{STORY}</p><p>it's kept</p></article>") == f"{STORY}\nit's kept"
    assert text_of(f"""<article><p title="a > b" x='>'>{STORY}</p><p data-q=">">{SECOND}</p></article>""") == f"{STORY}\n{SECOND}"


@pytest.mark.parametrize("attribute, kept", [
    ('title="a hidden gem"', True), ('class="md hidden lg:block"', True), ('data-state="hidden"', True), ("title='no aria-hidden=true here'", True),
    ('style="color:red"', True), ("hidden", False), ('hidden=""', False), ("aria-hidden=true", False), ('aria-hidden="true"', False), ('style="display: none"', False)])
def test_only_real_hidden_attributes_hide(attribute, kept):
    assert text_of(f"<article><p>{STORY}</p><p {attribute}>{SECOND}</p></article>") == (f"{STORY}\n{SECOND}" if kept else STORY)


NAV = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul></nav>"
FOOT = "<footer><p>Imprint and contact</p></footer>"
OPENINGS = {  # markup before the story of a page that marks none, and what closes it
    "plain": ("<div>", "</div>"),
    "sale": ("<div class='notice-of-sale'>", "</div>"),
    "social": ("<div class='social-studies post'>", "</div>"),
    "sidebar": ("<div class='layout has-sidebar'><div class='sidebar'><a href='/1'>One</a> <a href='/2'>Two</a></div><div class='text'>", "</div></div>"),
    "table": ("<table><tr><td>", "</td></tr></table>"),
    "section": ("<section id='content'><h2>Title</h2>", "</section>"),
    "deep": ("<div><div><div class='no-comments'>", "</div></div></div>"),
    "unclosed": ("<div class='search-and-rescue'>", ""),
    "centre": ("<center>", "</center>"),
    "dialogue": ("<div class='a-dialog-of-two'>", "</div>"),
}
BOILERPLATE = {
    "names": ("<div id='site-header'>Daily Site</div>" + NAV, "<div class='user-comments'><p>First! What a great post this is, by all of you.</p></div>" + FOOT),
    "elements": (f"<header>Daily Site {NAV}</header>", "<aside>Most read today</aside><form><label>Mail</label><input></form>" + FOOT),
    "links": ("<div><a href='/'>Home</a> | <a href='/n'>News</a> | <a href='/c'>Contact</a></div>", "<p><a href='/i'>Imprint</a> <a href='/t'>Terms</a></p>"),
    "adverts": ("<div class='google-ad'>Buy two, get one</div>", "<div class='cookie-consent-banner'>We use cookies on this site</div><script>x('<p>no</p>')</script>"),
}


@pytest.mark.parametrize("opening", OPENINGS)
@pytest.mark.parametrize("around", BOILERPLATE)
def test_unmarked_pages(opening, around):
    """40 layouts without <article> or <main>: the whole story, and nothing of what stands around it."""
    (start, end), (before, after) = OPENINGS[opening], BOILERPLATE[around]
    title = ["Title"] if "Title" in start else []
    page = f"<html><body>{before}{start}<p>{STORY}</p><div class='share-price'>Ten euros a share</div><p>{SECOND}</p>{end}{after}</body></html>"
    assert text_of(page).split("\n") == [*title, STORY, "Ten euros a share", SECOND]


@pytest.mark.parametrize("page", [
    "<div class='warning'>" * 50_000 + "deep" + "</div>" * 50_000,
    "<div class='warning'>" * 50_000,
    "<div class='notice-of-sale'>" * 50_000 + "deep" + "</div>" * 50_000,
    "<article>" + "<div class='warning'>w " * 50_000 + "</div>" * 50_000 + "</article>",
    "<i>" * 50_000 + "x",
    "<i><div>" + "<b>" * 50_000 + "</i>" * 50_000,
    "<main>" * 25_000 + "<article>a</article>" * 25_000 + "</main>" * 25_000,
    "<form>" * 50_000 + "x" + "</form>" * 50_000,
    '<a x=">" ' * 50_000, '<a x="> ' * 50_000, "<a x='" * 50_000, "<!" * 50_000, "<!--" * 50_000, "<script" * 50_000, "<title>" * 50_000 + "</title" * 50_000,
    "<p a" + "=" * 50_000 + ">x", "<p " + "/ " * 50_000, "<" * 100_000, "<p class='" + "ad " * 50_000 + "'>x</p>"])
def test_linear_time(page):
    start = time.process_time()
    text_of(page)
    assert time.process_time() - start < 2
