"""Main text of pages: the given pages against a plain reading of their articles, made pages against their known text."""

from __future__ import annotations

import random
import re
import time
from html import escape, unescape

import pytest

from feeloom.llm import main_text
from feeloom.llm.queries import QUERIES


def plain_article(page):
    """The article of a given page, cut at block tags: those pages hold nothing else inside it."""
    inside = re.search(r"<article>(.*?)(?:</article>|$)", page or "", re.S)
    parts = re.split(r"</?(?:p|h1|br)\b[^>]*>", inside.group(1) if inside else "")
    return "\n".join(x for x in (" ".join(unescape(re.sub("<[^>]*>", "", part)).split()) for part in parts) if x)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_given_pages(spark, sf):
    got = QUERIES["op12_main_text"](spark, f"/root/testdata/{sf}").collect()
    pages = {r["page_id"]: r for r in spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").collect()}
    assert sorted(r["page_id"] for r in got) == sorted(pages)
    for r in got:
        assert r["url"] == pages[r["page_id"]]["url"]
        assert r["text"] == plain_article(pages[r["page_id"]]["html"]), r["page_id"]
        assert r["n_chars"] == len(r["text"])


WORDS = "river stone market winter simple letter a of and the to 3 < & > café naïve ½ —   \U0001f600 house".split(" ")


def sentence(rng, least=1, most=40):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randrange(least, most))) + " end."


def paragraph(rng, text):
    """``text`` as it may be written: escaped, with inline elements, comments and line breaks between words."""
    words = text.split()
    out = []
    for word in words:
        word = escape(word, quote=rng.random() < 0.5)
        if rng.random() < 0.1:
            word = "".join(f"&#{ord(c)};" if rng.random() < 0.5 else f"&#x{ord(c):X};" for c in unescape(word))
        kind = rng.randrange(12)
        out.append({0: f"<b>{word}</b>", 1: f'<a href="/x?a=1&b=2" title="a > b">{word}</a>', 2: f"{word}<!-- <p> -->", 3: f"<EM class='x'>{word}</EM>"}.get(kind, word))
    return rng.choice([" ", "\n", " \t\n  "]).join(out)


BESIDE = [
    lambda s: f"<nav><ul><li><a href=/a>{s}</a><li><a href=/b>{s}</a></ul></nav>",
    lambda s: f"<header><h1>Site</h1><p>{s}</p></header>",
    lambda s: f"<footer>&copy; 2020 {s}<p>{s}</p></footer>",
    lambda s: f"<aside><h3>More</h3><p>{s}</p></aside>",
    lambda s: f'<div class="sidebar left"><p>{s}</p><p>{s}</p></div>',
    lambda s: f'<div class="ad">{s}</div>',
    lambda s: f'<div id="cookie-notice" role=dialog>{s} <button>{s}</button></div>',
    lambda s: f'<form action="/s"><label>{s}</label><input value="{s}"><select><option>{s}<option>x</select></form>',
    lambda s: f"<script>var a = '<p>{s}</p>'; if (a < 1 && b > 2) {{}}</script><style>p > a {{ {s} }}</style><noscript>{s}</noscript>",
    lambda s: f'<section id="comments"><h2>Comments</h2><article class="comment"><p>{s}</p></article><div class="reply">{s}</div></section>',
    lambda s: f'<ul class="menu"><li><a href="/a">{s}</a></li></ul>',
    lambda s: f'<div hidden><p>{s}</p></div><p style="display: none">{s}</p><!-- <p>{s}</p> -->',
]


@pytest.mark.parametrize("holder", ["article", "main", "div"])
def test_made_pages(holder):
    rng = random.Random(3)
    for _ in range(300):
        blocks = [sentence(rng, 4, 12)] + [sentence(rng, 25 if holder == "div" else 1) for _ in range(rng.randrange(2, 12))]
        inside = f"<h1>{paragraph(rng, blocks[0])}</h1>"
        for text in blocks[1:]:
            written = paragraph(rng, text)
            inside += rng.choice([f"<p>{written}</p>", f"<p>{written}", f"<div><p class=x>{written}</p></div>", f"<br>{written}<br>", f"<ul><li>{written}</ul>", f"<blockquote>{written}</blockquote>"])
            if rng.random() < 0.3:
                inside += rng.choice(BESIDE[3:])(escape(sentence(rng)))
        before = "".join(rng.choice(BESIDE)(escape(sentence(rng))) for _ in range(rng.randrange(4)))
        after = "".join(rng.choice(BESIDE)(escape(sentence(rng))) for _ in range(rng.randrange(4)))
        page = f"<!DOCTYPE html><html><head><title>{escape(sentence(rng))}</title><meta charset=utf-8></head><body>{before}<{holder}>{inside}</{holder}>{after}"
        page += rng.choice(["", "</body></html>"])
        want = [" ".join(b.split()) for b in blocks]
        assert main_text.main_text_of(page) == want, page


@pytest.mark.parametrize("page, want", [
    ("", []), ("   ", []), ("no markup at all", ["no markup at all"]), ("<p>Hi.</p>", ["Hi."]),
    ("<nav><a href=/>Home</a></nav><ul><li><a href=/a>one</a><li><a href=/b>two</a></ul>", []),
    ("<article><p>a &amp; b &am &ampc &lt;p&gt; &#65;&#x42; &nbsp; x", ["a & b &am &c <p> AB x"]),
    ("<article><p>one<p>two<!-- open comment <p>three", ["one", "two"]),
    ("<article><p>one</p><script>x</p>", ["one"]), ("<article>1 < 2 and a<b>c</b>", ["1 < 2 and ac"]),
    ("<nav><ul><li><a href=/>x</a><article><p>menu was left open</p></article>", ["menu was left open"]),
    ("<article><p>one</div></article><footer>foot</footer>", ["one"]),
    ("<head><title>t</title><p>head was left open, and the text goes on", ["head was left open, and the text goes on"]),
    ("<article><header><h1>Title</h1><p>by someone</p></header><p>text</p></article>", ["Title", "text"]),
    ("<article><h2>T</h2><p>a</p><div class='related'><p>b</p></div><p>c</p><p><a href=/>Next page</a></p></article>", ["T", "a", "c"]),
    ("<article><p>one</p><table><tr><td>a<td>b<tr><td>c</table></article>", ["one", "a b", "c"]),
    ("<main><p>a long text of the page itself</p><article><p>teaser</p></article></main>", ["a long text of the page itself"]),
    ("<article><p title='a > b' x=\"<p>\">quoted</p><p don't>it's</p></article>", ["quoted", "it's"]),
])
def test_pages_by_hand(page, want):
    assert main_text.main_text_of(page) == want


def test_surge_and_dive_without_an_article():
    text = ["A sentence that is long enough to carry the sum of a window above the bar of the page, clearly.", "Short.", "Another line of the text, again with some words in it."]
    links = "".join(f"<li><a href='/{i}'>Link number {i}</a></li>" for i in range(12))
    page = f"<body><ul>{links}</ul>" + "".join(f"<div>{t}</div>" for t in text) + f"<ul>{links}</ul><div>Tiny.</div></body>"
    assert main_text.main_text_of(page) == text
    assert main_text._regions([0, 0, 50, 1, 60, 0, 0, 0, 5, 0], 3, 86) == [(2, 5)]


@pytest.mark.parametrize("page", [
    "<article>" + "<div><p>x " * 100_000, "<" * 500_000, "<a b='" * 100_000, "<!--" * 200_000, "&" * 300_000, "<p a=" * 100_000,
    "<article><p>" + "word " * 1_000_000, "<b>" * 200_000 + "</i>" * 200_000,
], ids=["nested", "less than", "quotes", "comments", "references", "attributes", "one block", "crossing"])
def test_hard_pages_take_seconds(page):
    began = time.process_time()
    main_text.main_text_of(page)
    assert time.process_time() - began < 20


def test_awkward_rows(spark):
    schema = "page_id long, url string, html string, text int, n_chars string, n_blocks int"
    page = "<article><p>ü\U0001f600 x</p><p>two</p></article>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", page), (3, "u", page), (3, "u", page), (4, "u", "<article><p>" + "word " * 300_000)]
    got = main_text.extract_main_text(spark.createDataFrame([(*r, 7, "k", 7) for r in rows], schema)).collect()
    assert sorted((r["page_id"] or 0, r["text"][:20], r["n_chars"], r["n_blocks"]) for r in got) == [
        (0, "ü\U0001f600 x\ntwo", 8, 2), (1, "", 0, 0), (2, "", 0, 0), (3, "ü\U0001f600 x\ntwo", 8, 2), (3, "ü\U0001f600 x\ntwo", 8, 2), (4, ("word " * 300_000)[:20], 1_499_999, 1),
    ]
    assert main_text.extract_main_text(spark.createDataFrame([], schema)).count() == 0
