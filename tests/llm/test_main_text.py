import random

import pytest
from helpers import rows_of
from riskspark.llm.main_text import Page, main_blocks, main_text

WORDS = "sea, wind; harbour. tide rope sail mast bell lamp crew? north star cloud rain ship".split()


def said(rng, low=8, high=60):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randrange(low, high)))


SIDE = [
    lambda t: f"<nav><ul><li><a href='/a'>{t}</a><li><a href='/b'>Home</a></ul></nav>",
    lambda t: f"<header><div>{t}</div></header>",
    lambda t: f"<div class='site-header'>{t}</div>",
    lambda t: f"<footer>&copy; {t}</footer>",
    lambda t: f"<aside><p>{t}</p></aside>",
    lambda t: f'<div id="side-bar"><p>{t}</p><p>{t}</p></div>',
    lambda t: f"<div class='cookie-notice'><p>{t}</p><button>OK</button></div>",
    lambda t: f"<DIV CLASS=ad>{t}</DIV>",
    lambda t: f"<div class='adBanner'>{t}</div>",
    lambda t: f"<form action='/s'><label>{t}</label><input name=q><select><option>1<option>2</select></form>",
    lambda t: f"<script>if (a < b) {{ write('<p>{t}</p>'); }}</script>",
    lambda t: f"<style>p > b {{ content: '{t}' }}</style>",
    lambda t: f"<!-- <p>{t}</p> -->",
    lambda t: f"<noscript><p>{t}</p></noscript>",
    lambda t: f"<div style='display: none'><p>{t}</p></div>",
    lambda t: f"<section id='comments'><h2>Comments</h2><article class='comment'><p>{t}</p></article></section>",
    lambda t: f"<div class='related'><article><h3><a href='#'>{t}</a></h3></article></div>",
    lambda t: f"<div role='navigation'>{t}</div>",
    lambda t: f"<template><p>{t}</p></template>",
]


def piece(rng):
    """Markup of a block of the article and its text."""
    text = said(rng, 1, 70)
    shape = rng.randrange(9)
    if shape == 0:
        return f"<p>{text.replace(' ', '  ' + chr(10), 1)}</p>", [text]
    if shape == 1:
        return f"<p>{text}", [text]  # end tag left out
    if shape == 2:
        return f"<p><b>{text}<br>{text}</b></p>", [f"{text} {text}"]
    if shape == 3:
        return f"<ul><li>{text}<li>{text}</ul>", [text, text]
    if shape == 4:
        return f"<blockquote><p>{text}</p></blockquote>", [text]
    if shape == 5:
        return f"<table><tr><td>{text}<td>x &amp; y</table>", [text, "x & y"]
    if shape == 6:
        return f"<h2><a name=x>{text}</a></h2><p>5 &lt; 7 caf&eacute; &#8212; &#x41;&amp;lt;</p>", [text, "5 < 7 café — A&lt;"]
    if shape == 7:
        return f"<p>{text} <a href='x?a=1&b=2' title='a > b'>link</a>, 3 < 4.</p>", [f"{text} link, 3 < 4."]
    return f"<div>{text}</div>", [text]


def page(rng, wrap):
    title = said(rng, 3, 9)
    parts = [piece(rng) for _ in range(rng.randrange(2, 9))]
    inside = list(parts)
    for _ in range(rng.randrange(3)):
        inside.insert(rng.randrange(len(inside) + 1), (rng.choice(SIDE[8:16])(said(rng)), []))
    body = [rng.choice(SIDE)(said(rng)) for _ in range(rng.randrange(1, 6))]
    article = wrap.format(f"<h1>{title}</h1>" + "".join(markup for markup, _ in inside))
    body.insert(rng.randrange(len(body) + 1), article)
    source = f"<!DOCTYPE html><html lang=en><head><meta charset=utf-8><title>{title}</title></head><body>{''.join(body)}"
    return source + rng.choice(["</body></html>", "", "</div></body></html>", "<a href='cut"]), [title] + [t for _, texts in parts for t in texts]


@pytest.mark.parametrize(
    "wrap", ["<article>{}</article>", "<main><article class='post'>{}</article></main>", "<main id='content'>{}</main>", "<div><div class='has-sidebar'><article>{}</article></div></div>"]
)
def test_round_trip_of_written_pages(wrap):
    rng = random.Random(11)
    for _ in range(150):
        source, expected = page(rng, wrap)
        assert main_blocks(source) == expected, source


def test_without_article_element_ratios_decide():
    rng = random.Random(12)
    hit = wanted = got_all = 0
    for _ in range(100):
        paragraphs = [said(rng, 30, 80) for _ in range(6)] + ["Short one."]
        rng.shuffle(paragraphs)
        links = "".join(f"<div class=x{i}><a href='/{i}'>{said(rng, 1, 4)}</a></div>" for i in range(12))
        text = "".join(f"<p>{p}</p>" for p in paragraphs)
        source = f"<body><div class=top>{links}</div><div class=wrap><h1>Tides</h1><div class=story>{text}</div></div><div class=low>{links} 2020</div></body>"
        found = main_blocks(source)
        expected = ["Tides", *paragraphs]
        hit += sum(1 for b in found if b in expected)
        wanted += len(expected)
        got_all += len(found)
    assert hit / wanted > 0.99 and hit / got_all > 0.99


def test_paths_are_scored_by_text_punctuation_and_links():
    source = "<body><ul class=m><li><a>one two</a><li><a>three four</a></ul><div class=c><p>Long, long text. More of it, and more.</p><p>Yes.</p></div></body>"
    assert main_blocks(source) == ["Long, long text. More of it, and more.", "Yes."]


def test_malformed_and_empty_pages():
    assert main_blocks("") == []
    assert main_blocks("plain & text") == ["plain & text"]
    assert main_blocks("<p>cut off &am") == ["cut off &am"]
    assert main_blocks("<article><p>a<script>x") == ["a"]
    assert main_blocks("<article><p>a<!-- x") == ["a"]
    assert main_blocks("<nav>a</nav><footer>b</footer>") == []
    assert main_blocks("<head><title>t</title><p>text in the head") == ["text in the head"]
    assert main_blocks("</p></div></b><article><p>a</div>b</article>") == ["a", "b"]
    assert main_blocks("<article><p title='it's'>a</p><p class=it's>b</p></article>") == ["a", "b"]
    assert main_blocks("<article><p>a <span style='display:none'>no <b>no</b></span>b<span class=x>c</span></article>") == ["a bc"]
    assert main_blocks("<article>&nbsp; x &nbsp;y\t\n<p>　</p></article>") == ["x y"]
    assert len(Page("<div>" * 3000 + "x").texts) == 1


def test_rows(spark):
    long = "<article>" + "<p>word, word.</p>" * 50_000 + "</article>"
    rows = [(1, "u", "<article><p>a</p><p>b</p></article>", "t"), (1, "u", "<article><p>a</p><p>b</p></article>", "t"), (2, None, None, "t"), (None, "v", "", None), (4, "w", long, "t")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = rows_of(main_text(pages), "page_id")
    text = "\n\n".join(["word, word."] * 50_000)
    assert got == [(None, "v", "", 0), (1, "u", "a\n\nb", 4), (1, "u", "a\n\nb", 4), (2, None, "", 0), (4, "w", text, len(text))]
    assert main_text(pages.limit(0)).count() == 0
