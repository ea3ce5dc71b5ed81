import html as references
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gradewise.llm import queries
from gradewise.llm.html_extraction import (
    Grammar,
    MarkedBuilder,
    blocks_of,
    decode,
    extract_main_text,
    fit_extractor,
    fit_trees,
    main_texts,
    never_main,
    parse,
    text_of,
)

SF_DIR = "/root/testdata/sf0.01"
SENTENCES = [f"This is sentence number {i}, which says {i * 7} things about it." for i in range(300)]


@pytest.fixture(scope="module")
def trees():
    return fit_extractor(SENTENCES)


def article_of(page):
    """The test tables' pages: headings and paragraphs of the one article."""
    inside = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S)[1]
    blocks = re.split(r"</?(?:h1|p)>", inside.replace("<br>", " "))
    texts = [" ".join(references.unescape(re.sub(r"</?b>", "", b)).split()) for b in blocks]
    return " ".join(t for t in texts if t)


def test_query_gives_the_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    rows = queries.op4_html_extraction(spark, SF_DIR).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        assert (r.text, r.n_chars, r.url) == (article_of(pages[r.page_id].html), len(r.text), pages[r.page_id].url)


def test_layouts_not_trained_on(trees):
    grammar, exact = Grammar(SENTENCES, seed=77), 0
    for _ in range(300):
        page = grammar.page()
        builder = MarkedBuilder()
        builder.feed(page)
        builder.close()
        blocks = blocks_of(builder.root)
        keep = np.array([id(b.node) in builder.marked or b.parent < 0 or b.node.tag == "html" for b in blocks])
        exact += main_texts([page], trees) == [text_of(blocks, keep)]
    assert exact / 300 > 0.93


def test_usual_page_without_article_element(trees):
    page = """<html><head><title>t</title><script>var a = "<p>no</p>";</script></head><body>
    <div id="top-menu"><ul><li><a href=/>Home</a><li><a href=/a>About us</a></ul></div>
    <div class="cookie-banner">We use cookies. <button>OK</button></div>
    <div class="content"><h1>Fish &amp; chips</h1><p>First   paragraph, with <a href=x>a link</a> in it.
    <p>Second one&nbsp;here; it is longer and says more.</p><div class="ad">Buy this now.</div>
    <p>Third paragraph, the last one of this story.</p></div>
    <div class="sidebar"><h3>Popular</h3><ul><li><a href=1>One</a></li></ul></div>
    <section id="comments"><div class="comment"><p>Nice story, I liked reading it.</p></div></section>
    <form><label>Mail</label><input name=m></form><footer>&copy; 2020 Somebody</footer></body></html>"""
    assert main_texts([page], trees) == [
        "Fish & chips First paragraph, with a link in it. Second one here; it is longer and says more. "
        "Third paragraph, the last one of this story."
    ]


@pytest.mark.parametrize("page", ["", "plain text", "<p>one<p>two", "</div></p>", "<div" * 50, "<b><i>x</b>y</i>", "a<!-- c", "<![CDATA[x]]>"])
def test_broken_markup_never_fails(trees, page):
    assert isinstance(main_texts([page], trees)[0], str)


def test_plain_text_and_deep_nesting(trees):
    assert main_texts(["just  words"], trees) == ["just words"]
    deep = "<div>" * 3_000 + "<p>text in the deep, quite far down.</p>"
    assert isinstance(main_texts([deep], trees)[0], str)


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_decoding_is_consistent_and_best(data):
    n = data.draw(st.integers(1, 9))
    page = "".join(data.draw(st.sampled_from(["<div>ab", "<p>x</p>", "</div>", "<section>y"])) for _ in range(n))
    blocks = blocks_of(parse(page))
    odds = np.array([data.draw(st.floats(-5, 5)) for _ in blocks])
    keep = decode(blocks, odds)
    assert all(keep[b.parent] for b, k in zip(blocks[1:], keep[1:]) if k)
    weight = np.array([1 + np.log1p(b.own) for b in blocks])

    def value(kept):
        return float(np.where(kept, weight * odds, -weight * odds)[1:].sum())

    best = max(
        value(kept)
        for bits in range(2 ** (len(blocks) - 1))
        for kept in [np.array([True, *[bits >> i & 1 == 1 for i in range(len(blocks) - 1)]])]
        if all(kept[b.parent] for b, k in zip(blocks[1:], kept[1:]) if k)
    )
    assert value(keep) == pytest.approx(best)


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3_000, 4)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    assert np.mean((fit_trees(x, y).log_odds(x) > 0) == y) > 0.97


def test_odd_rows(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, ""), (2, "v", "<p>hello there, dear reader.</p>"), (3, "w", "<p>" + "long words, many. " * 20_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS text", "2 AS id")
    out = extract_main_text(pages)
    assert out.columns == [*pages.columns, "main_text"]
    texts = {str(r.page_id): r.main_text for r in out.collect()}
    assert texts["1"] == texts["None"] == "" and out.count() == len(rows)
    assert texts["3"] == ("long words, many. " * 20_000).strip()
    assert extract_main_text(pages.filter("false")).count() == 0


@pytest.mark.parametrize("head", [
    "<head><title>t</title>",
    "<head><meta charset=utf-8><title>t</title><script>var a = 1;</script>",
    "<head><title>t</title><noscript><img src=x></noscript><link rel=icon href=x>",
])
@pytest.mark.parametrize("body", ["<body>", ""])
def test_an_unclosed_head_ends_where_the_body_begins(trees, head, body):
    story = "".join(f"<p>{s}</p>" for s in SENTENCES[:6])
    page = f"<html>{head}{body}<article><h1>Story</h1>{story}</article><footer>&copy; 2020 Somebody</footer></html>"
    closed = page.replace(head, f"{head}</head>")
    assert main_texts([page], trees) == main_texts([closed], trees) == [" ".join(["Story", *SENTENCES[:6]])]


def test_text_ends_a_head():
    root = parse("<html><head><title>t</title>plain words<b>more</b></html>")
    blocks = blocks_of(root)
    assert text_of(blocks, np.ones(len(blocks), bool)) == "plain wordsmore"


def test_formulas_are_text(trees):
    formula = "<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>x=2</annotation></semantics></math>"
    table = "<math><mtable><mtr><mtd>1</mtd><mtd>2</mtd></mtr></mtable></math>"
    story = "".join(f"<p>{s}</p>" for s in SENTENCES[:4])
    page = f"<html><body><article>{story}<p>We see that {formula} holds, as does {table}, for all.</p></article></body></html>"
    assert main_texts([page], trees) == [" ".join([*SENTENCES[:4], "We see that x=2 holds, as does 1 2, for all."])]


@pytest.mark.parametrize(
    "page",
    [
        "<b>" * 100_000 + "</i>" * 100_000,
        "<i><table>" + "<b>" * 100_000 + "</i>" * 100_000,
        "<p>" + "<b>" * 100_000 + "<p>x" * 50_000,
        "<ul>" + "<li><b>x" * 50_000,
        "<td>" * 100_000,
        "<div>" * 100_000 + "</span></div>" * 50_000,
    ],
)
def test_faulty_markup_takes_time_in_proportion(page):
    start = time.process_time()
    parse(page)
    assert time.process_time() - start < 6


FOOTER = " ".join(f"This is footer sentence {i}, as long as the ones of an article." for i in range(6))


@pytest.mark.parametrize("end", ["footer", "nav", "form", "menu"])
def test_page_ends_menus_and_forms_are_no_main_text(trees, end):
    page = f"<html><body><article><p>Short one, and a whole sentence.</p></article><{end}><p>{FOOTER}</p></{end}></body></html>"
    assert main_texts([page], trees) == ["Short one, and a whole sentence."]


def test_a_form_around_the_page_keeps_its_article(trees):
    body = "".join(f"<p>{s}</p>" for s in SENTENCES[:8])
    page = f"<html><body><form><article>{body}</article><footer><p>{FOOTER}</p></footer></form></body></html>"
    assert main_texts([page], trees) == [" ".join(SENTENCES[:8])]


def test_a_quotation_keeps_its_source(trees):
    body = "".join(f"<p>{s}</p>" for s in SENTENCES[:8])
    quote = "<blockquote><p>To quote this sentence, name its author.</p><footer>A named author of the sentence.</footer></blockquote>"
    blocks = blocks_of(parse(f"<article>{body}{quote}</article>"))
    assert not never_main(blocks).any()
