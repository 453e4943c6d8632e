"""Operators 1 and 2: the chain against enumeration, held-out accuracy, pages with known articles."""

import zlib

import numpy as np
import pytest
from adsphere.llm import html_text, toxicity
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F


def forward_backward(scores, transitions, start):
    """One document, step by step."""
    e = np.exp(np.stack([np.zeros(len(scores)), scores], 1))
    t = np.exp(transitions)
    alpha, beta = [np.exp(start) * e[0]], [np.ones(2)]
    for i in range(1, len(scores)):
        alpha.append(alpha[-1] @ t * e[i])
    for i in range(len(scores) - 1, 0, -1):
        beta.append(t @ (e[i] * beta[-1]))
    beta.reverse()
    z = alpha[-1].sum()
    pairs = sum((np.outer(alpha[i - 1], e[i] * beta[i]) * t / z for i in range(1, len(scores))), np.zeros((2, 2)))
    return np.array([(a * b / z)[1] for a, b in zip(alpha, beta, strict=True)]), pairs


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 150), min_size=1, max_size=6), st.integers(0, 10**6))
def test_chain_is_exact(lengths, seed):
    rng = np.random.default_rng(seed)
    n = sum(lengths)
    scores, t, s = rng.normal(0, 3, n), rng.normal(0, 1, (2, 2)), rng.normal(0, 1, 2)
    ends = np.cumsum(lengths)
    first = np.zeros(n, bool)
    first[ends - lengths] = True
    marginal, pairs = toxicity.chain_marginals(scores, first, t, s, pairs=True)
    parts = [forward_backward(scores[e - k:e], t, s) for e, k in zip(ends, lengths, strict=True)]
    assert np.allclose(marginal, np.concatenate([p[0] for p in parts]))
    assert np.allclose(pairs, sum(p[1] for p in parts))


BAD = ["grumblefoo", "grumblebar", "vilewort"]


def made_documents(n=240):
    rng = np.random.default_rng(5)
    docs, labels = [], []
    for i in range(n):
        words = [f"w{rng.integers(400)}" for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(4):
                words[rng.integers(40)] = BAD[rng.integers(3)]
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_learns_planted_words_and_marks_them(spark):
    docs, labels = made_documents()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity_report(d, lab).collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert r.predicted == int(r.doc_id % 5 == 0) == int(r.score >= 0.7)
        text = docs[r.doc_id][1]
        for span in filter(None, r.toxic_spans.split(";")):
            a, b = map(int, span.split(":"))
            assert set(text[a:b].split()) <= set(BAD)
    kept = toxicity.drop_toxic(d, lab)
    assert kept.columns == d.columns and kept.count() == sum(not r.predicted for r in rows)


def test_held_out_labels_teach_nothing(spark):
    docs, labels = made_documents(90)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    flip = spark.createDataFrame([(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels],
                                 "doc_id long, quality int, toxic int")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    a, b = ({r.doc_id: r.score for r in toxicity.toxicity_report(d, x).collect()} for x in (lab, flip))
    assert a == b


def test_sample_is_full_and_bounded(spark):
    """Long texts use up no place in the sample, and a repeated id gives one row."""
    docs, labels = made_documents()
    free = [i for i, *_ in docs if zlib.crc32(str(i).encode()) % 3 != 1]
    short = {y: [i for i in free if (i % 5 == 0) == y][-5:] for y in (True, False)}
    keep = set(short[True] + short[False])
    docs = [(i, text if i in keep else text + " long" * 5000) for i, text in docs]
    docs += [d for d in docs if d[0] == short[False][0]] * 50
    rows = toxicity.training_sample(spark.createDataFrame(docs, "doc_id long, text string"),
                                    spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), 5, 5).collect()
    assert sorted(r.doc_id for r in rows) == sorted(keep)
    assert all(r.toxic == (r.doc_id % 5 == 0) for r in rows)


def test_toxicity_edge_cases(spark, edge_docs, no_docs, small):
    labels = small("labels")
    rows = toxicity.toxicity_report(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.drop_toxic(edge_docs, labels).columns == edge_docs.columns
    assert toxicity.toxicity_report(no_docs, labels).count() == 0
    none = labels.withColumn("toxic", F.lit(None).cast("int"))
    assert {r.score for r in toxicity.toxicity_report(edge_docs, none).collect()} == {0.0}


PAGES = [
    ("<html><body><nav>Menu <a>one</a></nav><article><h1>Title &amp; more</h1><p>First <b>bold</b> part.<p>Second\n  part"
     "<br>goes on.</p><ul><li>item</li></ul></article><footer>foot</footer></body></html>",
     "Title & more\nFirst bold part.\nSecond part goes on.\nitem"),
    ("<body><header><h1>Site</h1></header><div id='main-content'><p>" + "A long enough paragraph of words. " * 5
     + "</p><p>Short.</p></div><aside>side</aside><div class='cookie-notice'>We use cookies</div>"
     "<div class=comments><p>reader says hi</p></div><form><label>Name</label><input></form>",
     ("A long enough paragraph of words. " * 5).strip() + "\nShort."),
    ("<p>only text", "only text"), ("", ""), (None, ""), ("<script>var a='</p>';</script>", ""),
    ("plain words, no tags", "plain words, no tags"),
    ("<article><style>p{}</style><!-- note --><p>a &lt;b&gt; &#233; &nbsp; c</p><div class='advert'>buy</div></article>",
     "a <b> é c"),
    ("<article><p>one<article><p>two</article></article>", "one\ntwo"),
]


@pytest.mark.parametrize(("html", "text"), PAGES)
def test_pages(html, text):
    assert html_text.main_text(html) == text


def test_many_pages(spark, small):
    pages = spark.createDataFrame([(i, None, h) for i, (h, _) in enumerate(PAGES)] + [(None, "u", "<p>x")],
                                  "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    rows = {r.page_id: r for r in html_text.extract_pages(pages).collect()}
    assert [rows[i].text for i in range(len(PAGES))] == [t for _, t in PAGES] and rows[None].text == "x"
    assert all(r.n_chars == len(r.text) for r in rows.values())
    assert html_text.extract_pages(pages.limit(0)).count() == 0
    real = html_text.extract_pages(small("pages")).join(small("pages"), "page_id").collect()
    for r in real:
        inner = r.html.split("<article>")[1].split("</article>")[0]
        assert len(r.text) > 0 and "<div class=" not in inner and r.text.split("\n")[0][:20] in " ".join(
            html_text.main_text("<article>" + inner + "</article>").split("\n"))


def test_very_long_page():
    html = "<body><div>" + "<p>some words of a paragraph</p>" * 20_000 + "</div></body>"
    assert html_text.main_text(html).count("\n") == 19_999


def test_region_comes_from_the_ratio():
    teasers = "".join(f"<p><span><a><i>t{i}</i></a></span><span><a>more</a></span></p>" for i in range(12))
    html = f"<body><section><div>{teasers}</div></section><section><p>{'Real article words here. ' * 20}</p><p>End.</p></section>"
    assert html_text.main_text(html).startswith("Real article") and html_text.main_text(html).endswith("End.")


LONG = "Real article words stand here in a row. " * 8
MENU = "<ul>" + "".join(f"<li><a href='/{i}'>item {i}</a></li>" for i in range(8)) + "</ul>"


@pytest.mark.parametrize("html", [
    f"<body><nav>{MENU}</nav><article><h1>Title</h1><p>By A. Writer<div><p>{LONG}<p>{LONG}</div></article></body>",
    f"<body>{MENU}<div><h1>Title</h1><p>By A. Writer<div><p>{LONG}<p>{LONG}</div></div></body>",
    f"<body><nav>m</nav><div><h1>Title</h1><section><p>By A. Writer</section><section><p>{LONG * 30}</section></div></body>",
    f"<body><nav>m</nav><h1>Title</h1><ul><li>By A. Writer</ul><p>{LONG}<p>{LONG}<footer>f</footer></body>",
    f"<body><nav>m</nav><main><h1>Title</h1><p>By A. Writer<blockquote><p>{LONG * 30}</blockquote><p>End.</main></body>",
])
def test_region_holds_the_whole_article(html):
    lines = html_text.main_text(html).split("\n")
    assert lines[:2] == ["Title", "By A. Writer"] and lines[2].startswith("Real article")
    assert not any(line.startswith(("item", "m", "f")) for line in lines)


@pytest.mark.parametrize(("html", "text"), [
    (f"<body><div class='layout has-sidebar'><div class='sidebar'>{MENU}</div><div><p>{LONG}</div></div>", LONG.strip()),
    (f"<body class='no-sidebar toc-enabled'><div class='page-search-wrap'><article><p>{LONG}</article></div>", LONG.strip()),
    (f"<div class='search-algorithms'><p>{LONG}</div>", LONG.strip()),
    (f"<article><p>{LONG}<h2 id='legal-issues'>Legal issues</h2><section id='related-work'><p>Work.</section>"
     "<div id='comments'>hi</div></article>", LONG.strip() + "\nLegal issues\nWork."),
    (f"<html><head><title>t</title><meta charset=utf-8><body><main><article><p>{LONG}</article></main>", LONG.strip()),
    (f"<head><title>t</title><p>{LONG}", LONG.strip()),
])
def test_names_and_open_heads_do_not_empty_pages(html, text):
    assert html_text.main_text(html) == text


def test_runs_of_the_sample_change_nothing(monkeypatch):
    texts = ["you zorkish fool again", "a fine zorkish day", "plain words here", "nothing to see", "zorkish", ""] * 30
    texts = [f"{t} {i % 7} w{i}x" for i, t in enumerate(texts)]
    labels = [int("zorkish" in t) for t in texts]
    whole = toxicity.fit(texts, labels)
    monkeypatch.setattr(toxicity, "RUN_TOKENS", 13)
    split = toxicity.fit(texts, labels)
    assert np.allclose(whole.weights, split.weights) and np.allclose(whole.document, split.document)


def test_spans_where_lower_case_is_longer():
    texts = [f"a {w} day number {i}" for i in range(40) for w in ("zorkish", "sunny", "rainy")]
    model = toxicity.fit(texts, [int("zorkish" in t) for t in texts])
    text = "İİ zorkish day"
    scores, spans = toxicity.Scorer(model).score([text, text.replace("İ", "i")])
    assert spans[0] == spans[1] == [(3, 10)] and abs(scores[0] - scores[1]) < 0.2
