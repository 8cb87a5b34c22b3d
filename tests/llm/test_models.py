"""Classifiers and page extraction: held-out accuracy, calibration, odd input."""

import html
import re
import time

import numpy as np
import pytest

from callsift.llm import html_extraction, quality, toxicity
from callsift.llm.labels import held_out, pool

SF = "/root/testdata/sf0.1"


def test_pool_is_monotone_and_keeps_the_mean():
    y = np.array([0.0, 1, 0, 1, 1, 0, 1])
    x, fitted = pool(np.arange(7.0), y, np.ones(7))
    assert (np.diff(fitted) >= 0).all() and abs(np.interp(np.arange(7.0), x, fitted).sum() - y.sum()) < 1e-9


def accuracy(scored, labels, name):
    rows = scored.join(labels, "doc_id").where(held_out(scored.doc_id)).select("predicted", name).collect()
    assert len(rows) > 500
    return sum(r.predicted == r[name] for r in rows) / len(rows), np.mean([r.predicted for r in rows if r[name] == 1])


@pytest.mark.parametrize(("score", "name", "least"), [(quality.score, "quality", 0.97), (toxicity.score, "toxic", 0.97)])
def test_held_out_accuracy(spark, score, name, least):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    right, recall = accuracy(score(docs, labels), labels, name)
    assert right >= least and recall >= 0.85


@pytest.mark.parametrize(("score", "name"), [(quality.score, "quality"), (toxicity.score, "toxic")])
def test_odd_documents(spark, odd, nothing, score, name):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 19)] + [(1, 0, 0), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = score(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    # Equal texts score alike whatever else the row holds.
    texts = {}
    for r, t in zip(sorted(got, key=lambda r: (r.doc_id or 0)), ()):
        texts.setdefault(t, r.score)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert by_id[1] == by_id[2] == by_id[20] and len(by_id[6] | by_id[7]) == 1
    assert score(nothing, labels).count() == 0
    none = score(odd, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    one = score(odd, labels.where(f"{name} = 1")).collect()
    assert all(r.score >= 0.5 for r in one)


def test_filter_keeps_columns(spark, odd):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 19)], "doc_id long, quality int")
    assert quality.keep_good(odd, labels).columns == odd.columns


def test_normal_equations_of_a_task_done_again_have_the_same_part(spark):
    width = len(quality.STATISTICS)
    rows = spark.createDataFrame([(i, [float(i * j % 7) for j in range(width)], float(i % 2)) for i in range(60)], "doc_id long, x array<double>, y double").repartition(5)
    model = quality.QualityModel(np.zeros(width), np.ones(width), np.ones((width, 3)), np.zeros(3), np.zeros(4))
    one, again = ([(r.part, bytes(r.sums)) for r in quality._equations(rows, model).collect()] for _ in range(2))
    assert one == again and [part for part, _ in one] == list(range(5))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x = "</p><p>no";</script></head><body>
<nav><ul><li><a href="/a">Home</a><li><a href="/b">News of the day</a></ul></nav><div class="cookie-banner">We use cookies. Accept?</div>
<article><h1>Title &amp; more</h1><p>First   <b>bold</b> text that says a thing or two, with a link to <a href=x>somewhere</a>. It goes on.<p>Second &#8212; para&shy;graph
that runs on, for some time. And ends.<div class="ad">Buy now</div><!-- gone <p>no</p> --><ul><li>An item that is part of the text</ul></article>
<aside><p>Related: other things that you may like to read, too.</p></aside><form><p>Your mail</p><input></form><section class="comments"><p>What a great read. I liked it a lot, thank you for it.</p></section><footer>&copy; nobody</footer>"""


def test_page(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (2, "u", None), (3, None, ""), (None, "v", "just text, no tags at all. None."), (1, "u", PAGE), (5, "w", "<" * 50 + "<p <<b>x</p" + "<div>" * 3000)], "page_id long, url string, html string")
    pages = pages.selectExpr("*", "'x' text", "1 n_chars")
    model = html_extraction.train(pages)
    got = html_extraction.extract(pages, model).collect()
    assert len(got) == 6
    own = [r for r in got if r.page_id == 1]
    want = "Title & more\nFirst bold text that says a thing or two, with a link to somewhere. It goes on.\nSecond — para­graph that runs on, for some time. And ends.\nAn item that is part of the text"
    assert [r.text for r in own] == [want] * 2 and own[0].n_chars == len(want)
    assert [(r.text, r.n_chars) for r in got if r.page_id in (2, 3)] == [("", 0)] * 2
    assert html_extraction.extract(pages.limit(0), html_extraction.train(pages.limit(0))).count() == 0


@pytest.mark.parametrize(
    ("tag", "stays"),
    [("<button>", True), ("<object data=x>", True), ("<svg>", True), ("<math>", True), ("<select>", True), ("<option>", True), ("<button>" * 3, True)]
    + [(f"<{x}>", False) for x in ("script", "style", "title", "textarea", "template", "iframe", "noscript")],
)
def test_elements_without_an_end_tag(tag, stays):
    texts = [x[3].strip() for x in html_extraction.parse(f"<body><p>before</p>{tag}<p>after</p><button>no</button><select><option>no<option>no</select><p>last</p>") if x[3]]
    assert texts == (["before", "after", "last"] if stays else ["before"])


def test_options_without_end_tags_leave_what_follows():
    page = "<datalist><option value=a><option>b</datalist><p>text</p><select><optgroup><option>c</option><option>d</optgroup></select><p>more</p>"
    assert [x[3] for x in html_extraction.parse(page) if x[3]] == ["text", "more"]


def test_marginals_are_those_of_full_enumeration():
    forest = html_extraction.Forest(["<body><div><p>One text here. It is.</p><p>two</p></div><nav><a>x</a></nav></body>"])
    model = html_extraction.Potentials()
    n = len(forest.parent)
    own = sum(t[forest.features[:, i]] for i, t in enumerate(model.node))
    kind = html_extraction.EDGE_KIND[forest.group]
    total, each = 0.0, np.zeros(n)
    for code in range(1 << n):
        s = (code >> np.arange(n)) & 1
        weight = own[np.arange(n), s].sum() + sum(model.root[s[i]] if p < 0 else model.edge[kind[i], s[p], s[i]] for i, p in enumerate(forest.parent))
        total += np.exp(weight)
        each += np.exp(weight) * s
    assert np.allclose(model.marginals(forest), each / total)


def test_extraction_of_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in html_extraction.extract(pages, html_extraction.train(pages)).collect()}
    for r in pages.collect():
        inside = r.html.split("<article>")[1].split("</article>")[0]
        blocks = [re.sub("<br>", " ", re.sub("</?b>", "", x)) for x in re.split("</?(?:p|h1)>", inside)]
        assert got[r.page_id] == "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)


def test_texts_of_formulas_and_objects_stay():
    page = "<article><p>Before <math><mi>E</mi><mo>=</mo><mi>m</mi></math> and <object data=x>fallback</object> after <svg><text>shape</text></svg></p></article>"
    assert [html_extraction.clean(x[3]) for x in html_extraction.parse(page) if x[3]] == ["Before E=m and fallback after shape"]


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "</x>" * 100_000, "<p><table>" + "<div>" * 100_000, "<li>" * 100_000 + "</ul>" * 100_000, "<p>a</b>" * 100_000])
def test_parsing_takes_time_in_proportion(page):
    start = time.process_time()
    assert len(html_extraction.parse(page)) >= 100_000 and time.process_time() - start < 20


def test_an_element_between_keeps_an_outer_one_open():
    nodes = html_extraction.parse("<div>one<table><tr><td>cell<td>next<div>in</div></table>out<p>two</p></div>")
    texts = {x[3]: x[0] for x in nodes if x[3]}
    assert list(texts) == ["one", "cell", "next", "in", "out", "two"] and texts["one"] == texts["out"] != texts["two"] and texts["cell"] != texts["next"]
