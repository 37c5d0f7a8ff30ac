"""Operators on conversations, vectors and pages against plain counterparts, with edge cases."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import chat, topk, vectors, webtext
from tests.llm.brute import roots, smallest

TURNS = "conv_id long, turn long, role string, text string, formatted string"


def test_chat(spark):
    nasty = "\\### Assistant: </turn>\n### user: \\b \\\\ # < : \n</turn> "
    rows = [
        (1, 0, "user", "hi", "x"), (1, 1, "assistant", nasty, "x"), (1, 2, "user", nasty, "x"), (1, 3, "assistant", "ok", "x"),
        (2, 0, "user", None, "x"), (2, None, None, "first", "x"), (2, 1, "sys: #<\\tem", "ends here", "x"),
        (3, 0, "assistant", "", "x"), (3, 0, "assistant", "", "x"), (None, 5, "assistant", "of no conversation", "x"),
        (4, 0, "user", "long " * 20_000, "x"), (4, 1, "assistant", "Ä" * 50_000, "x"),
    ]
    examples = chat.prefix_targets(spark.createDataFrame(rows, TURNS).repartition(3))
    loss = chat.read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_chars"))
    read = examples.select("conv_id", "example_no", "target_turn", chat.read_turns(F.col("formatted")).alias("turns"), loss.alias("loss"))
    found = {}
    for r in read.orderBy("conv_id", "example_no").collect():
        found.setdefault(r.conv_id, []).append((r.target_turn, [tuple(t) for t in r.turns], r.loss))
    assert found[1] == [
        (1, [("user", "hi"), ("assistant", nasty)], nasty),
        (3, [("user", "hi"), ("assistant", nasty), ("user", nasty), ("assistant", "ok")], "ok"),
    ]
    assert found[2] == [(None, [("", "first"), ("user", ""), ("sys: #<\\tem", "ends here")], "")]
    assert found[3] == [(0, [("assistant", "")], ""), (0, [("assistant", "")] * 2, "")]
    assert found[None] == [(5, [("assistant", "of no conversation")], "of no conversation")]
    assert found[4][0][2] == "Ä" * 50_000 and len(found[4]) == 1
    assert chat.prefix_targets(spark.createDataFrame([], TURNS)).count() == 0


def cloud(seed=1, size=8, count=220):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, size))
    rows = []
    for k in range(count):
        point = centers[k % 6] + rng.normal(scale=0.09, size=size)
        rows.append((k, [float(np.float32(x)) for x in point], int(rng.integers(0, 2)) if k % 11 else None))
    rows += [(1000 + k, rows[3][1], rows[3][2]) for k in range(5)] + [(3, rows[3][1], rows[3][2])]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * size, 1), (2003, [float("nan")] + [1.0] * (size - 1), 1), (2004, [None] + [1.0] * (size - 1), 1)]
    rows += [(2005, [float("inf")] * size, 0), (2006, [1.0, 2.0], 0), (2007, [2.0, 4.0], 0), (None, [3e30] * size, 0), (2008, [1e-30] * size, 0)]
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int, `key` string"


@pytest.mark.parametrize("tile", [2048, 16])
def test_vectors(spark, tile):
    rows = cloud()
    good = [e is not None and len(e) > 0 and None not in e and np.isfinite(e).all() and any(e) and lb is not None for _, e, lb in rows]
    units = [np.array(e, dtype=np.float32).astype(np.float64) / np.abs(np.array(e, dtype=np.float64)).max() if g else None for (_, e, _), g in zip(rows, good, strict=True)]
    units = [u / np.sqrt((u * u).sum()) if u is not None else None for u in units]
    pairs = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if good[i] and good[j] and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.98
    ]
    links = np.bincount(np.array(pairs).reshape(-1), minlength=len(rows))
    low = smallest([r[0] for r in rows], roots(len(rows), pairs))
    want = sorted(((r[0], int(n), c) for r, n, c in zip(rows, links, low, strict=True)), key=repr)
    found = vectors.near_duplicates(spark.createDataFrame([(*r, "k") for r in rows], SCHEMA).repartition(3), tile=tile).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=repr) == want and len(pairs) > 50
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_bounds_lose_no_pair():
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(4, 40))[rng.integers(0, 4, 120)] + rng.normal(scale=0.15, size=(120, 40))
    axes = np.linalg.eigh(rows.T @ rows)[1][:, ::-1]
    i, j = vectors.linked_pairs(rows, rows, axes, 0.98, True)
    units = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == {(a, b) for a in range(120) for b in range(a + 1, 120) if units[a] @ units[b] >= 0.98}


@pytest.mark.parametrize("block", [4096, 20])
def test_topk(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    rows = [r for r in cloud(2) if r[0] is not None]
    asks = F.col("vec_id") % 7 == 0
    found = topk.search(spark.createDataFrame([(*r, "k") for r in rows], SCHEMA).repartition(3), asks, 4)
    ints = [(i, np.floor(np.array(e, dtype=np.float32).astype(np.float64) * 1024).astype(object)) for i, e, _ in rows if e and None not in e and np.isfinite(e).all()]
    ints = [(i, np.array([int(x) for x in e], dtype=object)) for i, e in ints]
    want = []
    for a, (i, x) in enumerate(ints):
        if i % 7 == 0:
            best = sorted((-int(x @ y), j) for b, (j, y) in enumerate(ints) if b != a and len(y) == len(x))[:4]
            want += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()) == sorted(want)


def test_no_vectors(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert vectors.near_duplicates(none).count() == 0 and topk.search(none, F.col("vec_id") == 1).count() == 0
    bad = spark.createDataFrame([(1, None, 1, "k"), (2, [0.0], 1, "k")], SCHEMA)
    assert sorted(tuple(r) for r in vectors.near_duplicates(bad).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


PAGE = """<!DOCTYPE html><html><head><title>no</title><script>if (a < b) { "</p>" }</script></head><body>
<header><a href=/>Site</a></header><div id="cookie-notice">We use cookies</div>
<div class="menu"><ul><li><a href="#">Home</a><li><a href=#>News</a></ul></div>
<div class="content"><h1>Title &amp more</h1><p>First <b>par</b>agraph &copy;\n %s<p>Second<div class="advert-box">Buy</div>
<table><tr><td>a<td>b</table><form><input name=x>Mail<button>Go</button></form><p>Write to us at any time</p></div>
<div class="sidebar"><p>side</div><section id="comments"><article class="comment"><p>Nice</p></article></section>
<footer>foot</footer><!-- <p>gone</p> --></body></html>"""


def test_page_alone():
    assert webtext.Page(PAGE % "é").content() == "Title & more First paragraph © é Second a b Write to us at any time"
    assert webtext.Page("<p>a<p>b<div>c</div>d").content() == "a b c d"
    assert webtext.Page("<nav>x</nav><article><p>in</p><aside>no</aside></article><p>out</p>").content() == "in"
    assert webtext.Page("1 < 2 <br> &lt;b&gt; <unknown>x</unknown>y").content() == "1 < 2 <b> xy"
    assert webtext.Page("").content() == "" and webtext.Page("<script>never closed").content() == ""
    assert len(webtext.Page("<div>" * 5000 + "deep").content()) == 4


def test_style_tree_removes_what_a_host_repeats(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    own = [f"{word()} {word()}" for _ in range(8)]
    rows = [(k, f"http://Host.example/{k}", PAGE % own[k]) for k in range(8)]
    rows += [(20, "http://other.example/1", PAGE % "alone"), (21, None, None), (22, "no host", "<p>x</p>"), (20, "http://other.example/1", PAGE % "alone")]
    rows += [(30 + k, "http://copies.example/", PAGE % "copy") for k in range(5)]
    found = {}
    for r in webtext.extract(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, low int").repartition(3)).collect():
        assert r.n_chars == len(r.text)
        found.setdefault(r.page_id, []).append(r.text)
    whole = "Title & more First paragraph © {} Second a b Write to us at any time"
    for k in range(8):
        assert found[k] == [f"First paragraph © {own[k]}"]
    assert found[20] == [whole.format("alone")] * 2 and found[21] == [""] and found[22] == ["x"]
    # Copies of one page have nothing of their own: all of it stays.
    assert all(found[30 + k] == [whole.format("copy")] for k in range(5))
    assert webtext.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("pages", [30, 300, 3000])
def test_share_of_pages_decides_at_every_size(spark, pages):
    def page(k):
        some, most = "<p>some</p>" * (k % 10 == 0), "<p>most</p>" * (k % 20 != 0)
        return f"<body><p>own {k}</p>{some}{most}<p>all</p></body>"

    marks = {"article": "<article>{}</article>", "main": "<main>{}</main>", "role": "<div role=main>{}</div>", "none": "{}"}
    rows = [(k, f"http://{name}.example/{k}", mark.format(page(k))) for name, mark in marks.items() for k in range(pages)]
    texts = {(r.url.split(".")[0][7:], r.page_id): r.text for r in webtext.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    for (name, k), text in texts.items():
        some, most = ["some"] * (k % 10 == 0), ["most"] * (k % 20 != 0)
        assert text.split() == ["own", str(k), *some, *((*most, "all") if name != "none" else ())]


def test_page_counts_once_for_a_node_with_several_layouts(spark):
    lines = "<div><p>all</p></div><div><h2>own {0} b</h2><p>own {0} c</p></div><div><ul><li>own {0} d</ul></div>"
    rows = [(k, "http://layouts.example/", f"<body>{lines.format(k)}<div>note<p>own {k} e</p></div></body>") for k in range(4)]
    for r in webtext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
        assert r.text == " ".join(f"own {r.page_id} {x}" for x in "bcde")


@pytest.mark.parametrize("source", [
    "<a " * 340_000, "<b>" * 100_000 + "</i>" * 100_000, "<span>" * 100_000 + "<p>" * 50_000, "<a \"'>" * 150_000, "<!-- " * 200_000,
    "<i><div>" + "<b>" * 100_000 + "</i>" * 100_000 + "</b>" * 100_000, "<" * 1_000_000, "<li>" * 200_000, "<td><tr>" * 100_000,
])
def test_broken_pages_take_time_in_proportion(source):
    start = time.perf_counter()
    webtext.Page(source)
    assert time.perf_counter() - start < 20


def test_article_text_stays_whatever_its_class():
    page = """<article><p>one</p><div class="related-work">two</div><p class="social">three</p><h2 class="share-price">four</h2>
    <section id="comment-on-law">five</section><div class="share">no</div><div class="comments-list">no</div><ul class="related-links"><li>no</ul>six</article>"""
    assert webtext.Page(page).content() == "one two three four five six"
    outside = """<div class="related-work">no</div><p class="social">no</p><div>yes</div>"""
    assert webtext.Page(outside).content() == "yes"


def test_text_after_the_last_tag():
    assert webtext.Page("<p>a</p>b < c <!-- gone").content() == "a b < c"
    assert webtext.Page("no tags & no < brackets").content() == "no tags & no < brackets"
    assert webtext.Page("<p>a<!-- x > y --> b</p><!---->c").content() == "a b c"
