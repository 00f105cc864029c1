"""Very long single texts: time in proportion to their length, and right results."""

from __future__ import annotations

import time

import pytest

from cladeworks.llm import extract, line_dedup, mixing, near, quality, substring

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_lines_of_long_texts(spark):
    """Ten documents of 60,000 lines, half of them common."""
    n = 60_000
    rows = [(i, "\n".join(f"common {k}" if k % 2 else f"own {i} {k}" for k in range(n)), "en", "s", 0) for i in range(10)]
    began = time.time()
    got = line_dedup.drop_common_lines(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert time.time() - began < 90
    assert all(r.n_lines == n and r.n_dropped == n // 2 and r.text == "\n".join(f"own {r.doc_id} {k}" for k in range(0, n, 2)) for r in got)


def test_lines_that_repeat_in_a_long_text(spark):
    rows = [(0, "\n".join(["again", "again"] * 100_000), "en", "s", 0)] + [(i, "again", "en", "s", 0) for i in range(1, 9)]
    assert not any(r.n_dropped for r in line_dedup.drop_common_lines(spark.createDataFrame(rows, SCHEMA)).collect())  # nine documents hold it


def test_words_of_long_texts(spark):
    long = " ".join(f"w{i}" for i in range(400_000))
    df = spark.createDataFrame([(1, long, "en", "a", 0), (2, long + " tail", "en", "a", 0), (3, "x" * 3_000_000, "en", "b", 0)], SCHEMA)
    assert {r.doc_id: r.n_removed for r in substring.drop_repeats(df).collect()} == {1: 400_000, 2: 400_000, 3: 0}
    assert {r.doc_id: (r.class_id, r.n_links) for r in near.near_duplicates(df).collect()} == {1: (1, 1), 2: (1, 1), 3: (3, 0)}
    assert {r.doc_id: (r.n_words, r.n_repeat_words) for r in quality.with_counts(df).collect()} == {1: (400_000, 0), 2: (400_001, 0), 3: (1, 0)}
    assert {r.doc_id: r["size"] for r in mixing.mix_sources(df).collect()} == {1: 400_000, 2: 400_001, 3: 1}


@pytest.mark.parametrize("source", ["<div>" * 30_000 + "text" + "</section>" * 30_000, "<p>a</p>" * 60_000, "<ul>" + "<li>a" * 60_000, "<div><span " + "a='b' " * 60_000 + ">x", "<" * 200_000, "<a href=\"" * 50_000])
def test_pages_in_linear_time(source):
    model = extract.Model()
    began = time.time()
    model.text(source)
    assert time.time() - began < 20


@pytest.mark.parametrize("source", ["<li><ul>" + "<blockquote>" * 20_000 + "</li>" * 20_000, "<blockquote>" * 20_000 + "<dd></dd>" * 20_000, "<tr><td>" * 30_000, "<div>" + "<table>" * 20_000 + "</p>" * 20_000])
def test_end_tags_search_nothing(source):
    began = time.time()
    extract.Page(source)
    assert time.time() - began < 10


def test_blocks_of_the_article_stay():
    page = "<html><body><nav><a href=1>Menu</a></nav><article><h1>A</h1><p>one two three</p><div>A plain block of the article with some words</div><p>let <math><mi>y</mi></math> be</p><div class='alert-study'><p>A paragraph of the study that matters here.</p></div><section>And more</section><div class='alert'><p>We use cookies</p></div><div class='comments'><p>rude</p></div></article><footer>end</footer>"
    assert extract.default_model().text(page).split("\n") == ["A", "one two three", "A plain block of the article with some words", "let y be", "A paragraph of the study that matters here.", "And more"]
