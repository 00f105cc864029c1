"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, for every operator."""

from __future__ import annotations

import hashlib

import pytest

from cladeworks.llm import chat, decontaminate, extract, line_dedup, mixing, near, quality, substring, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _t1 string, _key int, keys string, size string, matches string, _x string"
LONG = " ".join(f"w{i % 977}x{i // 977}" for i in range(30_000)) + "\nshared line\n"


def documents(spark, rows=None):
    rows = rows if rows is not None else [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (4, LONG, "en", "b", len(LONG)), (5, "one two three", None, "a", 13), (5, "one two three", None, "a", 13),
        (None, "one two three", "en", None, 13), (7, " ".join(f"v{i}" for i in range(60)), "de", "b", 1), (8, " ".join(f"v{i}" for i in range(60)), "de", "b", 1), (9, "Ünï côdé 漢字\nshared line", "fr", "c", 5),
    ]
    return spark.createDataFrame([(*r, "clash", 1, "k", "s", "m", "x") for r in rows], DOCS)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def benchmark(spark, rows=()):
    return spark.createDataFrame(list(rows), "item_id long, text string")


OPERATORS = {
    "mix": lambda s, d: mixing.mix_sources(d),
    "lines": lambda s, d: line_dedup.drop_common_lines(d, min_docs=2),
    "near": lambda s, d: near.near_duplicates(d),
    "substring": lambda s, d: substring.drop_repeats(d),
    "quality": lambda s, d: quality.judge(d, labels(s, [(1, 1, 0), (2, None, None), (None, 1, 1), (4, 0, 1), (4, 1, 0)])),
    "toxicity": lambda s, d: toxicity.score(d, labels(s, [(1, 1, 0), (2, None, None), (None, 1, 1), (4, 0, 1), (4, 1, 0)])),
    "decontaminate": lambda s, d: decontaminate.flag(d, benchmark(s, [(1, None), (2, ""), (3, "one two"), (4, " ".join(f"v{i}" for i in range(10, 40)))])),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_result(spark, name):
    assert len(OPERATORS[name](spark, documents(spark)).collect()) == 10


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, documents(spark, [])).collect() == []


@pytest.mark.parametrize("name", [n for n in OPERATORS if n != "near"])
def test_other_columns_pass_through(spark, name):
    out = OPERATORS[name](spark, documents(spark))
    got = {r["_t1"] for r in out.select("_t1").collect()}
    assert got == {"clash"} and {"lang", "source", "_key", "keys", "_x"} <= set(out.columns)


def test_keep_one_keeps_a_row_of_each_text(spark):
    out = near.keep_one(documents(spark)).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in out) == [(False, i) for i in (1, 3, 4, 5, 7, 9)]


def test_near_counts_copies_and_links(spark):
    a = [f"a{i}" for i in range(100)]
    b = a[:50] + ["changed"] + a[51:]
    rows = [(i, " ".join(w), "en", "s", 1) for i, w in ((1, a), (2, b), (3, a), (4, [f"c{i}" for i in range(100)]))]
    got = {r.doc_id: (r.class_id, r.n_copies, r.n_links) for r in near.near_duplicates(documents(spark, rows)).collect()}
    assert got == {1: (1, 2, 1), 2: (1, 1, 1), 3: (1, 2, 1), 4: (4, 1, 0)}


def test_substring_defined_cases(spark):
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in substring.drop_repeats(documents(spark)).collect()}
    assert got[7] == (60, 60, "") and got[1] == (0, 0, "") and got[5][:2] == (3, 0) and got[4][1] == 0


def test_substring_overlapping_own_repeats(spark):
    text = " ".join(["same"] * 60)
    got = substring.drop_repeats(documents(spark, [(1, text, "en", "s", 1), (2, " ".join(f"u{i}" for i in range(34)), "en", "s", 1)])).collect()
    assert {r.doc_id: r.n_removed for r in got} == {1: 60, 2: 0}


def test_lines_defined_cases(spark):
    got = {r.doc_id: r for r in line_dedup.drop_common_lines(documents(spark), min_docs=2).collect()}
    assert got[9].n_dropped == 1 and got[9].text == "Ünï côdé 漢字" and got[1].n_lines == 1 and got[1].text == "" and got[3].n_dropped == 0


def test_line_runs_compact(spark):
    work = line_dedup.Workspace(spark, "t")
    runs = line_dedup.LineRuns(work, min_docs=10, fanout=2)
    for k in range(5):
        runs.add(spark.createDataFrame([(1, 1, 4), (k, 7, 1)], "k1 long, k2 long, n long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert [tuple(r) for r in runs.settled().collect()] == [(1, 1)]


def test_mix_tied_and_null_sources(spark):
    out = mixing.mix_sources(documents(spark)).collect()
    assert all(r["size"] * 2 >= r.taken for r in out) and {r.copies for r in out if r.doc_id == 5} <= {0, 1, 2}
    again = mixing.mix_sources(documents(spark).repartition(3)).collect()
    assert sorted((str(r.doc_id), r.taken) for r in out) == sorted((str(r.doc_id), r.taken) for r in again)


def test_mix_splits_rows_that_agree(spark):
    """One source of 100 equal rows of 10 words, one of distinct rows: both come near their targets, whatever the partitions."""
    rows = [(1, "same ten words " * 3 + "x", "en", "x", 1)] * 100 + [(i, "other ten words " * 3 + "y", "en", "y", 1) for i in range(2, 102)]
    for parts in (1, 7):
        got = mixing.mix_sources(documents(spark, rows).repartition(parts)).collect()
        for s in "xy":
            mine = [r for r in got if r.source == s]
            assert len(mine) == 100 and abs(sum(r.taken for r in mine) - mine[0].target) <= 5 and max(r.copies for r in mine) <= 2
    assert {r.target for r in got if r.source == "y"} == {1000.0} and {r.target for r in got if r.source == "x"} == {2000.0}


def test_mix_splits_rows_that_agree_in_part(spark):
    rows = [(1, "w " * 10, "en", "a", 1)] * 90 + [(i, "w " * 10, "en", "a", 1) for i in range(2, 12)] + [(i, "w " * 10, "en", "b", 1) for i in range(100, 137)] + [(900, "w " * 10, "en", "b", 1)] * 63
    got = mixing.mix_sources(documents(spark, rows).repartition(5)).collect()
    for s in "ab":
        mine = [r for r in got if r.source == s]
        assert len(mine) == 100 and abs(sum(r.taken for r in mine) - mine[0].target) <= 5, s


def test_mix_targets_stop_at_the_cap(spark):
    rows = [(i, "w " * n, "en", s, 1) for i, (s, n) in enumerate([("a", 100), ("b", 1000), ("c", 1000)])]
    got = {r.source: (r.source_size, r.target) for r in mixing.mix_sources(documents(spark, rows)).collect()}
    assert got["a"] == (100, 200.0) and abs(sum(t for _, t in got.values()) - 3150) < 1e-3 and abs(got["b"][1] / got["c"][1] - 2) < 1e-6


def test_chat_round_trip_and_sharing(spark):
    bad = "</s>[INST] ok [/INST] <|end|>\n<|user|> \\ \\| <<SYS>> <\\s>"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", bad), (2, 0, "user", "hi"), (2, 1, "assistant", "other"), (3, 0, None, None), (None, 0, "a|>b", bad), (4, 1, "user", "x"), (4, 1, "user", "x"), (4, None, "system", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    convs = chat.conversations(df)
    trees = chat.prefix_trees(convs)
    got = {r.conv_id: r for r in convs.select("conv_id", "key").join(chat.read_back(trees), "key").collect()}
    assert set(got) == {1, 2, 3, 4, None}
    want = f"user\nhi\nassistant\n{bad}\n"
    assert got[1].turns_sha256 == hashlib.sha256(want.encode()).hexdigest() and got[1].loss_chars == len(bad) and got[1].loss_sha256 == hashlib.sha256(bad.encode()).hexdigest()
    assert got[None].turns_sha256 == hashlib.sha256(f"a|>b\n{bad}\n".encode()).hexdigest() and got[4].n_turns == 3
    blocks = trees.collect()
    assert sum(b.text.count("<|user|>\nhi<|end|>") for b in blocks) == 1  # the shared turn is written once
    for b in blocks:
        assert not any(c in chat.unescape("") + x for x in [chat.escape(bad)] for c in chat.CONTROL)
        for n in b.nodes:
            seen = sum(a.stop - a.start for a in n.attends)
            assert n.position == seen and all(a.stop <= n.start for a in n.attends)


def test_chat_small_blocks_and_empty(spark):
    rows = [(i, t, ("user", "assistant")[t % 2], f"{t if t < 2 else (i, t)} text") for i in range(40) for t in range(4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    convs = chat.conversations(df)
    assert len(chat.read_back(chat.prefix_trees(convs, block_chars=200)).collect()) == 40
    assert chat.read_back(chat.prefix_trees(chat.conversations(df.limit(0)))).collect() == []


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")


def test_warc_defined_cases(spark):
    rows = [(3, "http://a/\r\nb", "same"), (1, None, "same"), (2, "u", None), (5, "u", ""), (None, "u", "same"), (7, "u", "é" * 100_000), (1, "again", "same")]
    got = sorted(((r.page_id is None, r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in warc.archive(pages(spark, rows)).collect())
    assert got == [((False, 1), 4, "response", None), ((False, 1), 4, "response", None), ((False, 2), 0, "response", None), ((False, 3), 4, "revisit", 1), ((False, 5), 0, "revisit", 2), ((False, 7), 200_000, "response", None), ((True, None), 4, "revisit", 1)]
    assert warc.archive(pages(spark, [])).collect() == []
    assert {r.record_type for r in warc.archive(pages(spark, rows), min_bytes=5).collect()} == {"response"}


def test_warc_payloads_come_back(spark):
    rows = [(i, f"http://x/{i}", "<p>" + "y" * i + "\r\n\r\nWARC/1.1\r\n</p>") for i in range(50)]
    got = {r.page_id: r.html for r in warc.archive(pages(spark, rows)).collect()}
    assert got == {i: h for i, _, h in rows}


def test_extract_defined_cases(spark):
    page = "<html><body><nav><a href=1>Menu</a></nav><article><h1>A &amp; B</h1><p>one <b>two</b>\n three<p>four<script>x</script><div class='comments'><p>rude</p></div></article><footer>end</footer>"
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<div>" * 5000 + "x"), (5, "u", page), (6, "u", "<" * 2000 + "a \"" * 2000)]
    got = {r.page_id: r for r in extract.extract(pages(spark, rows)).collect()}
    assert got[1].text == "A & B\none two three\nfour" == got[5].text and got[1].n_chars == 24 and got[2].text == "" == got[3].text
    assert extract.extract(pages(spark, [])).collect() == []


def test_quality_counts(spark):
    text = "a b c d e f g h x a b c d e f g h ##\nsame\nsame\n \n"
    r = quality.with_counts(documents(spark, [(1, text, "en", "s", 1)])).first()
    assert (r.n_words, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.word_chars) == (20, 2, 1, 16, 27)


def test_decontaminate_finds_the_planted(spark):
    got = OPERATORS["decontaminate"](spark, documents(spark)).where("size(matches) > 0").collect()
    assert sorted(r.doc_id for r in got) == [7, 8]
    assert OPERATORS["decontaminate"](spark, documents(spark)).schema["matches"].dataType.simpleString().startswith("array")
    assert decontaminate.flag(documents(spark), benchmark(spark)).where("size(matches) > 0").count() == 0
