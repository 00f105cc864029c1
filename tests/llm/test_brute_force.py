"""Operators and the pipeline against plain Python, and the SQL of those that have it."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import os
import random
import re

import duckdb
import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from cladeworks.llm import decontaminate, extract, html_pages, mixing, near, quality, queries, substring, toxicity

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return SPACE.findall(text or "")


def some_docs(seed=1):
    """doc_id, text, lang, source, n_chars with copies, near copies, shared lines and passages, junk and leaks; and the benchmark."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcdefghijklmnop", k=r.randint(3, 8))) for _ in range(3000)]
    text = lambda n: "\n".join(" ".join(r.choices(vocabulary, k=10)) for _ in range(n // 10))
    bench = [(i, " ".join(r.choices(vocabulary, k=30)).capitalize() + ".") for i in range(5)]
    passage = " ".join(r.choices(vocabulary, k=60))
    docs = [text(r.choice([30, 60, 120, 400])) for _ in range(60)]
    docs += [docs[0], docs[0], docs[3]]
    near_copy = docs[5].split(" ")
    near_copy[7] = "edited"
    docs.append(" ".join(near_copy))
    docs += [text(40) + "\nA shared line " + "\n" + text(20) for _ in range(12)]
    docs += [text(50) + "\n" + passage + "\n" + text(30) for _ in range(4)]
    docs += [text(60) + "\n" + re.sub(r"[^a-z ]", "", bench[k][1].lower()) + "\n" + text(30) for k in (0, 3)]
    docs += ["short text", "", " ".join(["again"] * 80), None]
    return [(i, t, "en", f"s{i % 4}", len(t or "")) for i, t in enumerate(docs)], bench


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    show = lambda v: "NULL" if pd.isna(v) else f"{float(v):.8g}" if not isinstance(v, str) else v
    rows = lambda df: sorted(tuple(show(v) for v in x) for x in df[sorted(df.columns)].astype(object).itertuples(index=False))
    assert rows(queries.QUERIES[name](spark, SF).toPandas()) == rows(con.sql(queries.ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_without_sql_runs(spark, name):
    queries.QUERIES[name](spark, SF).collect()


def brute_substring(rows, window):
    ws = {i: words_of(t) for i, t, *_ in rows}
    seen = collections.Counter(tuple(w[k : k + window]) for w in ws.values() for k in range(len(w) - window + 1))
    out = {}
    for i, w in ws.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone.update(range(k, k + window))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def test_substring_against_brute_force(spark):
    rows, _ = some_docs()
    r = random.Random(5)
    for k in range(100, 140):  # few different words: many repeats, branches and overlaps
        rows.append((k, " ".join(r.choices("abc", k=r.randint(1, 90))) if k % 2 else " ".join("ab" * 30 + "c" * (k % 7) + "ab" * 20), "en", "s", 0))
    for window, anchor in ((35, 8), (12, 4)):
        got = {x.doc_id: (x.n_words, x.n_removed, x.text) for x in substring.drop_repeats(spark.createDataFrame(rows, SCHEMA), window, anchor).collect()}
        assert got == brute_substring(rows, window)


def brute_near(rows, n=5, threshold=0.8):
    shingled = {}
    for i, t, *_ in rows:
        w = words_of(t)
        shingled[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    texts = {i: t or "" for i, t, *_ in rows}
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = collections.defaultdict(set)
    for a, b in itertools.combinations(sorted(texts), 2):
        both = len(shingled[a] & shingled[b])
        if texts[a] == texts[b] or (both and both >= threshold * len(shingled[a] | shingled[b])):
            parent[max(find(a), find(b))] = min(find(a), find(b))
        if texts[a] != texts[b] and both and both >= threshold * len(shingled[a] | shingled[b]):
            links[a].add(texts[b])
            links[b].add(texts[a])
    return {i: (find(i), len(links[i])) for i in texts}


def test_near_against_brute_force(spark, monkeypatch):
    rows, _ = some_docs()
    r = random.Random(2)
    base = [f"x{i}" for i in range(120)]
    for k in range(200, 240):  # one dense group of different texts
        w = list(base)
        for _ in range(r.randint(0, 6)):
            w[r.randrange(120)] = f"y{r.randrange(1000)}"
        rows.append((k, " ".join(w), "en", "s", 0))
    want = brute_near(rows)
    for block in (400, 7):  # whole groups, and groups dealt over pairs of blocks
        monkeypatch.setattr(near, "BLOCK", block)
        got = {x.doc_id: (x.class_id, x.n_links) for x in near.near_duplicates(spark.createDataFrame(rows, SCHEMA), recall=0.99999, max_hashes=400).collect()}
        assert got == want


def test_bands_reach_the_recall():
    bands, rows = near.choose_bands(0.8, 0.999, 150)
    assert bands * rows <= 150 and 1 - (1 - 0.8**rows) ** bands >= 0.999


def test_quality_counts_against_brute_force(spark):
    rows, _ = some_docs()
    for x in quality.with_counts(spark.createDataFrame(rows, SCHEMA)).collect():
        w = words_of(x.text)
        windows = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        covered = {k + j for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for j in range(8)}
        lines = [y for y in (x.text or "").split("\n") if words_of(y)]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x.text or "")), len(lines) - len(set(lines)), len(covered))


def plain_cutoffs(rows, labels, risk=0.05, delta=0.05, price=50.0):
    """Cutoffs by stratum: the path laid on one half, tested on the other, document by document."""
    import zlib

    def scores(text):
        w, lines = words_of(text), [y for y in text.split("\n") if words_of(y)]
        chars, n = sum(map(len, w)), len(w)
        windows = collections.Counter(tuple(w[k : k + 8]) for k in range(n - 7))
        covered = {k + j for k in range(n - 7) if windows[tuple(w[k : k + 8])] > 1 for j in range(8)}
        if n < 20 or 100 * len(covered) > 30 * n:
            return None
        upper = sum(c.isupper() and (c.isascii() or "À" <= c <= "Þ") for c in text)
        return dict(symbols=sum(c in "#*$%&|<>" for c in text) / n, marks=text.count("!") / n, upper=upper / chars, dup_lines=(len(lines) - len(set(lines))) / len(lines), repeats=len(covered) / n, long_words=chars / n, short_words=-chars / n)

    known = [(lang, labels[i], zlib.crc32(str(i).encode()) % 2, s) for i, text, lang, *_ in rows if i in labels and (s := scores(text))]
    rules, found = {r: cuts for r, (_, cuts) in quality.rules().items()}, {}
    rejects = lambda at, s: any(n and s[r] > rules[r][n - 1] for r, n in at.items())
    paths = {}
    for lang in {k[0] for k in known}:
        lay, at, path = [k for k in known if k[0] == lang and k[2] == 0], dict.fromkeys(rules, 0), []
        gain = lambda to: sum(1 if k[1] == 0 else -price for k in lay if rejects(to, k[3]) and not rejects(at, k[3]))  # noqa: B023, E731
        while lay:
            g, to = 0, None
            for r in rules:
                for n in range(at[r] + 1, len(rules[r]) + 1):
                    if (x := gain(at | {r: n})) > g:
                        g, to = x, at | {r: n}
            if not to:
                break
            at = to
            path.append(at)
        if path:
            paths[lang] = path
    for lang, path in paths.items():
        held, best = [k for k in known if k[0] == lang and k[2] == 1], 0
        total, found[lang] = sum(k[1] for k in held), {}
        for step in path:
            lost, won = (sum(k[1] == y and rejects(step, k[3]) for k in held) for y in (1, 0))
            if not total or sum(math.comb(total, i) * risk**i * (1 - risk) ** (total - i) for i in range(lost + 1)) > delta / len(paths):
                break
            if won - price * lost > best:
                best, found[lang] = won - price * lost, step
    return {i: (s := scores(text)) is not None and not rejects(found.get(lang, {}), s) for i, text, lang, *_ in rows}, found


def test_quality_verdicts_against_plain_calibration(spark):
    """Three languages: two rules at work in one, a rule that good documents break as often in another, too few labels in the third."""
    r = random.Random(17)

    def text(symbols, marks):
        w = ["".join(r.choices("abcdefgh", k=r.randint(2, 9))) for _ in range(50)]
        return " ".join(x + "#" * (r.random() < symbols) + "!" * (r.random() < marks) for x in w)

    rows, labels = [], {}
    for i in range(1500):
        lang, bad = ("en", "de", "fr")[0 if i < 700 else 1 if i < 1420 else 2], r.random() < 0.25
        kind = r.random()
        if lang == "de":
            said = text(0.5 if r.random() < 0.3 else 0, 0.02)
        else:
            said = text(0.6, 0) if bad and kind < 0.5 else text(0, 0.5) if bad else text(0.05, 0.04)
        rows.append((i, said, lang, "s", 0))
        if r.random() < 0.8:
            labels[i] = int(not bad)
    want, cuts = plain_cutoffs(rows, labels)
    table = spark.createDataFrame([(i, y, 0) for i, y in labels.items()], "doc_id long, quality int, toxic int")
    got = {x.doc_id: x.kept for x in quality.judge(spark.createDataFrame(rows, SCHEMA), table).select("doc_id", "kept").collect()}
    assert got == want
    assert set(k for k, n in cuts["en"].items() if n) == {"symbols", "marks"} and not any(cuts.get("de", {}).values()) and not any(cuts.get("fr", {}).values())
    assert all(got[i] for i, y in labels.items() if y and rows[i][2] == "en")


def test_quality_bounds_hold(spark):
    r = random.Random(3)
    good = lambda: " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 9))) for _ in range(60))
    bad = lambda: " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 9))) + "###" for _ in range(60))
    rows = [(i, bad() if i % 10 == 0 else good(), "en", "s", 0) for i in range(3000)]
    labels = spark.createDataFrame([(i, int(i % 10 > 0), 0) for i in range(2000)], "doc_id long, quality int, toxic int")
    out = quality.judge(spark.createDataFrame(rows, SCHEMA), labels).select("doc_id", "kept").collect()
    fresh = [x for x in out if x.doc_id >= 2000]
    assert all(x.kept for x in fresh if x.doc_id % 10) and not any(x.kept for x in fresh if x.doc_id % 10 == 0)
    assert abs(quality.tail(3, 50, 0.1) - sum(np.prod([np.arange(50 - k + 1, 51).prod() if k else 1]) / np.prod(np.arange(1, k + 1)) * 0.1**k * 0.9 ** (50 - k) for k in range(4))) < 1e-9


def test_toxicity_on_held_out_documents(spark):
    r = random.Random(4)
    plain = ["".join(r.choices("abcdefghilmnorstu", k=r.randint(2, 8))) for _ in range(400)]
    rude = ["zwerkop", "vexxil", "qorbat"]
    rows, labels = [], []
    for i in range(1500):
        w = r.choices(plain, k=r.randint(15, 80))
        toxic = i % 6 == 0
        for _ in range(3 if toxic else 0):
            w[r.randrange(len(w))] = r.choice(rude) + r.choice(["", "s", "ing", "eth"])
        rows.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    out = toxicity.score(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    held = [x for x in out if x.held_out]
    assert len(held) > 200 and all(0 <= x.score <= 1 for x in out)
    assert sum(x.predicted == int(x.doc_id % 6 == 0) for x in held) >= 0.97 * len(held)


def test_decontamination_and_paraphrase(spark):
    rows, bench = some_docs()
    words = bench[1][1].split()
    swapped = [w if k % 6 else "synonym" for k, w in enumerate(words)]  # a paraphrase that keeps the answer
    rows.append((900, "start of it " + " ".join(swapped) + " and more", "en", "s", 0))
    df, b = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(bench, "item_id long, text string")
    got = {(x.doc_id, m.item_id) for x in decontaminate.flag(df, b).collect() for m in x.matches}
    n = len(some_docs()[0])
    assert got == {(n - 6, 0), (n - 5, 3), (900, 1)}


def test_lcs_bits():
    r = random.Random(6)
    for _ in range(50):
        a, b = [r.randrange(6) for _ in range(r.randint(1, 40))], [r.randrange(6) for _ in range(r.randint(0, 60))]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.lcs(decontaminate.masks_of(np.array(a)), len(a), b) == table[-1][-1]


def test_extraction_on_held_out_pages():
    model = extract.default_model()
    wrong = blocks = 0
    for seed in range(5000, 5200):
        page = extract.Page(html_pages.labelled_page(seed))
        p, _, _ = model.marginals(page, extract.features(page))
        for i, _ in page.blocks:
            blocks += 1
            wrong += (p[i] >= 0.5) != bool(page.label[i])
    assert blocks > 1000 and wrong <= 0.01 * blocks


def test_marginals_are_exact():
    """Against the sum over all states of a small tree."""
    model = extract.train(html_pages.labelled_page(i) for i in range(40))
    page = extract.Page("<body><nav><ul><li>a</li></ul></nav><div><p>some text here</p></div></body>")
    found = extract.features(page)
    p, _, _ = model.marginals(page, found)
    n, total, ones = len(page.tag), 0.0, [0.0] * len(page.tag)
    for state in itertools.product((0, 1), repeat=n):
        score = sum(model.weights.get(f, 0.0) for i in range(n) if state[i] for f in found[i])
        score += sum(model.edges[extract.GROUPS.get(page.tag[i], 0)][2 * state[page.parent[i]] + state[i]] for i in range(1, n))
        z = float(np.exp(score))
        total += z
        for i in range(n):
            ones[i] += z * state[i]
    assert all(abs(a - b / total) < 1e-9 for a, b in zip(p, ones))


def brute_mix(rows, weights=(5, 2, 1), budget=1.5, most=2):
    size = {i: len(words_of(t)) for i, t, *_ in rows}
    by = collections.defaultdict(list)
    for row in rows:
        by[row[3]].append(row)
    names = sorted(by)
    total = {s: sum(size[r[0]] for r in by[s]) for s in names}
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, capped, left = {}, set(), budget * sum(total.values())
    while True:
        free = [s for s in names if s not in capped]
        level = left / sum(w[s] for s in free) if free else 0
        over = [s for s in free if level * w[s] > most * total[s]]
        if not over:
            target |= {s: level * w[s] for s in free}
            break
        for s in over:
            capped.add(s)
            target[s] = most * total[s]
            left -= target[s]
    copies = {}
    for s in names:
        whole = int(round(target[s], 6) // total[s]) if total[s] else 0
        rest, low = round(target[s], 6) - whole * total[s], 0
        place = lambda r: int(hashlib.md5(f"{r[0]}|{hashlib.md5((r[1] or '').encode()).hexdigest()}".encode()).hexdigest()[:15], 16)
        for r in sorted(by[s], key=place):
            upto = low + size[r[0]]
            copies[r[0]] = whole + int(rest > 0 and (upto < rest or (low < rest and upto - rest < rest - low)))
            low = upto
    return copies, target


def test_mix_against_brute_force(spark):
    rows, _ = some_docs()
    copies, target = brute_mix(rows)
    got = mixing.mix_sources(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {x.doc_id: x.copies for x in got} == copies and all(abs(x.target - target[x.source]) < 1e-5 for x in got)


def test_pipeline_against_brute_force(spark, tmp_path):
    rows, bench = some_docs()
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {x.doc_id: (x.text, x.n_chars, x.copies) for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    def passes(t):
        w = words_of(t)
        windows = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        covered = {k + j for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for j in range(8)}
        return len(w) >= 20 and 100 * len(covered) <= 30 * len(w)

    left = [r for r in rows if passes(r[1])]
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    often = collections.Counter(k for r in left for k in {key(x) for x in r[1].split("\n")} if k)
    left = [(r[0], "\n".join(x for x in r[1].split("\n") if often[key(x)] < 10), *r[2:]) for r in left]
    classes = brute_near(left)
    left = [r for r in left if classes[r[0]][0] == r[0]]
    grams = {tuple(w[k : k + 8]) for _, t in bench for w in [re.findall(r"[a-z]+", t.lower())] for k in range(len(w) - 7)}
    left = [r for r in left if not any(tuple(w[k : k + 8]) in grams for w in [re.findall(r"[a-z]+", r[1].lower())] for k in range(len(w) - 7))]
    copies, _ = brute_mix(left)
    assert got == {r[0]: (r[1], len(r[1]), copies[r[0]]) for r in left if copies[r[0]]}
