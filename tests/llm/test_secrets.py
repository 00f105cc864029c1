"""Secret scans against plain Python, and the models on held-out strings."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import string
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cladeworks.llm import secrets as S

WORDS = "the house river stone garden window project number system account service manager config handler update request response server client message".split()


def steps(token):
    at = [S.ALPHABET.find(c) + 1 for c in f" {token.lower()} "]
    return [S.STATES * a + b for a, b in zip(at, at[1:])]


def base(text):
    out = []
    for kind, p in S.KINDS.items():
        for m in re.finditer(p, text):
            if kind != "assign" or len(m[2]) >= 6:
                out.append((kind, m.start(), m.end()))
    return out


def brute(texts):
    """Spans of each text, by models trained plainly on all of them."""
    seen, made, plain = Counter(), Counter(), Counter()
    for text in texts:
        for kind, p in S.KINDS.items():
            for m in re.finditer(p, text):
                value = m[2] if kind == "assign" else m[0]
                if len(value) >= 8:
                    seen.update(steps(value))
        for token in re.findall(S.ORDINARY, re.sub(S.KINDS["assign"], " ", text)):
            if not re.search(S.KINDS["access"], token) and not re.search(S.KINDS["hex"], token):
                plain.update(steps(token))
    for i in range(S.RANDOM_STRINGS):
        h = hashlib.sha256(f"random string {i}".encode())
        b = base64.b64encode(h.digest()).decode()
        cut = re.sub("[+/=]", "", b)
        for token in (h.hexdigest(), h.hexdigest().upper(), b, cut, cut.upper()):
            made.update(steps(token))

    def share(counts, step):
        state = step // S.STATES
        return (counts[step] + S.SMOOTH) / (sum(counts[state * S.STATES + k] for k in range(S.STATES)) + S.SMOOTH * S.STATES)

    bits = [math.log2((share(seen, k) + share(made, k)) / 2 / share(plain, k)) for k in range(S.STATES**2)]
    out = []
    for text in texts:
        spans = base(text)
        new = [(S.MODEL, m.start(), m.end()) for m in re.finditer(S.TOKEN, text) if sum(bits[k] for k in steps(m[0])) >= S.PRIOR_BITS]
        spans += [n for n in new if not any(b[1] < n[2] and b[2] > n[1] for b in spans)]
        out.append(sorted(spans, key=lambda s: (s[1], [*S.KINDS, S.MODEL].index(s[0]))))
    return out


def corpus(seed=3, n=120):
    r = random.Random(seed)
    any_of = lambda letters, k: "".join(r.choices(letters, k=k))
    pieces = [
        lambda: r.choice(["password", "Token", "API_KEY", "apikey", "secret", "PassWd"]) + r.choice(["=", ": ", "  :", '" = "', "'='"]) + any_of(string.ascii_letters + "0123456789+/_.=-", r.choice([3, 6, 20])),
        lambda: "AKIA" + any_of(string.ascii_uppercase + string.digits, r.choice([2, 15, 16, 30])), lambda: any_of("0123456789abcdef", r.choice([10, 23, 24, 64])),
        lambda: any_of(string.ascii_letters + string.digits, 32), lambda: "token:secret:abcdefgh", lambda: "AKIAAKIA" + any_of("ABC1", 16), lambda: "É漢😀" + any_of("abc", 2), lambda: "passwordpassword=x=tokentoken",
    ]
    return [" ".join(r.choice(pieces)() if r.random() < 0.15 else r.choice(WORDS) for _ in range(r.randrange(80))) + r.choice(["", "\n", " \n\n x"]) for _ in range(n)]


def spans(rows):
    return [[(s.kind, s.start, s.end) for s in r.spans] for r in rows]


def test_against_plain_python(spark):
    texts = ["", *corpus()]
    got = S.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    want = brute(texts)
    assert spans(got) == want and sum(s[0] == S.MODEL for w in want for s in w) > 50


def test_edges(spark):
    many = " ".join(f"{hashlib.sha256(str(i).encode()).hexdigest()}" for i in range(1000)) + " " + "zq1" * 50_000
    rows = [(1, None), (None, "token=abcdef1"), (2, ""), (2, ""), (3, many), (4, "é" * 5000 + " secret: 'abcdef'")]
    docs = spark.createDataFrame([(*r, "s", "e") for r in rows], "doc_id long, text string, spans string, end string")
    out = S.scan(docs)
    got = {(r.doc_id, r.text): [(s.kind, s.start, s.end) for s in r.spans] for r in out.collect()}
    assert out.columns == ["doc_id", "text", "end", "spans"] and out.count() == 6
    assert got[(1, None)] == got[(2, "")] == [] and got[(None, "token=abcdef1")] == [("assign", 0, 13)] and got[(4, rows[5][1])] == [("assign", 5001, 5016)]
    assert [s for s in got[(3, many)] if s[0] == "hex"] == [("hex", 65 * i, 65 * i + 64) for i in range(1000)]
    assert S.scan(docs.limit(0)).collect() == []


def test_no_python_on_the_main_path(spark, capsys):
    docs = spark.createDataFrame([(1, "token=abcdef1")], "doc_id long, text string")
    S.scan(docs).explain()
    S.train(*S.labelled(docs)).explain()
    said = capsys.readouterr().out
    assert "Python" not in said and "Arrow" not in said and "Exchange" not in said.split("== Physical Plan ==")[1]


@pytest.mark.parametrize("letters,least", [(string.ascii_letters + string.digits, 0.99), (string.ascii_uppercase + "234567", 0.99), ("0123456789ABCDEF", 0.95), (string.ascii_lowercase, 0.95)])
def test_held_out_strings(spark, letters, least):
    """Random strings that training has not seen are found; identifiers of the corpus's words, in forms that it never has, are not."""
    r = random.Random(11)
    docs = spark.createDataFrame([(i, " ".join(r.choices(WORDS, k=60))) for i in range(200)], "doc_id long, text string")
    bits = S.as_literal(S.train(*S.labelled(docs)))
    random_ones = ["".join(r.choices(letters, k=20)) for _ in range(400)]
    w = lambda: r.choice(WORDS)
    plain = [f() for _ in range(200) for f in (lambda: f"{w()}_{w()}_{w()}", lambda: f"{w()}-{w()}-{w()}-{w()}", lambda: f"{w()}/{w()}/{w()}", lambda: (w() + w() + w()).upper(), lambda: w() + w().title() + w().title())]
    rows = spark.createDataFrame([(t, 1) for t in random_ones] + [(t, 0) for t in plain], "t string, label int").select("label", (S.score(F.col("t"), bits) >= S.PRIOR_BITS).alias("hit"))
    rate = {x.label: x.rate for x in rows.groupBy("label").agg(F.avg(F.col("hit").cast("int")).alias("rate")).collect()}
    assert rate[1] >= least and rate[0] <= 0.01
