import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimforge.llm import pii_crf as p

# The base patterns as the contract gives them.
PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"\D", "", m[0])
            if kind == 1 and any(int(x) > 255 for x in m[0].split(".")) \
                    or kind == 2 and not (13 <= len(digits) <= 19 and p.luhn(digits)) \
                    or kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_patterns_match_as_defined():
    rnd = random.Random(1)
    parts = ["@", "a", "b.c", ".", "1", "22", "300", " ", "-", "+", "(", ")", "4111 1111 1111 1111", "%", "x@y.z", "é", "\n"]
    for _ in range(5000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        assert p.pattern_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000 + "@", "1" * 200_000, "+1" + " " * 200_000, "1.2.3" * 40_000, "a@" * 60_000):
        p.pattern_spans(text)


def test_messages_are_exact_on_trees():
    rnd = np.random.default_rng(2)
    for _ in range(5):
        n = 4
        unary = rnd.normal(size=(n, p.LABELS))
        chain, skip = rnd.normal(size=(p.LABELS, p.LABELS)), np.diag(rnd.random(p.LABELS))
        edges = [((0, 1), chain), ((2, 1), skip), ((1, 3), skip)]
        weight = {}
        for y in itertools.product(range(p.LABELS), repeat=n):
            weight[y] = np.exp(sum(unary[k, y[k]] for k in range(n)) + sum(q[y[i], y[j]] for (i, j), q in edges))
        total = sum(weight.values())
        want = [[sum(w for y, w in weight.items() if y[k] == c) / total for c in range(p.LABELS)] for k in range(n)]
        links = [(np.array([0]), np.array([1]), chain), (np.array([2, 1]), np.array([1, 3]), skip)]
        assert p.marginals(unary, links) == pytest.approx(np.array(want), abs=2e-3)


def test_a_labelled_mention_pulls_its_other_mentions():
    unary = np.zeros((2, p.LABELS))
    unary[:, p.OTHER] = 1.0                       # both rather nothing,
    unary[0] = [-50, -50, -50, 0, -50]            # but one is observed as a phone
    alone = p.marginals(unary, [])
    linked = p.marginals(unary, [(np.array([0]), np.array([1]), np.diag(np.full(p.LABELS, 4.0)))])
    assert alone[1, 3] < 0.2 < 0.9 < linked[1, 3]


def documents(spark, n=60):
    rnd = random.Random(7)
    rows = []
    for i in range(n):
        tail = f"{rnd.randrange(10**6, 10**7)}"
        rows.append((i, f"call +49 30 {tail} or mail u{i}@example.com in {rnd.randint(1990, 2024)} , room {rnd.randint(1, 99)} . "
                        f"again : {tail} from 10.0.0.{i}"))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_the_field_is_learned_and_patterns_stay(spark):
    docs = documents(spark)
    got = p.find_personal_data(docs).collect()
    assert all(r["n_email"] == 1 and r["n_ip"] == 1 and r["n_phone"] == 1 for r in got)
    texts = dict(docs.collect())
    for r in got:
        listed = r["spans"].split(",")
        assert all(f"{p.KINDS[k]}:{a}:{b}" in listed for k, a, b in p.pattern_spans(texts[r["doc_id"]]))


def dense(rows, steps=300, rate=0.5, decay=1e-3):
    """The same likelihood with a column per feature and a row per token."""
    rows = [r for r in rows for _ in range(r[5])]
    names = sorted({n for r in rows for n in r[0]})
    x = np.array([[n in r[0] for n in names] for r in rows], float)
    one = np.eye(p.LABELS)
    near = [np.array([one[r[k]] if r[k] >= 0 else 0 * one[0] for r in rows]) for k in (2, 3)]
    same = np.array([sum((one[k] for k in r[4]), 0 * one[0]) for r in rows])
    unary, chain, skip = np.zeros((len(names), p.LABELS)), np.zeros((p.LABELS, p.LABELS)), np.zeros(p.LABELS)
    for _ in range(steps):
        z = np.exp(x @ unary + near[0] @ chain + near[1] @ chain.T + same * skip)
        gap = (one[[r[1] for r in rows]] - z / z.sum(axis=1, keepdims=True)) * p.LABELS / len(rows)
        unary, chain, skip = (unary + rate * (x.T @ gap - decay * unary),
                              chain + rate * (near[0].T @ gap + gap.T @ near[1] - decay * chain),
                              skip + rate * ((same * gap).sum(axis=0) - decay * skip))
    return {"names": {n: k for k, n in enumerate(names)}, "unary": unary, "chain": chain, "skip": np.diag(np.maximum(skip, 0))}


def test_counted_rows_learn_what_each_token_alone_would():
    rnd = random.Random(5)
    rows = [(tuple(sorted(rnd.sample("abcdefgh", rnd.randint(1, 4)))), rnd.randrange(p.LABELS), rnd.randint(-1, p.OTHER),
             rnd.randint(-1, p.OTHER), tuple(rnd.randrange(p.LABELS) for _ in range(rnd.randint(0, 2))), rnd.randint(1, 4))
            for _ in range(40)]
    got, want = p.learn(rows), dense(rows)
    assert got["names"] == want["names"]
    for part in ("unary", "chain", "skip"):
        assert got[part] == pytest.approx(want[part], abs=1e-6)


def test_whole_texts_are_learned_from(spark, monkeypatch):
    text = "x1 " * 5000 + "call +49 30 1234567 now"
    seen = []
    monkeypatch.setattr(p, "learn", lambda rows: seen.extend(rows))
    p.train(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string"))
    assert sum(r[5] for r in seen) == 2 * 5003 and sum(r[5] for r in seen if r[1] == 3) == 6
    assert len(seen) < 10                         # equal tokens come as one row
    seen.clear()
    monkeypatch.setattr(p, "SAMPLE_ROWS", 2)
    p.train(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    assert len(seen) == 2


def test_masking():
    assert p.masked("a b@c.de, 10.0.0.1", p.pattern_spans("a b@c.de, 10.0.0.1")) == "a <EMAIL>, <IP>"
    assert p.masked("x", []) == "x"
    assert p.masked("0123456789", [(0, 2, 5), (1, 4, 7), (2, 9, 10)]) == "01<EMAIL>78<CARD>"


def test_nulls_long_texts_repeats_and_clashing_columns(spark):
    rows = [(1, None, 5), (2, "", 0), (3, "é 1.2.3.4", 9), (3, "é 1.2.3.4", 9), (None, "a@b.c", 5), (4, "12 " * 50_000, None),
            (5, "no data", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumn("spans", F.lit(1))
    got = sorted((r["doc_id"] or 0, r["n_email"], r["n_ip"], r["spans"].split(",")[0]) for r in p.find_personal_data(df).collect())
    assert [g for g in got if g[0] != 4] == [(0, 1, 0, "email:0:5"), (1, 0, 0, ""), (2, 0, 0, ""), (3, 0, 1, "ip:2:9"),
                                             (3, 0, 1, "ip:2:9"), (5, 0, 0, "")]
    masked = {(r["doc_id"], r["text"], r["n_chars"], r["spans"]) for r in p.mask_personal_data(df).collect() if r["doc_id"] != 4}
    assert masked == {(1, None, 5, 1), (2, "", 0, 1), (3, "é <IP>", 6, 1), (None, "<EMAIL>", 7, 1), (5, "no data", 7, 1)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert p.find_personal_data(df).collect() == [] and p.mask_personal_data(df).collect() == []
