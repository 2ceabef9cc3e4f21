import random

import pytest
from pyspark.sql import functions as F

from dimforge.llm import suffix_dedup as sd
from tests.llm import brute


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for k, v in more.items():
        df = df.withColumn(k, v)
    return [(*tuple(r)[:4], bytes(r["kept"])) for r in sd.remove_repeats(df).collect()]


def check(spark, rows):
    got = {i: (n, gone, spans, kept) for i, n, gone, spans, kept in run(spark, rows)}
    for i, (x, mask) in brute.removed_bytes(rows).items():
        spans = sum(m and not (k and mask[k - 1]) for k, m in enumerate(mask))
        assert got[i] == (len(x), sum(mask), spans, bytes(b for b, m in zip(x, mask, strict=True) if not m)), i


def pieces(seed):
    rnd = random.Random(seed)
    pool = ["".join(rnd.choice("abcdé ") for _ in range(rnd.choice([40, 90, 99, 100, 101, 130, 300]))) for _ in range(8)]
    rows = []
    for i in range(60):
        parts = [rnd.choice(pool) if rnd.random() < .6 else "".join(rnd.choice("xyz ñ") for _ in range(rnd.randint(0, 120)))
                 for _ in range(rnd.randint(0, 6))]
        rows.append((i, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_random_passages(spark, seed):
    check(spark, pieces(seed))


def test_periodic_texts(spark):
    check(spark, [(1, "ab" * 300), (2, "a" * 500), (3, "ab" * 60 + "c"), (4, "a" * 99), (5, "a" * 100), (6, "abc" * 200)])


def test_long_documents_in_segments(spark, monkeypatch):
    monkeypatch.setattr(sd, "SEGMENT", 700)
    monkeypatch.setattr(sd, "CHUNK", 300)
    check(spark, pieces(4) + [(100, "".join(t for _, t in pieces(4))[:6000])])


def test_buckets_sorted_a_few_rows_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(sd, "SORT_ROWS", 3)
    check(spark, pieces(6))


def test_large_buckets_in_parts(spark, monkeypatch):
    monkeypatch.setattr(sd, "BUCKET_RUNS", 3)
    check(spark, pieces(7))


def test_nulls_empty_repeats_and_clashing_columns(spark):
    s = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(150))
    rows = [(1, None), (2, ""), (3, s), (4, s), (4, s), (None, s), (None, "short")]
    got = run(spark, rows, doc=F.lit(1), meta=F.lit(2), bucket=F.lit("b"), packed=F.lit(None))
    assert sorted(map(repr, got)) == sorted(map(repr, [
        (1, 0, 0, 0, b""), (2, 0, 0, 0, b""), (3, 150, 0, 0, s.encode()),
        (4, 150, 150, 1, b""), (4, 150, 150, 1, b""), (None, 150, 150, 1, b""),
        (None, 5, 0, 0, b"short")]))


def test_empty_table(spark):
    assert run(spark, []) == []


def test_very_many_rows_without_id(spark):
    """Far more rows than 16 bits of a text tell apart; each is a version of the last document."""
    rnd = random.Random(8)
    shared = "".join(rnd.choice("abcdefgh ") for _ in range(140))
    texts = ["".join(rnd.choice("ijklmnop ") for _ in range(rnd.choice([17, 120, 300]))) for _ in range(2000)]
    got = run(spark, [(1, shared), *((None, t) for t in texts), *[(None, shared)] * 5])
    want = [(1, 140, 0, 0, shared.encode()), *[(None, 140, 140, 1, b"")] * 5, *((None, len(t), 0, 0, t.encode()) for t in texts)]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_versions_with_one_short_tag(spark, monkeypatch):
    monkeypatch.setattr(sd, "_text_tag", lambda flat, bounds: sd.np.zeros(len(bounds) - 1, sd.np.int64))
    rnd = random.Random(9)
    a, b, c = ("".join(rnd.choice("abcdefgh ") for _ in range(478)) for _ in range(3))
    got = {bytes(k) or t: gone for (_, n, gone, _, k), t in zip(run(spark, [(1, a), (None, a), (None, b), (None, c[:17])]),
                                                               "wxyz", strict=True)}
    assert sorted(got.values()) == [0, 0, 0, 478]
    assert {x for x in got if isinstance(x, bytes)} == {a.encode(), b.encode(), c[:17].encode()}
