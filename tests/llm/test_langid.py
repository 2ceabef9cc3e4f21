import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dimforge.llm import langid as g

VOICES = {"aa": "ka to mi ra no shi te", "bb": "the and ing er of with ly", "cc": "zu und der sch ein keit ung"}


def sentence(rnd, lang, n=40):
    s = VOICES[lang].split()
    return " ".join("".join(rnd.choice(s) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def test_normalised_characters():
    code, bounds = g.characters(pa.array(["Ab, c!1d", None, "", "  É", "12 3", "𝒳a"]))
    rows = ["".join(map(chr, code[a:b])) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert rows == [" ab c d", " ", " ", " é", " ", " \uffffa"]
    packed, limits = g.grams(code, bounds)
    assert np.diff(limits).tolist() == [len(r) - 1 for r in rows]
    assert packed[0] == (32 << 48) | (32 << 32) | (32 << 16) | ord("a")


def test_probabilities_sum_to_one():
    text = "banana bandana"
    packed, _ = g.grams(*g.characters(pa.array([text])))
    codes, counts = np.unique(packed, return_counts=True)
    letters = sorted(set(text))
    model = g.CharacterModel(codes, counts, len(letters))
    for history in ("  b", "ban", "nan", "xyz", "zan"):
        head = sum(ord(c) << (16 * (3 - k)) for k, c in enumerate(history))
        wanted = np.array([head | ord(c) for c in [*letters, "?"]], np.uint64)
        assert np.exp2(-model.bits(wanted)).sum() == pytest.approx(1.0)


def test_remembered_scores_are_the_models():
    rnd = random.Random(1)
    packed, bounds = g.grams(*g.characters(pa.array([sentence(rnd, "aa", 300), sentence(rnd, "bb", 300)])))
    codes, counts = np.unique(packed, return_counts=True)
    model = g.CharacterModel(codes, counts, 20)
    scorer = g.Scorer([model])
    for _ in range(2):
        got = scorer(packed, bounds)[:, 0]
        assert got == pytest.approx([model.bits(packed[a:b]).mean() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], rel=1e-5)


def test_languages_are_told_apart(spark):
    rnd = random.Random(2)
    rows = [(i, sentence(rnd, lang), lang) for i, lang in enumerate(list(VOICES) * 80)]
    rows += [(-1, None, "aa"), (-2, "12 !!", "bb"), (-3, "", None), (None, sentence(rnd, "bb"), "zz"), (1, rows[1][1], "bb"),
             (-4, sentence(rnd, "cc", 30000), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("h", F.lit(1)).withColumn("n", F.lit(2))
    got = g.identify(df).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == lang for i, _, lang in rows if i is not None and i >= 0)
    for i in (-1, -2, -3):
        assert (by[i]["lang_pred"], by[i]["score"]) == (g.UNKNOWN, 0.0)
    assert by[None]["lang_pred"] == "bb" and by[None]["held_out"] is False and by[-4]["lang_pred"] == "cc"
    assert all(0 <= r["score"] <= 1 for r in got)
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got if r["doc_id"] is not None)


def test_noise_is_rejected(spark):
    rnd = random.Random(3)
    rows = [(i, sentence(rnd, lang), lang) for i, lang in enumerate(list(VOICES) * 80)]
    trained = g.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    noise = spark.createDataFrame([(1, "qxj vwq xqj wvx jjq " * 10), (2, sentence(rnd, "aa"))], "doc_id long, text string")
    assert {r["doc_id"]: r["rejected"] for r in g.predict(noise, trained).collect()} == {1: True, 2: False}


def test_nothing_learned_and_empty_table(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in g.identify(df).collect()] == [g.UNKNOWN]
    assert g.identify(df.limit(0)).collect() == []


def test_held_out_accuracy_on_the_small_tables(spark):
    from tests.conftest import SF_SMALL

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    both = g.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    assert both.where("lang_pred = lang").count() >= 0.95 * both.count() > 0


def test_wide_characters_that_are_no_letters(spark):
    rows = [(i, f"the cat sat on the mat number {i}", "en") for i in range(40)]
    rows += [(100, "\U0001F600\U0001F680 \U0001F4A9", None), (101, "\U00010400\U00010428", None), (102, "123 \u2603", None)]
    got = {r["doc_id"]: r["lang_pred"] for r in g.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[100] == got[102] == "und" and got[101] != "und"


def test_many_languages_are_all_learned(spark):
    """None is left out, however many there are."""
    rnd = random.Random(3)
    alphabet = [chr(c) for c in range(0x4E00, 0x4E00 + 2600)]
    rows = [(k * 20 + i, "".join(rnd.choice(alphabet[k * 5:k * 5 + 5]) for _ in range(40)), f"l{k}") for k in range(520) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(g.train(df)[0]) == 520


def test_no_text_is_moved_to_find_the_sample(spark):
    rows = spark.createDataFrame([(i, "wort " * 50, "de" if i % 2 else "en") for i in range(40)], "doc_id long, text string, lang string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sample = g.sampled(rows)
        plan = sample._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and sample.count() == 40
