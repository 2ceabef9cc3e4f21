import duckdb
import pytest
from pyspark.sql import functions as F

from dimforge.llm import line_rules as r
from tests.conftest import SF_SMALL
from tests.test_entry import canon, plan_text

ROW = "doc_id long, text string, source string"
MENU = "Home | News | Contact us today"


def judged(spark, rows):
    return {x["doc_id"]: x for x in r.line_frequency_rules(spark.createDataFrame(rows, ROW)).collect()}


def same_as_sql(spark, rows):
    df = spark.createDataFrame(rows, ROW)
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    cur = con.execute(r.LINE_FREQUENCY_SQL)
    cols, want = [c[0] for c in cur.description], cur.fetchall()
    got = r.line_frequency_rules(df)
    assert sorted(cols) == sorted(got.columns)
    assert canon(got.columns, [tuple(x) for x in got.collect()]) == canon(cols, want)


def body(i, n=12):
    return " ".join(f"word{i}x{k}" for k in range(n))


def corpus():
    rows = [(i, f"{MENU}\n{body(i)}\n\n{body(i + 1000, 3)}", "a") for i in range(30)]
    rows += [(100 + i, f"{MENU}\n{body(i + 5000)}", "b") for i in range(5)]      # too few on this host
    rows += [(200, f"{MENU}\n  HOME |  news | contact us TODAY \nOnly this", "a")]  # depleted
    rows += [(300 + i, f"{body(1)} {body(2)}\n{body(3)}\n{body(4)}", "a") for i in range(40)]  # copies count once
    return rows


def test_boilerplate_by_host_and_depletion(spark):
    got = judged(spark, corpus())
    assert all(got[i]["n_boiler_words"] == 7 and got[i]["kept"] for i in range(30))
    assert all(got[100 + i]["n_boiler_words"] == 0 and got[100 + i]["kept"] for i in range(5))
    assert got[200]["n_boiler_words"] == 14 and not got[200]["base_failed"] and not got[200]["kept"]
    assert all(got[300 + i]["n_boiler_words"] == 0 and got[300 + i]["kept"] for i in range(40))


def shared_lines():
    shared = [f"shared line {k}" for k in range(12)]
    rows = [(i, "\n".join([*shared, body(i, 40)]), "a") for i in range(30)]
    return rows + [(100 + i, "\n".join([*(f"copied line {k}" for k in range(12)), body(99, 40)]), "a") for i in range(30)]


def copies():
    rows = [(i, f"{MENU}\n{body(i)}", "a") for i in range(30)]
    rows += [(1000 + i, f"{body(1)} {body(2)}\n{body(3)}", "a") for i in range(6000)]
    return rows + [(10000 + i, None, "a") for i in range(1000)]


def test_documents_that_share_many_lines_are_told_apart(spark):
    got = judged(spark, shared_lines())
    assert [got[i]["n_boiler_words"] for i in range(30)] == [36] * 30
    assert [got[100 + i]["n_boiler_words"] for i in range(30)] == [0] * 30


def test_copies_and_empty_texts_do_not_raise_the_limit(spark):
    got = judged(spark, copies())
    assert [got[i]["n_boiler_words"] for i in range(30)] == [7] * 30
    assert sum(x["n_boiler_words"] for x in got.values()) == 210


def test_cleaned_texts_keep_their_other_columns(spark):
    df = spark.createDataFrame(corpus(), ROW).withColumn("n_chars", F.length("text")).withColumn(
        "lost", F.lit(1)).withColumn("row", F.lit("r")).withColumn("host", F.lit(2)).withColumn("text_id", F.lit("t"))
    out = r.clean_documents(df)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    got = {x["doc_id"]: x for x in out.collect()}
    assert 200 not in got and len(got) == 75
    assert got[3]["text"] == f"{body(3)}\n\n{body(1003, 3)}" and got[3]["n_chars"] == len(got[3]["text"])
    assert got[100]["text"].startswith(MENU) and got[100]["row"] == "r" and got[100]["lost"] == 1


EDGES = [(1, None, "a"), (2, "", None), (3, " \n\t\x0b\n", "a"), (4, body(1, 9), "a"), (5, body(1, 10), None),
         (6, "a b c d e " * 4, "a"), (7, "a b c d e f a b c d e", "a"), (8, "x " * 30, "b"), (8, "x " * 30, "b"),
         (None, body(3, 11), "a"), (9, "é\nÉ\né\n#*$%&|<>\n#*$%&|<>", "c"), (10, "q\n" * 50, "c"),
         (11, " ".join(f"w{i % 8000}" for i in range(16500)), "a")]


def test_statistics_on_edges(spark):
    same_as_sql(spark, EDGES)


def test_statistics_on_longer_texts_than_packed_positions(spark, monkeypatch):
    monkeypatch.setattr(r, "PACKED_POSITIONS", 3)
    same_as_sql(spark, EDGES)


@pytest.mark.parametrize("rows", [corpus, shared_lines, copies], ids=lambda f: f.__name__)
def test_corpora_as_sql_has_them(spark, rows):
    same_as_sql(spark, rows())
    assert max(x["n_boiler_words"] for x in judged(spark, rows()).values()) > 0


@pytest.mark.parametrize("f", [r.line_frequency_rules, r.clean_documents])
def test_empty_table(spark, f):
    assert f(spark.createDataFrame([], ROW)).collect() == []


def test_no_python_in_the_plans(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for f in (r.line_frequency_rules, r.clean_documents):
        text = plan_text(f(df))
        assert not any(x in text for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
