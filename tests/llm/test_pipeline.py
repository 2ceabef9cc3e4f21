import random

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline as cp
from dimforge.llm import packing, pii_crf, queries
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.test_entry import FORBIDDEN, canon, plan_text

NAMES = [name for name, _ in cp.STAGES]


def documents(spark):
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        text = " ".join(rnd.choice(words) for _ in range(40))
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
    near = rows[5][1].rsplit(" ", 1)[0] + " other"
    mail = rows[6][1] + " write to a.b@c.org"
    rows += [(100, rows[5][1], "en", "s1", len(rows[5][1])), (101, near, "en", "s1", len(near)), (102, mail + " now", "de", "s2", 9),
             (103, "too short", "en", "s0", 9), (104, None, "en", "s0", None), (None, "no id " * 3 + rows[7][1], None, None, 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages_in_order_keep_the_columns(spark):
    assert NAMES == ["quality_rules", "near_duplicates", "personal_data", "mixed_sources", "packed_sequences"]
    docs = documents(spark)
    columns = docs.columns
    kept = cp.quality_rules(spark, docs, SF_SMALL)
    assert kept.columns == columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert 103 not in ids and 104 not in ids and set(range(60)) <= ids and None in ids

    unique = cp.near_duplicates(spark, kept, SF_SMALL)
    assert unique.columns == columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect() if r["doc_id"] is not None]
    want = {i for i, (n, c) in brute.near_duplicates(rows).items() if i == c}
    assert {r["doc_id"] for r in unique.collect()} - {None} == want and 100 not in want and 101 not in want

    masked = cp.personal_data(spark, unique, SF_SMALL)
    before, after = ({r["doc_id"]: r["text"] for r in df.collect()} for df in (unique, masked))
    assert masked.columns == columns and all(not pii_crf.pattern_spans(t) for t in after.values())
    assert {k for k in before if before[k] != after[k]} <= {6, 102}

    mixed = cp.mixed_sources(spark, masked, SF_SMALL)
    assert mixed.columns == columns and {r["doc_id"] for r in mixed.collect()} <= set(after)
    assert all(r["text"] == after[r["doc_id"]] for r in mixed.collect())

    packed = cp.packed_sequences(spark, mixed, SF_SMALL)
    used = {r["sequence_id"]: r["n"] for r in packed.groupBy("sequence_id").agg({"length": "sum"}).toDF("sequence_id", "n").collect()}
    assert packed.count() == mixed.count() and all(n <= packing.CAPACITY for n in used.values())


def test_run_over_the_small_tables(spark):
    out = cp.run(spark, SF_SMALL)
    assert out.count() > 0 and "sequence_id" in out.columns


def test_stages_take_empty_tables(spark):
    docs = documents(spark).limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, SF_SMALL).collect() == []


def test_everything_is_registered():
    registered = entry.queries()
    assert "pipeline" in registered
    assert [n for n in registered if n.startswith("op")] == list(queries.QUERIES)
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", queries.ORACLE)
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF_SMALL)
    cur = con.execute(queries.ORACLE[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(got.columns)
    assert canon(got.columns, [tuple(r) for r in got.collect()]) == canon(cols, cur.fetchall())


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLE])
def test_queries_return_rows(spark, name):
    got = queries.QUERIES[name](spark, SF_SMALL)
    assert got.count() > 0
    assert not any(x in plan_text(got) for x in FORBIDDEN if x != "ArrowEvalPython")
