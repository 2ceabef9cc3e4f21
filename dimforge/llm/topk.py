"""Exact top-k inner products, term at a time.

Vectors are integers per dimension.  Candidates are kept as posting lists, a
list per dimension and block of vectors, queries as sparse rows.  Each block of
queries meets each block of candidates once: for every term of a query, the
weighted postings are added into a dense score array; the k best of the block
are selected by partition, and the blocks' lists merged by query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimforge.llm.shared import batch_of, store

SCALE = 256
BLOCK_CANDIDATES = 8192
BLOCK_QUERIES = 512


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """``(vec_id, weights)``: floor(256 * x); vectors that are null or hold null, NaN or infinity are left out."""
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                           F.col("embedding").cast("array<double>").alias("embedding"))
            .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
            .select("vec_id", F.transform("embedding", lambda v: F.floor(v * SCALE)).alias("weights")))


def _blocks(size: int):
    """Rows (block, vec_id, weights) sorted by block -> a row per block: ids, dimensions, weights by dimension."""
    schema = pa.schema([("block", pa.int64()), ("dims", pa.int32()), ("ids", pa.binary()), ("postings", pa.binary())])

    def flush(block, ids, rows):
        width = max((len(r) for r in rows), default=0)
        dense = np.zeros((width, len(rows)), np.int64)
        for k, r in enumerate(rows):
            dense[:len(r), k] = r
        return batch_of(schema, [block], [width], [np.array(ids, np.int64).tobytes()], [dense.tobytes()])

    def run(batches):
        block, ids, rows = None, [], []
        for batch in batches:
            for b, i, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if (b != block or len(ids) >= size) and ids:
                    yield flush(block, ids, rows)
                    ids, rows = [], []
                block = b
                ids.append(i)
                rows.append(w.values.to_numpy())
        if ids:
            yield flush(block, ids, rows)
    return run


def term_at_a_time(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, postings: np.ndarray, k: int):
    """The k best candidates of one block for each query: (query id, vec_id, score).

    ``queries`` and ``postings`` have a row per dimension.  A query is no candidate of its own.
    """
    out = []
    order = np.argsort(ids, kind="stable")
    ids, postings = ids[order], postings[:, order]
    # the narrowest integers that no score can leave
    largest = int(np.abs(queries).max(initial=0)) * int(np.abs(postings).max(initial=0)) * max(1, len(queries))
    kind = np.int32 if largest < 1 << 31 else np.int64
    queries, postings = queries.astype(kind), np.ascontiguousarray(postings, dtype=kind)
    weighted = np.empty(len(ids), kind)
    for q, query_id in enumerate(query_ids.tolist()):
        row = queries[:, q]
        terms = np.flatnonzero(row)
        terms = terms[terms < len(postings)]
        score = np.zeros(len(ids), kind)
        for t in terms.tolist():
            np.multiply(postings[t], row[t], out=weighted)
            score += weighted
        other = np.flatnonzero(ids != query_id)
        if len(other) > k:
            mine = score[other]
            least = np.partition(mine, len(mine) - k)[len(mine) - k]
            other = other[mine >= least]  # all ties, so that the smaller ids can win
        best = other[np.lexsort((ids[other], -score[other]))][:k]
        out += [(query_id, i, s) for i, s in zip(ids[best].tolist(), score[best].tolist(), strict=True)]
    return out


def _score(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        for batch in batches:
            for qd, qi, qw, cd, ci, cw in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                found = term_at_a_time(np.frombuffer(qi, np.int64), np.frombuffer(qw, np.int64).reshape(qd, -1),
                                       np.frombuffer(ci, np.int64), np.frombuffer(cw, np.int64).reshape(cd, -1), k)
                yield batch_of(schema, *(zip(*found, strict=True) if found else ([], [], [])))
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``vectors`` and ``queries`` of ``(vec_id, embedding)`` -> ``(query_id, rank, vec_id, score)``.

    Each query's k highest integer inner products with the vectors of other ids
    (all, if fewer), ties to the smaller vec_id.  Vectors of unequal length are
    compared over the dimensions both have.  Null vectors, or with null or
    non-finite components, and null ids take no part; of equal ids, equal rows
    count once.  An empty table gives no rows.
    """
    def blocked(table, size, name):
        rows = integer_vectors(table).distinct()
        n = rows.agg(F.count(F.lit(1))).first()[0]
        count = max(1, -(-n // size))
        rows = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(count)).alias("block"), "vec_id", "weights")
        return store(rows.repartition("block").sortWithinPartitions("block", "vec_id").mapInArrow(
            _blocks(2 * size), "block long, dims int, ids binary, postings binary"), name), count

    asked, count = blocked(queries, BLOCK_QUERIES, "queries")
    known, _ = blocked(vectors, BLOCK_CANDIDATES, "vectors")
    # the stated queries against all rows, a block of each at a time
    meets = known.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))).alias("block"),
                         F.col("dims").alias("c_dims"), F.col("ids").alias("c_ids"), F.col("postings").alias("c_postings"))
    scored = (asked.join(meets.repartition("block", "c_ids"), "block")
              .select("dims", "ids", "postings", "c_dims", "c_ids", "c_postings")
              .mapInArrow(_score(k), "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


TOP_K_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
) WHERE rank <= 5
"""
