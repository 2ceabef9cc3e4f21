"""Hard negatives by segment summaries: bounds on inner products, refined before exact scores.

A vector is cut into segments; for each, the mean and the deviation (root of the
mean square around it) are stored.  In a segment of m components the product of
two vectors is m times (product of the means, plus or minus at most the product
of the deviations).  One segment, the whole vector, bounds every score; pairs
that this doesn't settle are bounded by halves, quarters and so on, and only
those left are scored, in integers.

Candidates stand in cells, by groups of labels; a hot group has as many cells as
it needs.  Candidates move once, and blocks of anchors go to the cells: for the
positives to those of their label's group, for the negatives to all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimforge.llm.shared import batch_of, store

SCALE = 256
CELL = 16384               # candidates compared in one task at a time, about
BLOCK_ANCHORS = 256
SHORTEST_SEGMENT = 8
ENDS = (-(1 << 63), (1 << 63) - 1)


# --- scores --------------------------------------------------------------------------------------

def padded(rows: list[np.ndarray]) -> np.ndarray:
    """floor(256 x) of each row, with zeros up to a common length that halves evenly."""
    width = max((len(r) for r in rows), default=0)
    width = -(-max(width, 1) // SHORTEST_SEGMENT) * SHORTEST_SEGMENT
    width = SHORTEST_SEGMENT << (width // SHORTEST_SEGMENT - 1).bit_length()
    out = np.zeros((len(rows), width))
    for k, r in enumerate(rows):
        out[k, :len(r)] = np.floor(r * SCALE)
    return out


class Summaries:
    """Means and deviations of all segments, by level: one segment, two, four ... down to the shortest."""

    def __init__(self, vectors: np.ndarray):
        self.levels = []
        count = 1
        with np.errstate(over="ignore", invalid="ignore"):
            while vectors.shape[1] // count >= SHORTEST_SEGMENT:
                parts = vectors.reshape(len(vectors), count, -1)
                mean = parts.mean(axis=2)
                root = np.sqrt(parts.shape[2])
                self.levels.append((mean * root, np.sqrt(((parts - mean[:, :, None]) ** 2).mean(axis=2)) * root))
                count *= 2

    def bounds(self, level: int, mine, rows: np.ndarray, slack: float):
        """Least and largest score of the rows with the vector whose (means, deviations) are ``mine[level]``."""
        mean, deviation = self.levels[level]
        middle = _products(mean, rows, mine[level][0])
        around = _products(deviation, rows, mine[level][1]) + slack
        return middle - around, middle + around


def _products(table: np.ndarray, rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """The products of these rows; where most are wanted, of all, as copying them takes longer."""
    return (table @ vector)[rows] if 4 * len(rows) > len(table) else table[rows] @ vector


class Cell:
    """Candidates of one cell, sorted by id."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.summaries = Summaries(self.vectors)
        self.largest = float(np.abs(self.vectors).max(initial=0))
        # integers, if they are exact as such
        self.whole = self.vectors.astype(np.int64) if self.largest < 1 << 53 else None

    def exact(self, anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Integer scores of these rows; beyond 64 bits the nearest of 64 bits."""
        top = self.largest * float(np.abs(anchor).max(initial=0)) * len(anchor)
        if top < 1 << 53:  # every sum is exact in floating point
            return _products(self.vectors, rows, anchor).astype(np.int64)
        if self.whole is not None and top < 1 << 62:
            return self.whole[rows] @ anchor.astype(np.int64)
        q = [int(x) for x in anchor]
        return np.array([min(max(sum(a * int(b) for a, b in zip(q, self.vectors[r], strict=True) if a), ENDS[0]), ENDS[1])
                         for r in rows.tolist()], np.int64)

    def slack(self, anchor: np.ndarray) -> float:
        """More than the rounding errors of bounds and scores can be."""
        return 1.0 + 1e-9 * self.largest * float(np.abs(anchor).sum())

    def refined(self, anchor: np.ndarray, summary, rows: np.ndarray, useful) -> np.ndarray:
        """The rows that ``useful(least, largest, whether this is the last level)`` keeps at every level of the summaries."""
        slack = self.slack(anchor)
        if not np.isfinite(slack * len(anchor) * self.largest):
            return rows
        for level in range(len(summary)):
            if not len(rows):
                break
            keep = useful(*self.summaries.bounds(level, summary, rows, slack), level == len(summary) - 1)
            rows = rows if keep.all() else rows[keep]
        return rows

    def best(self, anchor_id: int, label: int, anchor: np.ndarray, summary, k: int) -> list[tuple[int, int]]:
        """The k highest (vec_id, score) of the label, ties by smaller id, the anchor's own id left out."""
        rows = np.flatnonzero((self.labels == label) & (self.ids != anchor_id))

        def useful(least, largest, _):
            if len(least) <= k:
                return np.ones(len(least), bool)
            return largest >= np.partition(least, len(least) - k)[len(least) - k]

        rows = self.refined(anchor, summary, rows, useful)
        score = self.exact(anchor, rows)
        first = np.lexsort((self.ids[rows], -score.astype(object) if len(score) and score.min() == ENDS[0] else -score))[:k]
        return list(zip(self.ids[rows[first]].tolist(), score[first].tolist(), strict=True))

    def within(self, label: int, anchor: np.ndarray, summary, limits: list[tuple[int, int]], k: int):
        """For each (lowest, highest) the k highest (vec_id, score) of other labels that lie within, ties by smaller id."""
        limits = [(max(a, ENDS[0]), min(b, ENDS[1])) for a, b in limits]
        some = [(a, b) for a, b in limits if a <= b]
        if not some:
            return [[] for _ in limits]

        lowest, highest = min(a for a, _ in some), max(b for _, b in some)

        def useful(least, largest, last):
            keep = (largest >= lowest) & (least <= highest)
            if not last or not keep.any():
                return keep
            keep = np.zeros(len(least), bool)
            for a, b in some:
                surely = least[(least >= a) & (largest <= b)]
                floor = np.partition(surely, len(surely) - k)[len(surely) - k] if len(surely) >= k else a
                keep |= (largest >= max(a, floor)) & (least <= b)
            return keep

        rows = self.refined(anchor, summary, np.flatnonzero(self.labels != label), useful)
        score = self.exact(anchor, rows)
        order = np.lexsort((self.ids[rows], -score.astype(object) if len(score) and score.min() == ENDS[0] else -score))
        rows, score = rows[order], score[order]
        out = []
        for a, b in limits:
            at = np.flatnonzero((score >= a) & (score <= b))[:k]
            out.append(list(zip(self.ids[rows[at]].tolist(), score[at].tolist(), strict=True)))
        return out


# --- cells and blocks ----------------------------------------------------------------------------

def labelled_vectors(vectors: DataFrame) -> DataFrame:
    """``(vec_id, label, embedding)`` of the rows that take part, one for each vec_id."""
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = vectors.select(F.col("`vec_id`").cast("long").alias("vec_id"), F.col("`label`").cast("long").alias("label"),
                          F.col("`embedding`").cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    return (rows.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("row"))
            .select("vec_id", "row.label", "row.embedding"))


def _packed(columns: int, size: int):
    """Rows (key, id, label, embedding, more) sorted by key -> a row for each key, or more: arrays as bytes."""
    def flush(key, rows):
        ids, labels, vectors, more = zip(*rows, strict=True)
        dense = padded(vectors)
        fields = [pa.array([key], pa.int64()), pa.array([np.array(ids, np.int64).tobytes()]),
                  pa.array([np.array(labels, np.int64).tobytes()]), pa.array([dense.shape[1]], pa.int32()),
                  pa.array([dense.tobytes()])]
        names = ["key", "ids", "labels", "width", "vectors"]
        if columns:
            fields.append(pa.array([list(more)], pa.list_(pa.list_(pa.int64()))))
            names.append("scores")
        return pa.RecordBatch.from_arrays(fields, names=names)

    def run(batches):
        key, rows = None, []
        for batch in batches:
            more = batch.column(4).to_pylist() if columns else [None] * batch.num_rows
            for k, i, label, v, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                         batch.column(2).to_pylist(), batch.column(3), more, strict=True):
                if rows and (k != key or len(rows) >= size):
                    yield flush(key, rows)
                    rows = []
                key = k
                rows.append((i, label, v.values.to_numpy(zero_copy_only=False), x))
        if rows:
            yield flush(key, rows)
    return run


def _arrays(ids, labels, width, vectors):
    return (np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64),
            np.frombuffer(vectors, np.float64).reshape(-1, width))


def _alike(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] == width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


def _meet(job):
    """Rows (anchors' five columns, [scores], candidates' four), by cell -> what ``job`` finds for each anchor."""
    def run(batches):
        last, cell = None, None
        for batch in batches:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for r in range(batch.num_rows):
                at = {n: c[r].as_py() for n, c in column.items() if not n.startswith("c_")}
                known = column["c_cell"][r].as_py(), column["c_part"][r].as_py()
                if known != last:
                    last = known
                    c_ids, c_labels, c_vectors = _arrays(*(column[n][r].as_py() for n in
                                                           ("c_ids", "c_labels", "c_width", "c_vectors")))
                    cell = Cell(c_ids, c_labels, c_vectors)
                ids, labels, vectors = _arrays(at["ids"], at["labels"], at["width"], at["vectors"])
                width = max(vectors.shape[1], cell.vectors.shape[1])
                if cell.vectors.shape[1] < width:
                    cell = Cell(cell.ids, cell.labels, _alike(cell.vectors, width))
                yield job(cell, ids, labels, _alike(vectors, width), at.get("scores"))
    return run


def _positives(k: int):
    schema = pa.schema([("anchor_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def job(cell, ids, labels, vectors, _):
        levels = Summaries(vectors).levels
        out = [(i, *found) for n, (i, label) in enumerate(zip(ids.tolist(), labels.tolist(), strict=True))
               for found in cell.best(i, label, vectors[n], [(m[n], d[n]) for m, d in levels], k)]
        return batch_of(schema, *(zip(*out, strict=True) if out else ([], [], [])))
    return _meet(job)


def _negatives(k: int, low: int, high: int):
    schema = pa.schema([(c, pa.int64()) for c in ("anchor_id", "positive", "vec_id", "score")])

    def job(cell, ids, labels, vectors, scores):
        levels = Summaries(vectors).levels
        out = []
        for n, (i, label) in enumerate(zip(ids.tolist(), labels.tolist(), strict=True)):
            limits = [(-(-low * p // 100), high * p // 100) for p in scores[n]]
            for p, found in enumerate(cell.within(label, vectors[n], [(m[n], d[n]) for m, d in levels], limits, k)):
                out += [(i, p, *x) for x in found]
        return batch_of(schema, *(zip(*out, strict=True) if out else ([], [], [], [])))
    return _meet(job)


PACKED = "key long, ids binary, labels binary, width int, vectors binary"
MET = ["c_cell", "c_part", "c_ids", "c_labels", "c_width", "c_vectors", "ids", "labels", "width", "vectors"]


def _join(anchors: DataFrame, cells: DataFrame, *more: str) -> DataFrame:
    """Blocks of anchors, each with the cell that ``key`` names, cell by cell."""
    known = cells.select(F.col("key").alias("c_cell"), "c_part", F.col("ids").alias("c_ids"),
                         F.col("labels").alias("c_labels"), F.col("width").alias("c_width"),
                         F.col("vectors").alias("c_vectors"))
    return (anchors.withColumnRenamed("key", "c_cell").join(known, "c_cell")
            .sortWithinPartitions("c_cell", "c_part").select(*MET, *more))


def mine_hard_negatives(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3,
                        low: int = 50, high: int = 95) -> DataFrame:
    """``vectors(vec_id, label, embedding)`` and ``anchors(vec_id)`` -> a row per anchor, positive and negative.

    Components become floor(256 * x); a score is the integer inner product with the
    anchor.  An anchor's positives are its ``positives`` highest other rows of its
    label; for each, its negatives are the ``negatives`` highest rows of other labels
    with low * positive_score <= 100 * negative_score <= high * positive_score.  All,
    if fewer; ties by smaller vec_id.  Columns: anchor_id, positive_id, rank (from 1),
    negative_id, positive_score, negative_score.

    Rows with a null vec_id, label or vector, or a null or non-finite component take
    no part; of rows that share a vec_id the least (label, then vector) does.  Anchors
    without a row among them give nothing.  Vectors of unequal length are compared
    over the dimensions both have.  Scores beyond 64 bits count as the nearest
    64-bit integer.  An empty table gives no rows; other columns are ignored.
    """
    rows = store(labelled_vectors(vectors), "vectors")
    n = rows.count()
    groups = max(1, -(-n // CELL))
    group = F.pmod(F.xxhash64("label"), F.lit(groups)).alias("group")
    # a row per group of labels, as many as there are cells: a group's first cell, and its number of cells
    sizes = store(rows.groupBy(group).count().select(
        "group", F.ceil(F.col("count") / CELL).cast("long").alias("cells")), "groups")
    key = (F.col("group") * F.lit(1 << 32) + F.pmod(F.xxhash64("vec_id"), F.col("cells"))).alias("key")
    cells = store(rows.withColumn("group", group).join(sizes, "group").select(key, "vec_id", "label", "embedding")
                  .repartition("key").sortWithinPartitions("key", "vec_id").mapInArrow(_packed(0, 2 * CELL), PACKED)
                  .withColumn("c_part", F.monotonically_increasing_id()), "cells")
    asked = rows.join(anchors.select(F.col("`vec_id`").cast("long").alias("vec_id")).distinct(), "vec_id", "left_semi")
    asked = store(asked.withColumn("group", group).join(sizes, "group").select(key, "vec_id", "label", "embedding"), "anchors")

    def blocks(df, columns=0):
        """Anchors in blocks, cut like the cells so that a hot group is dealt over tasks."""
        packed = df.repartition("key").sortWithinPartitions("key", "vec_id").mapInArrow(
            _packed(columns, BLOCK_ANCHORS), PACKED + (", scores array<array<long>>" if columns else ""))
        return packed.withColumn("group", F.shiftright("key", 32)).drop("key")

    every = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1),
                                  lambda c: F.col("group").cast("long") * F.lit(1 << 32) + c)).alias("key")
    own = blocks(asked).join(sizes, "group").select(every, "ids", "labels", "width", "vectors")
    found = _join(own, cells).mapInArrow(_positives(positives), "anchor_id long, vec_id long, score long")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    ranked = store(found.withColumn("positive", F.row_number().over(best) - 1).where(F.col("positive") < positives),
                   "positives")
    scores = ranked.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("positive", "score"))), lambda x: x["score"]).alias("scores"))
    with_scores = asked.join(scores, "vec_id").select("key", "vec_id", "label", "embedding", "scores")
    # the stated anchors against all rows: a block goes to every cell of every group
    everywhere = (blocks(with_scores, 1).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
                  .join(sizes.withColumn("group", F.col("group").cast("int")), "group")
                  .select(every, "ids", "labels", "width", "vectors", "scores"))
    mined = _join(everywhere, cells, "scores").mapInArrow(
        _negatives(negatives, low, high), "anchor_id long, positive long, vec_id long, score long")
    best = Window.partitionBy("anchor_id", "positive").orderBy(F.desc("score"), "vec_id")
    mined = mined.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return (mined.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
            .join(ranked.withColumnsRenamed({"vec_id": "positive_id", "score": "positive_score"}), ["anchor_id", "positive"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, min(row(l, e)) AS r FROM (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l, embedding::DOUBLE[] AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  ) GROUP BY vec_id
), w AS (
  SELECT vec_id, r[1] AS label, list_transform(r[2], lambda x: floor(256 * x)::BIGINT) AS w FROM v
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         list_sum(list_transform(list_zip(a.w, c.w), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM w a JOIN w c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
