"""Language identification with interpolated Kneser-Ney character models.

Text is lower-cased, everything but letters becomes one space.  One model of
four characters per language is learned from a bounded sample of labelled
documents: the n-gram counts are gathered by Spark, and kept as sorted arrays of
packed n-grams.  A document gets the language of lowest cross-entropy per
character; temperature and rejection limits are calibrated on sample documents
whose counts are left out.
"""

from __future__ import annotations

import pickle
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimforge.llm.shared import batch_of, pick
from dimforge.llm.shingles import text_chunks

ORDER = 4
SAMPLE_DOCUMENTS = 1000    # per language, the lowest hashes of doc_id; one in five of them calibrates
RANK_SLICES = 64           # a language's documents are ranked in so many parts first
SLOTS_BITS = 19            # of the table of n-grams scored before, per task
REJECTED_SHARE = 0.005     # of calibration documents of a language fall behind its limit
UNKNOWN = "und"

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.array([chr(c).isalpha() for c in range(0x10000)]))
    return _LETTER[0]


def characters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Normalised characters (16 bits each) of all rows, one space before each row, and the row boundaries.

    Letters beyond 16 bits share one value; other characters there are no letters either.
    """
    column = pc.utf8_lower(pc.fill_null(column, ""))
    lengths = pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    rows = len(lengths)
    joined = "".join(column.to_pylist())
    code = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    starts = np.cumsum(lengths) - lengths + np.arange(rows)
    wide = code >= 0x10000
    some = np.unique(code[wide])
    lettered = some[[chr(c).isalpha() for c in some.tolist()]] if len(some) else some
    wide_letter = np.isin(code, lettered) if len(lettered) else np.zeros(len(code), bool)
    code = np.where(wide, 0xFFFF, code).astype(np.uint64)
    letter = _letters()[code.astype(np.int64)] & ~wide | wide_letter
    code[~letter] = 32
    code = np.insert(code, np.cumsum(lengths) - lengths, 32)  # a space before each row
    first = np.zeros(len(code), bool)
    first[starts] = True
    space = code == 32
    keep = ~space | first
    keep[1:] |= space[1:] & ~space[:-1]
    bounds = np.append(starts, len(code))
    return code[keep], np.append(0, np.cumsum(keep))[bounds]


def grams(code: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed 4-grams of each row, after two more spaces before it, and their row boundaries.

    A row of n characters (its leading space included) has n - 1 of them.
    """
    rows = len(bounds) - 1
    padded = np.insert(code, np.repeat(bounds[:-1], ORDER - 2), 32)
    limits = bounds + (ORDER - 2) * np.arange(rows + 1)
    packed = np.zeros(max(0, len(padded) - ORDER + 1), np.uint64)
    for k in range(ORDER):
        packed |= padded[k:k + len(packed)] << np.uint64(16 * (ORDER - 1 - k))
    n = np.diff(limits) - ORDER + 1
    out = np.append(0, np.cumsum(n))
    at = np.repeat(limits[:-1] - out[:-1], n) + np.arange(out[-1])
    return packed[at], out


class CharacterModel:
    """Interpolated Kneser-Ney over packed n-grams, looked up in sorted arrays."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, alphabet: int):
        order = np.argsort(codes)
        codes, counts = codes[order], counts[order].astype(np.float64)
        self.levels = []
        for n in range(ORDER, 0, -1):
            discount = self._discount(counts)
            history = codes >> np.uint64(16)
            keys, start = np.unique(history, return_index=True)
            total = np.add.reduceat(counts, start) if len(counts) else counts
            kinds = np.diff(np.append(start, len(codes)))
            self.levels.append((codes, counts, keys, total, kinds, discount))
            # lower orders count in how many contexts an n-gram stands
            codes, counts = np.unique(codes & np.uint64((1 << (16 * (n - 1))) - 1), return_counts=True)
            counts = counts.astype(np.float64)
        self.floor = 1.0 / (alphabet + 1)

    @staticmethod
    def _discount(counts: np.ndarray) -> float:
        once, twice = (counts == 1).sum(), (counts == 2).sum()
        return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray, values: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(len(wanted))
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], 0.0)

    def bits(self, packed: np.ndarray) -> np.ndarray:
        """-log2 of the probability of each n-gram's last character after the others."""
        p = np.full(len(packed), self.floor)
        for n, (codes, counts, keys, total, kinds, discount) in zip(range(1, ORDER + 1), self.levels[::-1], strict=True):
            gram = packed & np.uint64((1 << (16 * n)) - 1) if n < ORDER else packed
            history = gram >> np.uint64(16)
            seen = self._find(keys, history, total)
            share = np.divide(discount * self._find(keys, history, kinds), seen, out=np.ones_like(p), where=seen > 0)
            own = np.divide(np.maximum(self._find(codes, gram, counts) - discount, 0), seen,
                            out=np.zeros_like(p), where=seen > 0)
            p = own + share * p
        return -np.log2(p)


class Scorer:
    """Bits per character of rows under every model, n-grams seen before being remembered in a table of fixed size."""

    def __init__(self, models: list[CharacterModel]):
        self.models = models
        self.keys = np.zeros(1 << SLOTS_BITS, np.uint64)
        self.values = np.zeros((1 << SLOTS_BITS, len(models)), np.float32)

    def __call__(self, packed: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        slot = ((packed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS_BITS)).astype(np.int64)
        miss = np.flatnonzero(self.keys[slot] != packed)
        values = self.values[slot]
        if len(miss):
            new, inverse = np.unique(packed[miss], return_inverse=True)
            scored = np.stack([m.bits(new) for m in self.models], axis=1).astype(np.float32)
            values[miss] = scored[inverse]
            at = ((new * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS_BITS)).astype(np.int64)
            at, last = np.unique(at, return_index=True)  # of those that share a slot, one stays
            self.keys[at], self.values[at] = new[last], scored[last]
        n = np.diff(bounds)
        out = np.zeros((len(n), len(self.models)))
        for row, (a, b) in enumerate(pairwise(bounds.tolist())):
            if b > a:
                out[row] = values[a:b].sum(axis=0, dtype=np.float64) / (b - a)
        return out


# --- learning ------------------------------------------------------------------------------------

def _count(batches):
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for first, last in text_chunks(batch.column(1)):
            packed, bounds = grams(*characters(batch.column(1).slice(first, last - first)))
            part = langs[first:last]
            for lang in sorted(set(part)):
                mine = np.concatenate([packed[a:b] for x, (a, b) in zip(part, pairwise(bounds.tolist()), strict=True) if x == lang])
                codes, n = np.unique(mine, return_counts=True)
                yield batch_of(schema, [lang] * len(codes), codes.view(np.int64), n)


def _calibrate(models: dict[str, CharacterModel], rows: list[tuple[str, str]]) -> tuple[float, dict[str, float]]:
    """Temperature (by log loss), and each language's limit of bits per character."""
    langs = sorted(models)
    rows = [r for r in rows if r[0] in models]
    limits = {x: float("inf") for x in langs}
    if not rows:
        return 1.0, limits
    packed, bounds = grams(*characters(pa.array([t for _, t in rows])))
    bits = Scorer([models[x] for x in langs])(packed, bounds)
    true = np.array([langs.index(x) for x, _ in rows])
    some = np.diff(bounds) > 0
    bits, true = bits[some], true[some]
    losses = []
    for t in (candidates := [1.0, 2.0, 4.0, 8.0, 16.0, 32.0]):
        p = _posterior(bits, t)
        losses.append(-np.log(np.maximum(p[np.arange(len(true)), true], 1e-12)).mean())
    for k, x in enumerate(langs):
        if (true == k).any():
            limits[x] = float(np.quantile(bits[true == k, k], 1 - REJECTED_SHARE))
    return candidates[int(np.argmin(losses))], limits


def _posterior(bits: np.ndarray, temperature: float) -> np.ndarray:
    z = np.exp2(-(bits - bits.min(axis=1, keepdims=True)) * temperature)
    return z / z.sum(axis=1, keepdims=True)


def sampled(labelled: DataFrame) -> DataFrame | None:
    """``(lang, text, fold)`` of SAMPLE_DOCUMENTS whole texts of every language, those of lowest hash of doc_id."""
    rows = pick(labelled, doc_id="long", text="string", lang="string").where("lang is not null and text is not null")
    keyed = rows.withColumn("h", F.xxhash64("doc_id"))
    by_slice = Window.partitionBy("lang", "slice").orderBy("h")
    lowest = (keyed.select("lang", "h", F.pmod(F.xxhash64("h"), F.lit(RANK_SLICES)).alias("slice"))
              .withColumn("r", F.row_number().over(by_slice)).where(F.col("r") <= SAMPLE_DOCUMENTS))
    limit = (lowest.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
             .where(F.col("r") <= SAMPLE_DOCUMENTS).groupBy("lang").agg(F.max("h").alias("most"), F.min("h").alias("least")).collect())  # a row per language
    if not limit:
        return None
    # a row per language, broadcast whatever the session's threshold, so that no text is moved but the sample's
    most = labelled.sparkSession.createDataFrame([(r["lang"], r["most"], r["least"]) for r in limit], "lang string, most long, least long")
    return (keyed.join(F.broadcast(most), "lang").where(F.col("h") <= F.col("most"))
            .select("lang", "text", F.when(F.col("h") == F.col("least"), 1).otherwise(F.pmod("h", F.lit(5))).alias("fold")))


def train(labelled: DataFrame):
    """``labelled(doc_id, text, lang)`` -> (languages, models, temperature, limits), from a bounded sample.

    Every fifth of the ``sampled`` texts calibrates and isn't counted, but the first always is.
    """
    sample = sampled(labelled)
    if sample is None:
        return [], [], 1.0, np.zeros(0)
    counted = (sample.where("fold <> 0").select("lang", "text").mapInArrow(_count, "lang string, gram long, n long")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow())
    names = np.array(counted["lang"].to_pylist(), dtype=object)
    codes, n = counted["gram"].to_numpy().view(np.uint64), counted["n"].to_numpy()
    alphabet = len(np.unique(codes & np.uint64(0xFFFF)))
    models = {x: CharacterModel(codes[names == x], n[names == x], alphabet) for x in sorted(set(names.tolist()))}
    held = [(r[0], r[1]) for r in sample.where("fold = 0").select("lang", "text").collect()]
    temperature, limits = _calibrate(models, held)
    langs = sorted(models)
    return langs, [models[x] for x in langs], temperature, np.array([limits[x] for x in langs])


def _predict(trained):
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
                        ("bits_per_char", pa.float64()), ("rejected", pa.bool_())])

    def run(batches):
        langs, models, temperature, limits = pickle.loads(trained.value)
        scorer = Scorer(models)
        for batch in batches:
            for a, b in text_chunks(batch.column(1)):
                packed, bounds = grams(*characters(batch.column(1).slice(a, b - a)))
                some = np.diff(bounds) > 0
                if not langs:
                    some[:] = False
                pred = np.full(b - a, UNKNOWN, dtype=object)
                score, lowest, rejected = np.zeros(b - a), np.zeros(b - a), np.ones(b - a, bool)
                if some.any():
                    bits = scorer(packed, bounds)[some]
                    best = bits.argmin(axis=1)
                    at = np.arange(len(best))
                    pred[some] = np.array(langs, dtype=object)[best]
                    score[some] = _posterior(bits, temperature)[at, best]
                    lowest[some] = bits[at, best]
                    rejected[some] = bits[at, best] > limits[best]
                yield batch_of(schema, batch.column(0).slice(a, b - a), pred.tolist(), score, lowest, rejected)
    return run


def predict(documents: DataFrame, trained) -> DataFrame:
    """``documents(doc_id, text)`` -> ``(doc_id, lang_pred, score, bits_per_char, rejected)``, a row for each input row.

    Null text, or text without letters, is ``und`` with score 0, as is all text
    if nothing was learned.  Equal models go to the first language by name.
    ``rejected`` marks text that fits its language worse than nearly all
    calibration documents.  Other columns are ignored.
    """
    # models by value: executors have no copy of this package
    shared = documents.sparkSession.sparkContext.broadcast(cloudpickle.dumps(trained))
    return pick(documents, doc_id="long", text="string").mapInArrow(
        _predict(shared), "doc_id long, lang_pred string, score double, bits_per_char double, rejected boolean")


def held_out(doc_id) -> F.Column:
    """Documents that nothing is learned from: crc32 of the id as text leaves 2 on division by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(documents: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out and have a ``lang``, and predict all; adds ``held_out``.

    Documents without doc_id are predicted and not learned from.
    """
    trained = train(documents.where(F.col("doc_id").isNotNull() & ~held_out("doc_id")))
    out = predict(documents, trained)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "bits_per_char", "rejected")
