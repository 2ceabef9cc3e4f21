"""Removal of repeated 100-byte strings by blockwise suffix sorting.

The suffixes that count are those with 100 bytes left in their document.  They
are dealt into buckets by the cover sample their first 100 bytes contain, so
equal strings meet in one bucket, and one bucket after the other is sorted.

The cover sample.  A difference cover modulo v keeps suffixes at offsets such
that any two positions have a sampled suffix at one common distance.  In many
documents at once, a cover by position must keep about one suffix in nine.
Here the cover is chosen by content instead (the lowest 24-byte hash in every
100 bytes, the rightmost among equals): equal strings have their sample at the
same distance, which is the property needed, and one suffix in 39 is kept.

1. Every document's strings are cut into runs that have one sampled suffix.  A
   run equal to an earlier run of its bucket in all its bytes is a repeat.
2. What differs in buckets with several runs is sorted: the sampled suffixes by
   their next 100 bytes, and by what stands before them.  A string at distance
   o before its sample ties with another exactly if o bytes before and 100 - o
   bytes behind the sample tie, which the ranks and common prefixes of the
   sample decide without comparing the strings themselves.  Of a bucket with
   very many runs, parts are sorted, and the strings left of each compared.
3. Bytes covered by repeated strings are removed, a document at a time.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimforge.llm.shared import batch_of, pick, store
from dimforge.llm.shingles import _mix, text_bytes, text_chunks

SPAN = 100                 # bytes of a string
GRAM = 24                  # bytes that choose the sample
REACH = SPAN - GRAM        # largest distance of a string to its sample
CHUNK = 1_000_000          # bytes of text at once
SEGMENT = 4_000_000        # longer documents are read in overlapping pieces
SORT_ROWS = 20_000         # runs sorted together at least (whole buckets)
BUCKET_RUNS = 50_000       # of one bucket sorted in one task
NO_ID = (1 << 63) - 1      # the place of documents without doc_id: after all others
ODD = np.uint64(0x9E3779B97F4A7C15)


def _power(k: int) -> np.uint64:
    return np.uint64(pow(int(ODD), k, 1 << 64))


def _text_tag(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """16 bits of every text, kept beside its starts."""
    values = np.array([int.from_bytes(hashlib.blake2b(flat[a:b].tobytes(), digest_size=2).digest(), "little")
                       for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], np.int64)
    return values


def sample_runs(flat: np.ndarray, bounds: np.ndarray):
    """Runs of string starts with one sample: (first, last, sample, gram hash, hash of all bytes of the run)."""
    n = len(flat)
    none = np.zeros(0, np.int64)
    if n < SPAN:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    value = _mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * ODD)
    h = value[flat]
    h = h[:-1] * _power(1) + h[1:]
    h = h[:-2] * _power(2) + h[2:]
    h8 = h[:-4] * _power(4) + h[4:]
    h16 = h8[:-8] * _power(8) + h8[8:]
    gram = _mix(h16[:-8] * _power(8) + h8[16:])
    place = np.uint64(0xFFFFFFFF) - np.arange(len(gram), dtype=np.uint64)
    low = (gram & np.uint64(0xFFFFFFFF00000000)) | place
    width = 1
    while width * 2 <= REACH + 1:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = REACH + 1 - width
    if rest:
        low = np.minimum(low[:-rest], low[rest:])
    sample = (np.uint64(0xFFFFFFFF) - (low & np.uint64(0xFFFFFFFF))).astype(np.int64)
    # strings that end in their own document
    starts = np.maximum(bounds[1:] - bounds[:-1] - SPAN + 1, 0)
    out = np.concatenate([[0], np.cumsum(starts)])
    at = np.repeat(bounds[:-1] - out[:-1], starts) + np.arange(out[-1])
    if not len(at):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    s = sample[at]
    new = np.ones(len(at), bool)
    new[1:] = (s[1:] != s[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    first, last = at[begin], at[np.append(begin[1:], len(at)) - 1]
    q = s[begin]

    def h64(x):
        return (h16[x] * _power(48) + h16[x + 16] * _power(32)) + (h16[x + 32] * _power(16) + h16[x + 48])

    length = last - first + SPAN
    whole = _mix(h64(first) * np.uint64(0xD6E8FEB86659FD93)
                 + h64(first + (length - 64) // 2) * np.uint64(0xA0761D6478BD642F)
                 + h64(first + length - 64) * np.uint64(0xE7037ED1A0B428DB)
                 + (q - last).astype(np.uint64) * np.uint64(0x8EBC6AF09C88C6E3)
                 + (q - first).astype(np.uint64) * np.uint64(0x589965CC75374CC3))
    return first, last, q, gram[q], whole


_RUNS = pa.schema([("bucket", pa.int64()), ("run", pa.int64()), ("doc", pa.int64()), ("meta", pa.int64()),
                  ("tag", pa.int64())])
# meta: first start (32 bits), text tag (16), distance to the sample of the first and last start (8, 8)


def _meta(first, tag, q, last, shift=0):
    return ((first + shift) << 32) | (tag << 16) | ((q - first) << 8) | (q - last)


def _first(meta):
    return meta >> 32


def _last(meta):
    return (meta >> 32) + ((meta >> 8) & 255) - (meta & 255)


def _sample_documents(batches):
    """Runs of every document; a run that repeats one of the same chunk comes as bucket null."""
    for batch in batches:
        ids, text, tags = batch.column(0).to_numpy(), batch.column(1), batch.column(2).to_numpy()
        for a, b in text_chunks(text, CHUNK):
            flat, bounds = text_bytes(text.slice(a, b - a))
            tag = _text_tag(flat, bounds)
            for start in range(0, max(1, len(flat)), SEGMENT):
                if len(flat) > SEGMENT and b - a == 1:
                    part = flat[start:start + SEGMENT + SPAN - 1]
                    limits = np.array([0, len(part)])
                else:
                    part, limits = flat, bounds
                first, last, q, gram, whole = sample_runs(part, limits)
                row = np.searchsorted(limits, first, side="right") - 1
                base = limits[row] if len(row) else row
                doc, wide = ids[a + row], tags[a + row]
                meta = _meta(first - base, tag[row], q - base, last - base, start)
                order = np.lexsort((wide, meta, doc, whole))
                same = np.zeros(len(order), bool)
                same[1:] = whole[order[1:]] == whole[order[:-1]]
                known = np.zeros(len(order), bool)
                known[order] = same
                # the same row of the table twice is no repeat
                twin = np.zeros(len(order), bool)
                twin[1:] = (same[1:] & (doc[order[1:]] == doc[order[:-1]]) & (meta[order[1:]] == meta[order[:-1]])
                            & (wide[order[1:]] == wide[order[:-1]]))
                drop = np.zeros(len(order), bool)
                drop[order] = twin
                keep = ~drop
                yield batch_of(_RUNS, pa.array(gram.view(np.int64)[keep], mask=known[keep]),
                               whole.view(np.int64)[keep], doc[keep], meta[keep], wide[keep])
                if part is flat:
                    break


_FOUND = pa.schema([("bucket", pa.int64()), ("doc", pa.int64()), ("meta", pa.int64()), ("tag", pa.int64())])


def _sort_runs(batches):
    """Runs sorted by bucket, run, doc, meta, tag.  Out: repeats (bucket null), and runs to be compared in their bucket."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        known = batch.column(0).is_null().to_numpy(zero_copy_only=False)
        doc, meta, tag = (batch.column(i).to_numpy() for i in (2, 3, 4))
        if known.any():
            yield batch_of(_FOUND, pa.nulls(int(known.sum()), pa.int64()), doc[known], meta[known], tag[known])
        if known.all():
            continue
        cols = [pc.fill_null(batch.column(0), 0).to_numpy(), batch.column(1).to_numpy(), doc, meta, tag]
        cols = [c[~known] for c in cols]
        joined = False
        if held:
            cols = [np.append(h, c) for h, c in zip(held[0], cols, strict=True)]
            joined, previous = held[1], held[2]
        else:
            previous = None
        bucket, run, doc, meta, tag = cols
        new = np.ones(len(bucket), bool)
        new[1:] = (bucket[1:] != bucket[:-1]) | (run[1:] != run[:-1])
        before_doc, before_meta, before_tag = (np.append(x[:1], x[:-1]) for x in (doc, meta, tag))
        if previous is not None and len(doc) > 1:
            before_doc[1], before_meta[1], before_tag[1] = previous
        repeat = ~new & ~((doc == before_doc) & (meta == before_meta) & (tag == before_tag))
        yield batch_of(_FOUND, pa.nulls(int(repeat.sum()), pa.int64()), doc[repeat], meta[repeat], tag[repeat])
        lead = np.flatnonzero(new)
        same = bucket[lead[1:]] == bucket[lead[:-1]]
        before = np.append(joined, same)
        out = lead[:-1][before[:-1] | same]
        yield batch_of(_FOUND, bucket[out], doc[out], meta[out], tag[out])
        held = ([c[lead[-1]] for c in cols], bool(before[-1]), (doc[-1], meta[-1], tag[-1]))
    if held and held[1]:
        bucket, _, doc, meta, tag = held[0]
        yield batch_of(_FOUND, [bucket], [doc], [meta], [tag])


def _pack_documents(batches):
    pack = zstandard.ZstdCompressor(level=3).compress
    schema = pa.schema([("doc", pa.int64()), ("tag", pa.int64()), ("null_id", pa.bool_()), ("packed", pa.binary())])
    for batch in batches:
        ids = batch.column(0)
        for a, b in text_chunks(batch.column(1)):
            text = pc.fill_null(batch.column(1).slice(a, b - a), "").to_pylist()
            part = ids.slice(a, b - a)
            yield batch_of(schema, part, batch.column(2).slice(a, b - a), batch.column(3).slice(a, b - a), [pack(x.encode()) for x in text])


_CONTEXT = pa.schema([("bucket", pa.int64()), ("part", pa.int64()), ("parts", pa.int64()), ("doc", pa.int64()),
                      ("meta", pa.int64()), ("tag", pa.int64()), ("bytes", pa.binary())])


def _cut_contexts(batches):
    """(doc, tag, packed, buckets, parts, all parts, metas) -> the bytes of each run."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for doc, tag, packed, *runs in zip(*(batch.column(i) for i in range(7)), strict=True):
            text = unpack(packed.as_py())
            bucket, part, parts, meta = (x.values.to_numpy() for x in runs)
            yield batch_of(_CONTEXT, bucket, part, parts, np.full(len(meta), doc.as_py()), meta,
                           np.full(len(meta), tag.as_py()),
                           [text[f:g + SPAN] for f, g in zip(_first(meta).tolist(), _last(meta).tolist(), strict=True)])


def _ranks(parts: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort rows of bytes within buckets: the order, and each row's common prefix with the row before it."""
    words = np.zeros((len(parts), -(-parts.shape[1] // 8) * 8), np.uint8)
    words[:, :parts.shape[1]] = parts
    words = words.view(">u8")
    order = np.lexsort([*words.T[::-1], bucket])
    ordered = parts[order]
    differ = ordered[1:] != ordered[:-1]
    prefix = np.where(differ.any(axis=1), differ.argmax(axis=1), parts.shape[1])
    prefix[bucket[order[1:]] != bucket[order[:-1]]] = -1
    return order, np.append(-1, prefix)


def repeated_starts(bucket: np.ndarray, meta: np.ndarray, contexts: list[bytes]) -> list[tuple[int, int]]:
    """(row, distance to the sample) of the strings that an earlier row of the bucket has too.

    Rows of a bucket are in document order.
    """
    far, near = (meta >> 8) & 255, meta & 255
    behind, before = np.zeros((len(meta), SPAN), np.uint8), np.zeros((len(meta), REACH), np.uint8)
    for i, (c, f) in enumerate(zip(contexts, far.tolist(), strict=True)):
        x = np.frombuffer(c, np.uint8)
        right = x[f:f + SPAN]
        behind[i, :len(right)] = right
        before[i, :f] = x[:f][::-1]
    right_order, right_prefix = _ranks(behind, bucket)
    left_order, left_prefix = _ranks(before, bucket)
    rows, distances = [], []
    right, left = np.empty(len(meta), np.int64), np.empty(len(meta), np.int64)
    for o in range(int(near.min()), int(far.max()) + 1):
        mine = np.flatnonzero((near <= o) & (o <= far))
        if len(mine) < 2:
            continue
        right[right_order] = np.cumsum(right_prefix < SPAN - o)
        left[left_order] = np.cumsum(left_prefix < o)
        tie = right[mine] * (len(meta) + 1) + left[mine]
        first = np.unique(tie, return_index=True)[1]
        later = np.ones(len(mine), bool)
        later[first] = False
        rows.append(mine[later])
        distances.append(np.full(int(later.sum()), o))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(distances)


_SOLVED = pa.schema([("doc", pa.int64()), ("meta", pa.int64()), ("tag", pa.int64()), ("bucket", pa.int64()), ("string", pa.binary())])


def _solve(table: pa.Table, group: np.ndarray):
    """Runs of repeated strings; of buckets in several parts also the other strings, to be compared between parts."""
    bucket, parts, doc, meta, tag = (table[c].to_numpy() for c in ("bucket", "parts", "doc", "meta", "tag"))
    contexts = table["bytes"].to_pylist()
    row, o = repeated_starts(group, meta, contexts)
    start = _first(meta[row]) + ((meta[row] >> 8) & 255) - o
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(row)) - 1
    first, last = start[begin], start[end] if len(row) else start
    none = pa.nulls(len(begin))
    yield batch_of(_SOLVED, doc[row[begin]], (first << 32) | (meta[row[begin]] & 0xFFFF0000) | ((last - first) << 8),
                   tag[row[begin]], none.cast(pa.int64()), none.cast(pa.binary()))
    known = set(zip(row.tolist(), start.tolist(), strict=True)) if (parts > 1).any() else set()
    for r in np.flatnonzero(parts > 1).tolist():
        begin = int(_first(meta[r]))
        at = [x for x in range(begin, int(_last(meta[r])) + 1) if (r, x) not in known]
        strings = [hashlib.blake2b(contexts[r][x - begin:x - begin + SPAN], digest_size=16).digest() for x in at]
        yield batch_of(_SOLVED, [doc[r]] * len(at), [(x << 32) | int(meta[r] & 0xFFFF0000) for x in at], [tag[r]] * len(at),
                       [bucket[r]] * len(at), strings)


def _sort_buckets(batches):
    """Contexts sorted by bucket, part, doc, meta, tag; whole parts of buckets are solved together."""
    held = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(x.num_rows for x in held) < SORT_ROWS:
            continue
        table = pa.Table.from_batches(held)
        group = _numbered(table)
        whole = int(np.searchsorted(group, group[-1]))
        if whole:
            yield from _solve(table.slice(0, whole), group[:whole])
        held = table.slice(whole).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield from _solve(table, _numbered(table))


def _numbered(table: pa.Table) -> np.ndarray:
    bucket, part = table["bucket"].to_numpy(), table["part"].to_numpy()
    return np.append(0, np.cumsum((bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])))


def _remove(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept", pa.binary())])
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for a in range(0, batch.num_rows, 500):
            out = []
            for doc, null_id, packed, metas in zip(*(batch.column(i).slice(a, 500) for i in range(4)), strict=True):
                text = unpack(packed.as_py())
                removed, spans, kept = 0, 0, text
                if metas.is_valid and len(metas):
                    meta = metas.values.to_numpy()
                    edge = np.zeros(len(text) + 1, np.int64)
                    np.add.at(edge, _first(meta), 1)
                    np.add.at(edge, _last(meta) + SPAN, -1)
                    gone = np.cumsum(edge)[:-1] > 0
                    removed = int(gone.sum())
                    spans = int((gone[1:] & ~gone[:-1]).sum() + (gone[0] if len(gone) else 0))
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                out.append((None if null_id.as_py() else doc.as_py(), len(text), removed, spans, kept))
            yield batch_of(schema, *zip(*out, strict=True))


def remove_repeats(documents: DataFrame) -> DataFrame:
    """``documents(doc_id, text)`` -> ``(doc_id, n_bytes, n_removed, n_spans, kept)``, a row for each input row.

    A byte is removed if a 100-byte string over it also starts earlier: in a
    document of smaller doc_id, or earlier in its own.  ``kept`` has the other
    bytes.  Null text is empty.  Documents without doc_id come after all others;
    rows that share a doc_id, or have none, count as versions of one document, in
    order of start, and are told apart by 64 more bits of their text; the same row
    twice is one document.  Other columns are ignored.
    """
    docs = pick(documents, doc_id="long", text="string").select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tag"),
        F.col("doc_id").isNull().alias("null_id"))
    runs = docs.select("doc", "text", "tag").mapInArrow(
        _sample_documents, "bucket long, run long, doc long, meta long, tag long")
    # runs already known as repeats are spread, the others go to their bucket
    place = F.coalesce("bucket", F.xxhash64("doc", "tag", "meta"))
    found = store(runs.repartition(place).sortWithinPartitions("bucket", "run", "doc", "meta", "tag")
                  .mapInArrow(_sort_runs, "bucket long, doc long, meta long, tag long"), "runs")
    packed = docs.mapInArrow(_pack_documents, "doc long, tag long, null_id boolean, packed binary")
    todo = found.where("bucket is not null")
    # a bucket of very many runs is sorted in parts, and the strings of its parts are compared after that
    large = (todo.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BUCKET_RUNS).alias("parts")).where("parts > 1"))
    todo = (todo.join(large, "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1)).cast("long"))
            .withColumn("part", F.pmod(F.xxhash64("doc", "tag", "meta"), F.col("parts"))))
    open_runs = (todo.groupBy("doc", "tag")
                 .agg(F.collect_set(F.struct("bucket", "part", "parts", "meta")).alias("runs")))  # one text's own runs
    contexts = (packed.join(open_runs, ["doc", "tag"])
                .select("doc", "tag", "packed", "runs.bucket", "runs.part", "runs.parts", "runs.meta")
                .mapInArrow(_cut_contexts,
                            "bucket long, part long, parts long, doc long, meta long, tag long, bytes binary"))
    solved = store(contexts.repartition("bucket", "part").sortWithinPartitions("bucket", "part", "doc", "meta", "tag")
                   .mapInArrow(_sort_buckets, "doc long, meta long, tag long, bucket long, string binary"), "solved")
    same = Window.partitionBy("bucket", "string").orderBy("doc", "meta", "tag")  # a row for each part at most
    between = (solved.where("string is not null").withColumn("r", F.row_number().over(same)).where("r > 1")
               .select("doc", "tag", "meta"))
    repeats = (found.where("bucket is null").unionByName(solved.where("string is null"), allowMissingColumns=True)
               .select("doc", "tag", "meta").unionByName(between))
    of_doc = repeats.groupBy("doc", "tag").agg(F.collect_set("meta").alias("metas"))  # one text's own runs
    return (packed.join(of_doc, ["doc", "tag"], "left").select("doc", "null_id", "packed", "metas")
            .mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"))


REMOVE_REPEATS_SQL = """
WITH d AS (
  SELECT doc_id, encode(coalesce(text, '')) AS h FROM documents
), p AS (
  SELECT doc_id, p, hex(array_slice(h, p + 1, p + 1)) AS byte,
         CASE WHEN p + 100 <= octet_length(h) THEN md5_number(array_slice(h, p + 1, p + 100)) END AS string
  FROM (SELECT doc_id, h, unnest(range(octet_length(h))) AS p FROM d)
), r AS (
  SELECT doc_id, p, byte,
         string IS NOT NULL AND row_number() OVER (PARTITION BY string ORDER BY doc_id, p) > 1 AS repeat FROM p
), c AS (
  SELECT doc_id, p, byte, bool_or(repeat) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone
  FROM r
), e AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS opens FROM c
), g AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
         coalesce(string_agg(byte, '' ORDER BY p) FILTER (NOT gone), '') AS rest FROM e GROUP BY doc_id
)
SELECT doc_id, octet_length(h)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(rest, ''))) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
"""
