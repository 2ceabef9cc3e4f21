"""Quality rules from cross-document line frequency, in DataFrame functions only.

Lines are normalised (white space runs to one space, trimmed, lower case) and
hashed.  A line's documents on one host are counted; copies of a document count
once, since a document is told apart by a hash of all its distinct lines.  The
host's documents are counted alike, those without a line not at all.  A line in
more documents than both limits allow is boilerplate on that host and is
removed.  A document is rejected if its own text fails the base rules, or if too
little is left of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.llm.shared import as_rows, pick, store

SPACE = r"[ \t-\r]+"
SPACES = " \t\n\x0b\x0c\r"
LINE_DOCUMENTS = 20          # a line is boilerplate above so many documents of the host ...
LINE_PERMILLE = 5            # ... that are also more than so many thousandths of the host's distinct documents
LEAST_WORDS = 10             # fewer words fail the base rules, or, after removal, deplete a document
MOST_REPEAT_PERCENT = 20     # of the words in repeated 5-word windows
LEAST_LEFT_PERCENT = 10      # of the words, after removal
WINDOW = 5
PACKED_POSITIONS = 15        # bits of a position beside 49 bits of hash, for texts of up to 2**15 windows


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body``, also inside other lambdas."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text without nulls, as an array."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def _covered(positions: Column) -> Column:
    """Words in the union of 5-word windows that start at the sorted positions."""
    start = F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(positions, start, lambda s, p: F.struct(
        p.cast("int").alias("at"),
        (s["n"] + F.least(F.lit(WINDOW), p.cast("int") - s["at"])).cast("long").alias("n")), lambda s: s["n"])


def _repeated_packed(hashes: Column) -> Column:
    low, high = F.lit((1 << PACKED_POSITIONS) - 1).cast("long"), F.lit(-(1 << PACKED_POSITIONS)).cast("long")
    packed = F.sort_array(F.transform(hashes, lambda h, i: h.bitwiseAND(high).bitwiseOR(i.cast("long"))))
    same = lambda a, b: F.shiftright(a, PACKED_POSITIONS) == F.shiftright(b, PACKED_POSITIONS)
    return let(packed, lambda s: F.sort_array(F.transform(
        F.filter(s, lambda x, i: F.coalesce(same(x, F.get(s, i - 1)), F.lit(False))
                 | F.coalesce(same(x, F.get(s, i + 1)), F.lit(False))),
        lambda x: x.bitwiseAND(low))))


def _repeated_any(hashes: Column) -> Column:
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i"))))
    return let(pairs, lambda s: F.sort_array(F.transform(
        F.filter(s, lambda x, i: F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(False))
                 | F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False))),
        lambda x: x["i"])))


def repeat_words(words: Column) -> Column:
    """Number of words in 5-word windows that the array has twice or more, the first ones included."""
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW),
                          lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(let(windows, lambda h: (
        F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
        .when(F.size(h) <= (1 << PACKED_POSITIONS), _covered(_repeated_packed(h)))
        .otherwise(_covered(_repeated_any(h))))))


def base_columns(text: Column) -> dict[str, Column]:
    """Statistics of one text without nulls, and the base verdict."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    of_words = let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.concat_ws("", w)).cast("long").alias("word_chars"),
        repeat_words(w).alias("n_repeat_words")))
    return {"of_words": of_words,
            "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long"),
            "n_dup_lines": let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))}


def _line_hash(line: Column) -> Column:
    """60 bits of the MD5 of the normalised line, as SQL of other engines has it too."""
    normal = F.lower(F.btrim(F.regexp_replace(line, SPACE, " "), F.lit(" ")))
    return F.conv(F.substring(F.md5(normal.cast("binary")), 1, 15), 16, 10).cast("long")


def _text_id(text: Column) -> Column:
    return F.xxhash64(text)


def _documents(documents: DataFrame) -> DataFrame:
    docs = pick(documents, doc_id="long", text="string", source="string")
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), _host(F.col("source")).alias("host"))


def _host(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _same(a: str, b: str) -> Column:
    return (F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_id") == F.col(f"{b}.text_id"))
            & (F.col(f"{a}.host") == F.col(f"{b}.host")))


def boilerplate(documents: DataFrame) -> DataFrame:
    """``(doc_id, text_id, host, line, place, words)``: the lines to be removed, a row for each line of a document."""
    docs = _documents(documents)
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    hashed = F.transform(lines, lambda x: F.struct(_line_hash(x).alias("line"), F.size(words_of(x)).alias("words")))
    of_doc = docs.select("doc_id", "host", _text_id(F.col("text")).alias("text_id"), hashed.alias("lines"))
    document = F.xxhash64(F.sort_array(F.array_distinct(F.col("lines.line"))))  # the same for copies
    each = (of_doc.withColumn("document", document)
            .select("doc_id", "text_id", "host", "document", F.posexplode("lines").alias("place", "x"))
            .select("doc_id", "text_id", "host", "document", "place", "x.line", "x.words"))
    each = store(each, "lines")  # read three times: to count lines and documents, and to find what is to go
    counted = (each.groupBy("host", "line").agg(F.count_distinct("document").alias("documents"))
               .where(F.col("documents") > LINE_DOCUMENTS))
    hosts = each.groupBy("host").agg(F.count_distinct("document").alias("of_host"))  # those with a line
    above = (counted.join(hosts, "host").where(F.col("documents") * 1000 > F.col("of_host") * LINE_PERMILLE)
             .select("host", "line"))
    return (each.join(above, ["host", "line"])
            .select("doc_id", "text_id", "host", "line", "place", "words").distinct())


def _judged(documents: DataFrame, lost: DataFrame) -> DataFrame:
    """Statistics and verdict by (doc_id, text_id, host)."""
    docs = _documents(documents)
    stats = docs.select("doc_id", "host", _text_id(F.col("text")).alias("text_id"),
                        *(c.alias(k) for k, c in base_columns(F.col("text")).items()))
    stats = stats.select("doc_id", "host", "text_id", "of_words.*", "n_symbols", "n_dup_lines")
    words = lost.groupBy("doc_id", "text_id", "host").agg(F.sum("words").cast("long").alias("lost"))
    left = stats.alias("s").join(words.alias("b"), _same("s", "b"), "left")
    n, failed = F.col("n_words"), F.col("base_failed")
    rest = n - F.col("n_boiler_words")
    return (left.select("s.doc_id", "s.text_id", "s.host", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", F.coalesce("lost", F.lit(0).cast("long")).alias("n_boiler_words"))
            .withColumn("base_failed", (n < LEAST_WORDS)
                        | (F.col("n_repeat_words") * 100 > n * MOST_REPEAT_PERCENT))
            .withColumn("kept", ~failed & (rest >= LEAST_WORDS) & (rest * 100 >= n * LEAST_LEFT_PERCENT)))


def line_frequency_rules(documents: DataFrame) -> DataFrame:
    """``documents(doc_id, text, source)`` -> statistics and verdict, a row for each input row.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_boiler_words, base_failed, kept.  Null text is empty (and
    fails); null source is a host of its own; repeated rows are judged alike;
    an empty table gives no rows.  Other columns are ignored.
    """
    return _judged(documents, boilerplate(documents)).drop("text_id", "host")


def clean_documents(documents: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns, their text without boilerplate lines.

    Lines that stay are unchanged and in order.  ``n_chars``, if there is such a
    column, is set to the new length where lines were removed.  Nulls and
    repeated rows as in ``line_frequency_rules``.
    """
    keys = ["doc_id", "text_id", "host"]
    lost = store(boilerplate(documents), "boilerplate")
    lines = lost.groupBy(*keys).agg(F.collect_set("line").alias("lost"))  # one document's lines at most
    kept = _judged(documents, lost).where("kept").select(*keys).distinct().alias("k")
    verdict = (kept.join(lines.alias("l"), _same("k", "l"), "left").select(*(f"k.{c}" for c in keys), "lost"))
    rows = as_rows(documents)
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    rows = rows.select("row", F.col("row.doc_id").cast("long").alias("doc_id"), _text_id(text).alias("text_id"),
                       _host(F.col("row.source")).alias("host"))
    joined = rows.alias("r").join(verdict.alias("v"), _same("r", "v")).select("row", "lost")
    stays = F.concat_ws("\n", F.filter(F.split("row.text", "\n"), lambda x: ~F.array_contains("lost", _line_hash(x))))
    changed = {"text": stays}
    if "n_chars" in documents.columns:
        changed["n_chars"] = F.length(stays).cast(dict(documents.dtypes)["n_chars"])
    return joined.select(*(
        F.when(F.col("lost").isNull(), F.col(f"row.`{c}`")).otherwise(changed[c]).alias(c) if c in changed
        else F.col(f"row.`{c}`").alias(c) for c in documents.columns))


LINE_FREQUENCY_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce('=' || source, '') AS host FROM documents
), w AS (
  SELECT r, list_filter(string_split_regex(text, '[ \t-\r]+'), lambda x: x <> '') AS words FROM d
), grams AS (
  SELECT r, i, array_to_string(words[i:i + 4], ' ') AS g
  FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) > 4)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1
), rep AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r
), lines AS (
  SELECT r, host, line, ('0x' || left(md5(lower(trim(regexp_replace(line, '[ \t-\r]+', ' ', 'g'), ' '))), 15))::BIGINT AS h,
         len(list_filter(string_split_regex(line, '[ \t-\r]+'), lambda x: x <> '')) AS n
  FROM (SELECT r, host, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^ \t-\r]')
), dup AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r
), document AS (
  SELECT r, list_sort(list(DISTINCT h)) AS hs FROM lines GROUP BY r
), counted AS (
  SELECT host, h, count(DISTINCT hs) AS documents FROM lines JOIN document USING (r) GROUP BY host, h
), hosts AS (
  SELECT host, count(DISTINCT hs) AS of_host FROM lines JOIN document USING (r) GROUP BY host
), above AS (
  SELECT host, h FROM counted JOIN hosts USING (host) WHERE documents > 20 AND documents * 1000 > of_host * 5
), lost AS (
  SELECT r, sum(n) AS n FROM lines JOIN above USING (host, h) GROUP BY r
), stats AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         coalesce(lost.n, 0)::BIGINT AS n_boiler_words
  FROM d JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN lost USING (r)
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
       AND n_words - n_boiler_words >= 10 AND (n_words - n_boiler_words) * 100 >= n_words * 10 AS kept
FROM stats
"""
