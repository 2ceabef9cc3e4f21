"""A change feed as text: one JSON line per change of any source table (K1-K4).

A line holds the source's name, the action (I, U, D), a sequence number that
grows within its source, the time of the change, and the row as JSON text.
``route`` parses every line once and writes one table partitioned by source, with
a typed struct per source; lines that can't be loaded go, with line and reason,
to a partition of their own.  The counts come from the same pass.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dimforge import publish as P

ENVELOPE = "source string, action string, seq bigint, change_ts timestamp_ntz, payload string, _corrupt string"
TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
PARSING = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", **TIMES}
REJECTS = "_rejects"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@dataclass(frozen=True)
class Source:
    """A source table of the feed: its columns and its primary key."""

    schema: StructType
    key: tuple[str, ...]


def to_lines(rows: DataFrame, source: str, action: Column, seq: Column, change_ts: Column) -> DataFrame:
    """``value``: a feed line for each row (what a capture process at the source writes)."""
    payload = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false", **TIMES})
    line = F.struct(F.lit(source).alias("source"), action.alias("action"), seq.cast("long").alias("seq"),
                    change_ts.cast("timestamp_ntz").alias("change_ts"), payload.alias("payload"))
    return rows.select(F.to_json(line, TIMES).alias("value"))


def parse(lines: DataFrame, sources: dict[str, Source]) -> DataFrame:
    """``value`` lines -> action, seq, change_ts, a struct per source, line, reason (null if the line can be loaded)."""
    e = lines.select("value", F.from_json("value", ENVELOPE, PARSING).alias("e"))
    typed = {n: F.when(F.col("e.source") == n, F.from_json("e.payload", StructType([*s.schema]).add("_corrupt", "string"), PARSING))
             for n, s in sources.items()}
    e = e.select("value", "e", *(c.alias(f"row_{n}") for n, c in typed.items()))
    fault = F
    for n, s in sources.items():  # one chain, left at the line's own source
        keyless = reduce(or_, (F.col(f"row_{n}.{k}").isNull() for k in s.key))
        fault = fault.when(F.col("e.source") == n, F.when(F.col(f"row_{n}").isNull() | F.col(f"row_{n}._corrupt").isNotNull(),
                                                          "row doesn't fit the table").when(keyless, "no key"))
    reason = (F.when(F.col("e").isNull() | F.col("e._corrupt").isNotNull(), "not a feed line")
              .when(~F.coalesce(F.col("e.source").isin(*sources), F.lit(False)), "unknown source")
              .when(~F.coalesce(F.col("e.action").isin("I", "U", "D"), F.lit(False)), "unknown action")
              .when(F.col("e.seq").isNull() | F.col("e.change_ts").isNull(), "no sequence number or time")
              .otherwise(fault))
    # the reason is a column of its own, used by name, and the structs stay as parsed: written out for each column, they
    # make a method too long for the JIT compiler
    e = e.withColumn("reason", reason)
    return e.select(F.when(F.col("reason").isNull(), F.col("e.source")).otherwise(REJECTS).alias("of_source"),
                    "e.action", "e.seq", "e.change_ts", *(f"row_{n}" for n in sources),
                    F.when(F.col("reason").isNotNull(), F.col("value")).alias("line"), "reason")


class Routed:
    """A routed feed: ``counts`` of its lines, typed rows by source, and the rejects."""

    def __init__(self, table: DataFrame, sources: dict[str, Source], counts: dict[str, int]):
        self.table, self.sources, self.counts = table, sources, counts

    def of(self, source: str) -> DataFrame:
        """The source's rows as ``_action, _seq, _change_ts`` and its own columns; reads its partition only."""
        return (self.table.where(F.col("of_source") == source)
                .select(F.col("action").alias("_action"), F.col("seq").alias("_seq"), F.col("change_ts").alias("_change_ts"),
                        *(F.col(f"row_{source}.`{c}`") for c in self.sources[source].schema.names)))

    def rejects(self) -> DataFrame:
        return self.table.where(F.col("of_source") == REJECTS).select("line", "reason")


def route(lines: DataFrame, sources: dict[str, Source], path: str, behind: dict[str, int] | None = None) -> Routed:
    """Parse ``lines`` once and write them to ``path`` by source; read = loadable + rejected, counted by that write.

    ``behind``: source -> the last sequence number consumed; rows up to it are counted and not written.
    """
    parsed = parse(lines, sources)
    seen = Observation()
    counted = parsed.observe(seen, F.count(F.lit(1)).alias("n_read"), F.count_if(F.col("reason").isNull()).alias("n_loadable"),
                             F.count_if(F.col("reason").isNotNull()).alias("n_rejected"))
    for n, seq in (behind or {}).items():
        counted = counted.where((F.col("of_source") != n) | (F.col("seq") > seq))
    conf = lines.sparkSession.conf
    before = conf.get(WRITERS)
    conf.set(WRITERS, str(max(int(before), len(sources) + 2)))  # a file of each source open, so that no task sorts its rows
    try:
        counted.write.mode("errorifexists").partitionBy("of_source").parquet(path)
    finally:
        conf.set(WRITERS, before)
    table = lines.sparkSession.read.schema(parsed.schema).parquet(path)
    return Routed(table, sources, {k: int(v) for k, v in seen.get.items()})


def latest_images(log: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """The last image of every key that isn't deleted, from an append-only log of ``of`` rows.

    A semi join on the key's columns reaches below the aggregate, so a rebuild of
    few keys reads few rows' images.
    """
    columns = [c for c in log.columns if not c.startswith("_")]
    rest = [c for c in columns if c not in key]
    last = log.groupBy(*key).agg(F.max_by(F.struct("_action", *rest), "_seq").alias("last"))
    return last.where(F.col("last._action") != "D").select(*(F.col(c) if c in key else F.col(f"last.`{c}`") for c in columns))


MARKS = "source string, seq bigint, change_ts timestamp_ntz, n_changes bigint, rewritten boolean"


def stored_marks(spark, root: str) -> dict[str, tuple]:
    """How far each source is consumed: source -> (seq, change_ts, n_changes, whether any U or D came). A row per source."""
    marks = P.read_current(spark, root, "marks")
    return {} if marks is None else {r["source"]: tuple(r)[1:] for r in marks.select(
        "source", "seq", "change_ts", "n_changes", "rewritten").collect()}


def route_csv(lines: DataFrame, source: Source, path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """The same for CSV ``value`` lines of one table: ``(rows, rejects(line, reason), counts)``."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema) + ", _corrupt string"
    parsed = lines.select("value", F.from_csv("value", ddl, PARSING).alias("r"))
    keyless = F.greatest(*(F.col(f"r.{k}").isNull().cast("int") for k in source.key), F.lit(0)) == 1
    reason = F.when(F.col("r").isNull() | F.col("r._corrupt").isNotNull(), "row doesn't fit the table").when(keyless, "no key")
    table = parsed.select(*(F.when(reason.isNull(), F.col(f"r.`{c}`")).alias(c) for c in source.schema.names),
                          F.when(reason.isNotNull(), F.col("value")).alias("_line"), reason.alias("_reason"))
    seen = Observation()
    (table.observe(seen, F.count(F.lit(1)).alias("n_read"), F.count_if(F.col("_reason").isNull()).alias("n_loadable"),
                   F.count_if(F.col("_reason").isNotNull()).alias("n_rejected"))
     .write.mode("errorifexists").parquet(path))
    written = lines.sparkSession.read.schema(table.schema).parquet(path)
    return (written.where(F.col("_reason").isNull()).drop("_line", "_reason"),
            written.where(F.col("_reason").isNotNull()).select(F.col("_line").alias("line"), F.col("_reason").alias("reason")),
            {k: int(v) for k, v in seen.get.items()})
