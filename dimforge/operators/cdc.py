"""Change capture from snapshots, audit log, typed deltas, quarantine (K1-K4).

Databases capture changes with per-row triggers; on a lake the
same information comes from diffing two snapshots on the primary key (one
full outer join) or from an upstream change feed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

JSON_OPTS = {"ignoreNullFields": "false"}


def snapshot_diff(old: DataFrame, new: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Compare two snapshots of one table.

    Returns ``pk..., action ('I' | 'U' | 'D'), old (struct), new (struct)``
    for inserted, updated (any column distinct, null-safe) and deleted rows;
    unchanged rows are dropped."""
    pk = list(pk)
    cols = [c for c in old.columns if c not in pk]
    o = old.select(*pk, F.struct(*old.columns).alias("old"), F.lit(True).alias("_in_old"))
    n = new.select(*pk, F.struct(*new.columns).alias("new"), F.lit(True).alias("_in_new"))
    j = o.join(n, pk, "full")
    differs = None
    for c in cols:
        d = ~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
        differs = d if differs is None else (differs | d)
    action = (F.when(F.col("_in_old").isNull(), "I")
              .when(F.col("_in_new").isNull(), "D")
              .when(differs, "U"))
    return j.select(*pk, action.alias("action"), "old", "new").filter(F.col("action").isNotNull())


def audit_log(diff: DataFrame, schema_name: str, table_name: str, action_ts: Column,
              user_name: Column | None = None) -> DataFrame:
    """Generic change log: row images as JSON text (``to_json(struct)``)."""
    return diff.select(
        F.lit(schema_name).alias("schema_name"),
        F.lit(table_name).alias("table_name"),
        (user_name if user_name is not None else F.lit(None).cast("string")).alias("user_name"),
        action_ts.alias("action_ts"),
        F.col("action"),
        F.when(F.col("action") != "I", F.to_json("old", JSON_OPTS)).alias("original_data"),
        F.when(F.col("action") != "D", F.to_json("new", JSON_OPTS)).alias("new_data"),
    )


def typed_delta(diff: DataFrame, action: str, change_ts: Column | None = None) -> DataFrame:
    """Typed mirror of one action: the new image's columns (old image for
    deletes), plus ``change_ts`` for update deltas."""
    image = "old" if action == "D" else "new"
    out = diff.filter(F.col("action") == action).select(f"{image}.*")
    if change_ts is not None:
        out = out.withColumn("change_ts", change_ts)
    return out


def split_quarantine(feed: DataFrame, valid: Column, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Well-formed change rows, and malformed ones with a reason: malformed
    rows never block the load and are never silently lost."""
    ok = feed.filter(valid)
    bad = feed.filter(~valid | valid.isNull()).withColumn("reason", reason)
    return ok, bad
