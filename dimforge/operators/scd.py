"""Slowly changing dimensions: type 2 with type-1 attributes, and type 1.

A type-2 dimension carries ``sk`` (deterministic surrogate key), the natural
key, type-1 and type-2 attributes, ``version``, half-open validity
``[valid_from, valid_to)`` (``valid_to`` NULL = open) and ``is_current``
('Y' / 'N').

Nothing is updated in place: every function returns the new dimension,
which the caller publishes as a new version (see ``dimforge.publish``).

Scale notes
* Collapsing a change batch to the last state per key is a hash aggregate
  (``max_by``), safe when one key holds a third of the batch.
* Only *current* rows meet the change batch in a join; closed history rows
  pass through untouched.  AQE broadcasts the batch side when its measured
  size is under the threshold and falls back to sort-merge otherwise.
* ``scd2_history`` windows per key only over the per-batch states (at most
  one row per key and batch), never over raw change rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimforge.functions import keys as K
from dimforge.operators.dedup import last_state_per_key


@dataclass(frozen=True)
class Scd2Spec:
    namespace: str
    key: str
    type1: tuple[str, ...]
    type2: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return (["sk", self.key, *self.type1, *self.type2,
                 "version", "valid_from", "valid_to", "is_current"])


def _sk(spec: Scd2Spec, version) -> Column:
    return K.surrogate_key(spec.namespace, F.col(spec.key), version)


def _differs(a_cols, b_cols) -> Column:
    """Type-2 change test: any attribute distinct (null-safe)."""
    cond = None
    for a, b in zip(a_cols, b_cols):
        c = ~F.col(a).eqNullSafe(F.col(b))
        cond = c if cond is None else (cond | c)
    return cond


def scd2_initial(src: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Every member as version 1, valid from the sentinel date, open, current."""
    return src.select(
        _sk(spec, F.lit(1)).alias("sk"),
        spec.key, *spec.type1, *spec.type2,
        F.lit(1).alias("version"),
        F.lit(K.VALID_FROM_SENTINEL).cast("date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit("Y").alias("is_current"),
    )


def collapse_changes(changes: DataFrame, spec: Scd2Spec, ts_col: str, seq_col: str,
                     carry: tuple[str, ...] = ()) -> DataFrame:
    """Last state per key of one batch (ties on ``ts_col`` broken by the feed
    sequence ``seq_col``), with ``change_date`` = date of that last change."""
    values = [*spec.type2, *carry, ts_col]
    last = last_state_per_key(changes, [spec.key], [ts_col, seq_col], values)
    return last.withColumn("change_date", F.col(ts_col).cast("date")).drop(ts_col)


def _with_type1(newcomers: DataFrame, dim: DataFrame, spec: Scd2Spec, type1_source: DataFrame | None) -> DataFrame:
    """Newcomers with their type-1 attributes: from ``type1_source`` (a row per
    key) if given, else those the feed carries, else NULL."""
    if type1_source is not None:
        return newcomers.join(type1_source.select(spec.key, *spec.type1), spec.key, "left")
    return newcomers.select("*", *[F.lit(None).cast(dim.schema[c].dataType).alias(c)
                                   for c in spec.type1 if c not in newcomers.columns])


def scd2_apply(dim: DataFrame, changes: DataFrame, spec: Scd2Spec, ts_col: str,
               seq_col: str, type1_source: DataFrame | None = None) -> DataFrame:
    """Apply one change batch to a type-2 dimension.

    * keys not in the dimension enter as version 1 from the sentinel date, with
      type-1 attributes from ``type1_source`` or from the feed's own columns;
    * a key whose last state in the batch differs from its current version on
      any type-2 attribute gets version N+1 valid from the change date, and
      version N is closed at that date (``is_current`` -> 'N');
    * type-1 attributes on a new version are copied from the current one
      (``scd1_overwrite`` refreshes them on all versions).
    """
    k = spec.key
    carried = tuple(c for c in spec.type1 if c in changes.columns) if type1_source is None else ()
    last = collapse_changes(changes, spec, ts_col, seq_col, carried)
    new_cols = {c: f"_new_{c}" for c in spec.type2}
    last_r = last.select(k, *[F.col(c).alias(n) for c, n in new_cols.items()], "change_date")

    current = dim.filter(F.col("is_current") == "Y")
    history = dim.filter(F.col("is_current") != "Y")

    j = current.join(last_r, k, "left")
    changed = F.col("change_date").isNotNull() & _differs(spec.type2, list(new_cols.values()))
    j = j.withColumn("_changed", F.coalesce(changed, F.lit(False)))

    kept_current = j.select(
        "sk", k, *spec.type1, *spec.type2, "version", "valid_from",
        F.when(F.col("_changed"), F.col("change_date")).otherwise(F.col("valid_to")).alias("valid_to"),
        F.when(F.col("_changed"), F.lit("N")).otherwise(F.col("is_current")).alias("is_current"),
    )
    opened = j.filter(F.col("_changed")).select(
        _sk(spec, F.col("version") + 1).alias("sk"),
        k, *spec.type1,
        *[F.col(n).alias(c) for c, n in new_cols.items()],
        (F.col("version") + 1).alias("version"),
        F.col("change_date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit("Y").alias("is_current"),
    )
    newcomers = _with_type1(last.join(current.select(k), k, "left_anti"), dim, spec, type1_source)
    inserted = newcomers.select(
        _sk(spec, F.lit(1)).alias("sk"), k, *spec.type1, *spec.type2,
        F.lit(1).alias("version"),
        F.lit(K.VALID_FROM_SENTINEL).cast("date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit("Y").alias("is_current"),
    )
    cols = spec.columns
    return (history.select(*cols).unionByName(kept_current.select(*cols))
            .unionByName(opened.select(*cols)).unionByName(inserted.select(*cols)))


def scd2_close(dim: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Close every version at the start of the next one (the ``lead`` form of
    the N / N+1 self-join); the last version per key stays open and current."""
    w = Window.partitionBy(spec.key).orderBy("version")
    nxt = F.lead("valid_from").over(w)
    return dim.select(
        "sk", spec.key, *spec.type1, *spec.type2, "version", "valid_from",
        nxt.alias("valid_to"),
        F.when(nxt.isNull(), F.lit("Y")).otherwise(F.lit("N")).alias("is_current"),
    )


def scd2_apply_batches(dim: DataFrame, changes: DataFrame, spec: Scd2Spec, ts_col: str,
                       seq_col: str, batch: Column, type1_source: DataFrame | None = None) -> DataFrame:
    """Apply a sequence of change batches (ordered by ``batch``) in one pass.

    Equivalent to calling ``scd2_apply`` once per batch in order: within a
    batch only the last state counts; a batch opens a version when its state
    differs from the previous batch's state, which equals the current
    version (a state that opened nothing equals it).  Closed history rows
    pass through untouched; the window per key sees one current row plus at
    most one state per batch.
    """
    k = spec.key
    current = dim.filter(F.col("is_current") == "Y")
    history = dim.filter(F.col("is_current") != "Y")
    carried = [c for c in spec.type1 if c in changes.columns] if type1_source is None else []
    states = last_state_per_key(changes.withColumn("_batch", batch), [k, "_batch"],
                                [ts_col, seq_col], [*spec.type2, *carried, ts_col])
    # Only members with changes go through the per-key window; the rest of
    # the current rows pass through.  One join against the batch's keys
    # (broadcast by AQE when the batch is small, so the dimension is not
    # shuffled) marks them.
    touched_keys = states.select(k).distinct().withColumn("_touched", F.lit(True))
    marked = current.join(touched_keys, k, "left")
    untouched = marked.filter(F.col("_touched").isNull()).drop("_touched")
    current = marked.filter(F.col("_touched")).drop("_touched")
    btype = states.schema["_batch"].dataType
    states = _with_type1(states, dim, spec, type1_source)
    states = states.select(
        k, *spec.type2, "_batch", F.col(ts_col).cast("date").alias("valid_from"),
        F.lit(0).alias("_init"), F.lit(None).cast("int").alias("_v0"), *spec.type1)
    init = current.select(k, *spec.type2, F.lit(None).cast(btype).alias("_batch"), "valid_from",
                          F.lit(1).alias("_init"), F.col("version").cast("int").alias("_v0"), *spec.type1)
    u = init.unionByName(states)
    w = Window.partitionBy(k).orderBy(F.col("_init").desc(), F.col("_batch"))
    u = u.select(
        k, *spec.type2, "_batch", "valid_from", "_init",
        F.row_number().over(w).alias("_pos"),
        F.first("_v0", ignorenulls=True).over(w).alias("_base"),
        # those of the current version, or of a newcomer's first state
        *[F.first(c).over(w).alias(c) for c in spec.type1],
        *[F.lag(c).over(w).alias(f"_prev_{c}") for c in spec.type2])
    keep = (F.col("_pos") == 1) | _differs(spec.type2, [f"_prev_{c}" for c in spec.type2])
    kept = u.filter(keep).select(
        k, *spec.type1, *spec.type2, "_init", "_batch", "_base",
        F.when(F.col("_init") == 1, F.col("valid_from"))
         .when(F.col("_pos") == 1, F.lit(K.VALID_FROM_SENTINEL).cast("date"))
         .otherwise(F.col("valid_from")).alias("valid_from"))
    w2 = Window.partitionBy(k).orderBy(F.col("_init").desc(), F.col("_batch"))
    version = (F.coalesce(F.col("_base") - 1, F.lit(0)) + F.row_number().over(w2)).cast("int")
    versioned = kept.select(k, *spec.type1, *spec.type2, "valid_from", version.alias("version"),
                            F.lead("valid_from").over(w2).alias("valid_to"))
    out = versioned.select(
        _sk(spec, F.col("version")).alias("sk"), k, *spec.type1, *spec.type2,
        "version", "valid_from", "valid_to",
        F.when(F.col("valid_to").isNull(), F.lit("Y")).otherwise(F.lit("N")).alias("is_current"))
    cols = spec.columns
    return history.select(*cols).unionByName(untouched.select(*cols)).unionByName(out.select(*cols))


def scd2_history(initial: DataFrame, changes: DataFrame, spec: Scd2Spec, ts_col: str,
                 seq_col: str, batch: Column, type1_source: DataFrame | None = None) -> DataFrame:
    """Full history from the initial load and the whole change feed."""
    return scd2_apply_batches(initial, changes, spec, ts_col, seq_col, batch, type1_source)


def scd1_overwrite(dim: DataFrame, source: DataFrame, key: str, cols: tuple[str, ...],
                   only_keys: DataFrame | None = None) -> DataFrame:
    """Type-1 overwrite of ``cols`` on *all* versions of a key, from the
    source's current values, optionally only for keys in ``only_keys``
    (e.g. the keys of an update batch).  Source values win even when NULL."""
    src = source.select(key, *[F.col(c).alias(f"_src_{c}") for c in cols], F.lit(True).alias("_hit"))
    if only_keys is not None:
        src = src.join(only_keys.select(key).distinct(), key, "left_semi")
    j = dim.join(src, key, "left")
    out = [F.when(F.col("_hit"), F.col(f"_src_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
           for c in dim.columns]
    return j.select(*out)


def scd1_refresh_external(dim: DataFrame, curated: DataFrame, dim_key: Column, curated_key: str,
                          mapping: dict[str, str], derived: dict[str, Column] | None = None,
                          on_missing: str = "keep") -> DataFrame:
    """Overwrite externally sourced attributes on every row whose computed key
    matches the curated table, touching only rows where a value is distinct.

    ``mapping``: dim column -> curated column.  ``derived``: dim column ->
    expression over the (refreshed) dim columns, recomputed for changed rows.
    ``on_missing='keep'`` leaves unmatched rows alone; ``'null'`` clears them.
    Adds ``_changed`` (bool) so callers can count rewritten rows.
    """
    cur = curated.select(F.col(curated_key).alias("_ck"), F.lit(True).alias("_m"),
                         *[F.col(c).alias(f"_ext_{d}") for d, c in mapping.items()])
    j = dim.withColumn("_ck", dim_key).join(cur, "_ck", "left")
    is_match = F.coalesce(F.col("_m"), F.lit(False))
    any_diff = None
    for d in mapping:
        c = ~F.col(d).eqNullSafe(F.col(f"_ext_{d}"))
        any_diff = c if any_diff is None else (any_diff | c)
    if on_missing == "null":
        changed = F.when(is_match, any_diff).otherwise(_any_not_null(list(mapping)))
    else:
        changed = is_match & any_diff
    j = j.withColumn("_changed", F.coalesce(changed, F.lit(False)))
    sel = []
    for c in dim.columns:
        if c in mapping:
            new = F.when(is_match, F.col(f"_ext_{c}")).otherwise(
                F.lit(None) if on_missing == "null" else F.col(c))
            sel.append(F.when(F.col("_changed"), new).otherwise(F.col(c)).alias(c))
        else:
            sel.append(F.col(c))
    out = j.select(*sel, "_changed")
    for c, expr in (derived or {}).items():
        out = out.withColumn(c, F.when(F.col("_changed"), expr).otherwise(F.col(c)))
    return out


def _any_not_null(cols: list[str]) -> Column:
    cond = None
    for c in cols:
        x = F.col(c).isNotNull()
        cond = x if cond is None else (cond | x)
    return cond


def split_late_changes(dim: DataFrame, changes: DataFrame, spec: Scd2Spec,
                       ts_col: str) -> tuple[DataFrame, DataFrame]:
    """Separate changes dated before the start of their member's current
    version: applying them would open a version that overlaps history.
    Returns ``(on_time, late)``; ``late`` carries ``current_from`` and goes
    to quarantine (same-day changes are on time)."""
    cur = dim.filter(F.col("is_current") == "Y").select(spec.key, F.col("valid_from").alias("current_from"))
    j = changes.join(cur, spec.key, "left")
    late = F.coalesce(F.col(ts_col).cast("date") < F.col("current_from"), F.lit(False))
    return j.filter(~late).drop("current_from"), j.filter(late)
