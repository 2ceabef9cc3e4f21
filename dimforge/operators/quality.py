"""Data-quality and reconciliation checks (Q1-Q22).

Each check returns a DataFrame of violations: empty means pass.  They are
aggregates, anti joins or per-key windows, never pairwise self joins.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str], where=None) -> DataFrame:
    """Keys occurring more than once."""
    src = df if where is None else df.filter(where)
    return src.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNull()
        cond = c if cond is None else (cond | c)
    return df.filter(cond)


def key_summary(named: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """``(name, n_rows)``: for each named table its keys that occur more than
    once (``<name>.duplicate_keys``) and its rows with a NULL in the key
    (``<name>.null_keys``), both from one aggregate."""
    out = None
    for name, (df, keys) in named.items():
        null = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).select("n", null.alias("is_null"))
        both = per_key.agg(F.count_if(F.col("n") > 1).alias("duplicate_keys"),
                           F.coalesce(F.sum(F.when(F.col("is_null"), F.col("n"))), F.lit(0)).alias("null_keys"))
        part = both.select(F.explode(F.array(*[
            F.struct(F.lit(f"{name}.{c}").alias("name"), F.col(c).cast("bigint").alias("n_rows"))
            for c in both.columns])).alias("c")).select("c.*")
        out = part if out is None else out.unionByName(part)
    return out


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-null foreign key has no parent (referential check)."""
    p = parent.select(F.col(pk).alias(fk)).distinct()
    return child.filter(F.col(fk).isNotNull()).join(p, fk, "left_anti")


def domain_violations(df: DataFrame, col: str, allowed: Iterable[str]) -> DataFrame:
    c = F.col(col)
    return df.filter(c.isNull() | ~c.isin(list(allowed)))


def counts(named: dict[str, DataFrame]) -> DataFrame:
    """One row per named input with its row count (reconciliation pairs)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
             for name, df in named.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- type-2 dimension checks -------------------------------------------------

def multiple_current(dim: DataFrame, key: str) -> DataFrame:
    return duplicate_keys(dim, [key], F.col("is_current") == "Y")


def current_flag_inconsistent(dim: DataFrame, key: str) -> DataFrame:
    bad = (((F.col("is_current") == "Y") & F.col("valid_to").isNotNull())
           | ((F.col("is_current") == "N") & F.col("valid_to").isNull()))
    return dim.filter(bad).select(key, "version")


def overlapping_validity(dim: DataFrame, key: str) -> DataFrame:
    """Every version that starts inside an earlier one, a row each: ``version``
    is the earlier one that ends last, ``next_version`` the one inside it.
    The latest end of all preceding versions is a running maximum, so no
    pairs are formed, and a long version is found however many lie between.
    Versions that end before they start are left to ``end_before_start``."""
    far = F.lit("9999-12-31").cast("date")
    lasts = F.coalesce("valid_to", far) > F.col("valid_from")  # the others cover nothing
    w = (Window.partitionBy(key).orderBy("valid_from", lasts, "version")
         .rowsBetween(Window.unboundedPreceding, -1))
    real = F.when(lasts, F.struct(F.coalesce("valid_to", far).alias("end"), F.col("version")))
    seen = dim.select(key, F.col("version").alias("next_version"), "valid_from", "valid_to",
                      F.max(real).over(w).alias("cover"))
    return (seen.filter((F.col("valid_from") < F.col("cover.end"))
                        & (F.coalesce("valid_to", far) >= F.col("valid_from")))
            .select(key, F.col("cover.version").alias("version"), "next_version"))


def end_before_start(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("valid_to").isNotNull() & (F.col("valid_to") < F.col("valid_from")))


def versions_per_key(dim: DataFrame, key: str) -> DataFrame:
    return dim.groupBy(key).agg(F.count(F.lit(1)).alias("n_versions"),
                                F.count_if(F.col("is_current") == "Y").alias("n_current"))


def missing_from(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source rows absent from the target (EXCEPT, distinct) — reconciliation."""
    return source.subtract(target)
