"""Join shapes used by fact loads.

``validity_join`` (J2) is an equi-join on the natural key with a residual
range predicate, so Spark plans a hash / sort-merge join keyed on the member
id with the range as a join condition — never a cartesian product.  A hot
member id on the fact side is split by AQE's skew-join handling.

``validity_merge`` gives the same rows for histories so long that events times
versions of a key are too many candidates: both sides become one stream, sorted
within (key, span of time), that carries the version in force along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def validity_join(facts: DataFrame, dim: DataFrame, fact_key: str, fact_date: Column,
                  dim_key: str, how: str = "inner", dim_alias: str = "v") -> DataFrame:
    """Attach the dimension version in force at ``fact_date``:
    ``dim_key = fact_key and valid_from <= d and (valid_to is null or d < valid_to)``.
    The dimension columns come back prefixed ``{dim_alias}_``."""
    d = dim.select(*[F.col(c).alias(f"{dim_alias}_{c}") for c in dim.columns])
    fd = fact_date
    cond = ((F.col(fact_key) == F.col(f"{dim_alias}_{dim_key}"))
            & (fd >= F.col(f"{dim_alias}_valid_from"))
            & (F.col(f"{dim_alias}_valid_to").isNull() | (fd < F.col(f"{dim_alias}_valid_to"))))
    return facts.join(d, cond, how)


def validity_merge(facts: DataFrame, dim: DataFrame, fact_key: str, fact_date: Column,
                   dim_key: str, how: str = "inner", dim_alias: str = "v", span_days: int = 31) -> DataFrame:
    """The rows of ``validity_join`` (inner or left) for versions of a key that don't overlap, without candidates.

    Each (key, span of ``span_days``) is sorted on its own, so that a hot key is spread over as many tasks as its events
    have spans.  What a span begins with is the last version of the spans before it; this carry is found on one row per
    key and span, whatever the number of events.  A version that begins at the time of an event holds for it; versions
    that end when or before they begin hold for none; facts without key or time have no version.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"inner or left, not {how}")
    span = F.floor(F.unix_seconds("_t") / F.lit(span_days * 86400)).alias("_span")
    versions = (dim.filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))
                .select(F.col(dim_key).alias("_k"), F.col("valid_from").cast("timestamp").alias("_t"),
                        F.struct(*dim.columns).alias("_v"))
                .dropna(subset=["_k", "_t"]).select("*", span, F.lit(1).alias("_rank")))
    stamped = facts.select(F.col(fact_key).alias("_k"), fact_date.cast("timestamp").alias("_t"),
                           F.struct(*facts.columns).alias("_f"))
    known = F.col("_k").isNotNull() & F.col("_t").isNotNull()
    events = stamped.filter(known).select("*", span, F.lit(2).alias("_rank"))

    spans = (versions.groupBy("_k", "_span").agg(F.max_by("_v", "_t").alias("_v"))
             .unionByName(events.select("_k", "_span", F.lit(True).alias("_used")).distinct(), allowMissingColumns=True)
             .groupBy("_k", "_span").agg(F.first("_v", ignorenulls=True).alias("_v"), F.max("_used").alias("_used")))
    before = Window.partitionBy("_k").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = (spans.withColumn("_v", F.last("_v", ignorenulls=True).over(before))
               .filter(F.col("_used") & F.col("_v").isNotNull()).select("_k", "_span", "_v", F.lit(0).alias("_rank")))

    along = (Window.partitionBy("_k", "_span").orderBy(F.col("_t").asc_nulls_first(), "_rank")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    merged = (events.unionByName(versions, allowMissingColumns=True).unionByName(carried, allowMissingColumns=True)
              .withColumn("_v", F.last("_v", ignorenulls=True).over(along)).filter(F.col("_rank") == 2))
    in_force = F.col("_v").isNotNull() & (F.col("_v.valid_to").isNull() | (F.col("_t") < F.col("_v.valid_to")))
    if how == "inner":
        merged = merged.filter(in_force)
    else:
        merged = (merged.withColumn("_v", F.when(in_force, F.col("_v")))
                  .unionByName(stamped.filter(~known), allowMissingColumns=True))
    return merged.select("_f.*", *[F.col("_v")[c].alias(f"{dim_alias}_{c}") for c in dim.columns])
