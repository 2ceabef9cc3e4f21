"""Latest-row-per-key operators.

Both forms are skew-safe for a key holding a large share of the rows:

* ``latest_per_key`` is ``row_number() == 1``; Catalyst turns it into a
  partial ``WindowGroupLimit`` *before* the shuffle, so at most one row per
  key per input partition crosses the network.
* ``last_state_per_key`` is a ``groupBy`` with ``max_by`` over a struct
  ordering key: a plain hash aggregate with map-side partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (list of sort Columns,
    e.g. ``[F.col('ts').desc(), F.col('id').desc()]``).  Make the order total
    (end with a unique column) so the result is deterministic."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def last_state_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                       value_cols: Sequence[str]) -> DataFrame:
    """Values of the row with the greatest ``order_cols`` tuple per key.

    ``max_by(struct(values), struct(order))`` is a declarative aggregate, so
    Spark combines partially on the map side before shuffling by key.
    """
    picked = F.max_by(F.struct(*value_cols), F.struct(*order_cols)).alias("_last")
    out = df.groupBy(*keys).agg(picked)
    return out.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in value_cols])
