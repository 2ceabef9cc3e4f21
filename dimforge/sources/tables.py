"""Reading the given parquet tables.

Each table is one parquet dataset under ``sf_dir``.  Callers select the
columns they need; Catalyst prunes the parquet ``ReadSchema`` and pushes
filters into the scan, so nothing beyond those columns is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Opens the table anew, so that files which landed since are seen."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


class Tables:
    """Lazy accessor: ``t.orders`` opens ``orders.parquet`` on first use; one
    object is the snapshot of one run."""

    def __init__(self, spark: SparkSession, sf_dir: str, filters: dict | None = None):
        """``filters``: table -> predicate Column, e.g. the state of the
        sources as of a cut date (pushed down into the parquet scan)."""
        self.spark = spark
        self.sf_dir = sf_dir
        self._filters = filters or {}
        self._cache: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, frames: dict[str, DataFrame]) -> "Tables":
        """The given frames under the tables' names, e.g. the images a change feed has left."""
        tables = cls(spark, "")
        tables._cache.update(frames)
        return tables

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            df = read_table(self.spark, self.sf_dir, name)
            if name in self._filters:
                df = df.filter(self._filters[name])
            self._cache[name] = df
        return self._cache[name]
