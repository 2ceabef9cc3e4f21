"""Streaming twin of the idempotent bronze append (S3, L1).

A file-source stream over the landing folders, checkpointed under the shared
checkpoint root and run with ``trigger(availableNow=True)``: each run appends
exactly the files that landed since the previous run (a file already
ingested is never read again), then stops.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def ingest_landing_once(spark: SparkSession, landing_glob: str, columns: list[str], bronze: str,
                        checkpoint: str, ingested_at) -> None:
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    raw = (spark.readStream.schema(schema).option("header", True).option("encoding", "UTF-8")
           .option("enforceSchema", False)
           .csv(landing_glob))
    stamped = raw.select("*",
                         F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1).alias("_source_file"),
                         ingested_at.alias("_ingested_at"))
    q = (stamped.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(bronze))
    q.awaitTermination()
