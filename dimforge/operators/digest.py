"""Which rows differ between two large tables, by checksums per range of keys.

Both tables are reduced to order-independent checksums per bucket of the key's
hash.  Only buckets whose checksums differ are cut finer and summed again, and
only the rows of the finest differing buckets are shuffled and compared.  Equal
tables thus shuffle nothing but bucket sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVELS = (256, 65_536)  # buckets of the key's hash at each level, each a multiple of the one before

_SUMS = ("n", "low", "high")


def bucket_sums(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``rows`` with a column ``bucket`` -> its number of rows and the sums of both halves of their hashes.

    Halves of 32 bits, so that a sum holds 2**31 rows of a bucket.  The hash
    skips nulls, so which columns are null goes into it too.
    """
    h = F.xxhash64(*(F.col(f"`{c}`") for c in columns), *(F.col(f"`{c}`").isNull() for c in columns))
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"),
                                      F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
                                      F.sum(F.shiftrightunsigned(h, 32)).alias("high"))


def differences(left: DataFrame, right: DataFrame, key: Sequence[str], levels: Sequence[int] = LEVELS) -> DataFrame:
    """Distinct rows that only one table has, with ``side`` 'left' or 'right': EXCEPT in both directions.

    Both tables have the same columns, none of them named bucket.  Null keys and
    values equal each other.  Rows present more often in one table are no
    difference.  Two different buckets look alike with a chance of 2**-64.  The
    differing buckets are broadcast: no more than ``levels[-1]`` numbers.
    """
    columns = left.columns
    sides = [left, right.select(*(F.col(f"`{c}`") for c in columns))]
    place = F.xxhash64(*(F.col(f"`{c}`") for c in key))
    for size in levels:
        sides = [s.withColumn("bucket", F.pmod(place, F.lit(size))) for s in sides]
        a, b = (bucket_sums(s, columns) for s in sides)
        b = b.select(F.col("bucket").alias("other"), *(F.col(c).alias(f"r_{c}") for c in _SUMS))
        same = F.lit(True)
        for c in _SUMS:
            same = same & F.col(c).eqNullSafe(F.col(f"r_{c}"))
        differing = (a.join(b, F.col("bucket") == F.col("other"), "full").where(~same)
                     .select(F.coalesce("bucket", "other").alias("bucket")))
        sides = [s.join(F.broadcast(differing), "bucket", "left_semi").drop("bucket") for s in sides]
    a, b = sides
    return a.subtract(b).withColumn("side", F.lit("left")).unionByName(b.subtract(a).withColumn("side", F.lit("right")))
