from pyspark.sql import functions as F

from dimforge.llm import shared


def sizes(batches):
    import pyarrow as pa

    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "bytes"])


def test_batches_are_bounded_by_bytes(spark):
    before = spark.conf.get(shared.BATCH_BYTES, None)
    try:
        spark.conf.unset(shared.BATCH_BYTES)
        texts = spark.range(3000, numPartitions=1).select(F.repeat(F.lit("ab c "), F.when(F.col("id") == 7, 10**6).otherwise(1000)).alias("t"))
        got = shared.map_batches(texts, sizes, "n long, bytes long").collect()
        assert sum(r["n"] for r in got) == 3000 and len(got) >= 7
        assert all(r["bytes"] < 2 * shared.MOST_BYTES for r in got if r["bytes"] < 5 * 10**6)
        spark.conf.set(shared.BATCH_BYTES, "1000000000")  # the user's own setting stays
        assert len(shared.map_batches(texts, sizes, "n long, bytes long").collect()) == 1
        assert spark.conf.get(shared.BATCH_BYTES) == "1000000000"
    finally:
        spark.conf.unset(shared.BATCH_BYTES) if before is None else spark.conf.set(shared.BATCH_BYTES, before)


def shuffle_files(spark):
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").count("shuffle_")


def test_a_stored_table_leaves_no_shuffle_files(spark):
    from dimforge.session import SHUFFLE_CLEANUP

    setting = spark.conf.get(SHUFFLE_CLEANUP, None)
    kept = spark.range(1000).repartition(5, "id")
    kept.write.format("noop").mode("overwrite").save()
    before = shuffle_files(spark)
    rows = spark.range(5000).withColumn("k", F.col("id") % 7)
    out = shared.store(rows.repartition(3, "id").groupBy("k").agg(F.max("id").alias("m")), "no-shuffle-files")
    assert out.count() == 7 and out.agg(F.max("m")).first()[0] == 4999
    assert shuffle_files(spark) <= before + 6  # those of the two counts alone
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting
