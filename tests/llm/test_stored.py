"""What a stored table leaves on the executors' disks."""

from pathlib import Path

from pyspark.sql import functions as F

from dayfold.llm.common import stored


def shuffled_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f.name for d in folders for f in Path(d.getPath()).rglob("shuffle_*.data")}


def test_the_shuffles_of_a_stored_table_go_with_its_write(spark):
    before = shuffled_files(spark)
    set_before = dict(spark.conf.getAll)
    rows = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).agg(F.max("id").alias("m"))
    kept = stored(rows.join(spark.range(10).withColumnRenamed("id", "k").hint("merge"), "k"), "shuffled")
    assert not shuffled_files(spark) - before
    assert sorted(tuple(r) for r in kept.collect()) == [(k, 990 + k) for k in range(10)]
    assert rows.count() == 10  # what is not stored can be computed again
    assert dict(spark.conf.getAll) == set_before
