from pyspark.sql import functions as F

from feedweave.session import shuffles_released, stage


def shuffled_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in manager.getAllFiles().mkString("\n").split("\n") if "shuffle_" in name}


def test_a_stage_leaves_no_shuffle_files(spark):
    before = shuffled_files(spark)
    rows = stage(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count(), "counts")
    assert not shuffled_files(spark) - before
    assert rows.count() == 10


def test_the_setting_is_given_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with shuffles_released(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, None) == before
