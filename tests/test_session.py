"""What a job leaves on disk."""
from tellmark.session import stored, without_shuffle_files

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}


def test_shuffle_files_of_a_stored_table_go_once_it_is_written(spark):
    before = _shuffle_files(spark)
    table = stored(spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count(), "counts")
    assert _shuffle_files(spark) <= before
    assert table.count() == 7


def test_the_setting_is_as_before_afterwards(spark):
    own = spark.conf.get(CLEANUP, None)
    with without_shuffle_files(spark):
        assert spark.conf.get(CLEANUP) == "true"
    assert spark.conf.get(CLEANUP, None) == own
    spark.conf.set(CLEANUP, "false")
    try:
        with without_shuffle_files(spark):
            assert spark.conf.get(CLEANUP) == "true"
        assert spark.conf.get(CLEANUP) == "false"
    finally:
        spark.conf.unset(CLEANUP)
