import time

import pytest
from pyspark.sql import functions as F

from cadastria.llm.common import written
from cadastria.session import shuffles_released, stored
from cadastria.sources.store import TableStore


def shuffle_files(spark) -> set[str]:
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


@pytest.mark.parametrize("write", [
    lambda df: stored(df), lambda df: written(df, "t"),
    lambda df: TableStore(df.sparkSession, "released").table("t", lambda: df)])
def test_a_written_table_leaves_no_shuffle_files(spark, write):
    before = shuffle_files(spark)
    table = write(spark.range(20_000).repartition(6, "id").groupBy((F.col("id") % 700).alias("k")).count())
    end = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.1)  # they are removed beside the driver's work
    assert not left
    assert table.agg(F.count("*"), F.sum("count")).first() == (700, 20_000)


def test_the_setting_is_put_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    for value in (None, "false"):
        if value:
            spark.conf.set(key, value)
        with pytest.raises(ValueError), shuffles_released(spark):
            assert spark.conf.get(key) == "true"
            raise ValueError
        assert spark.conf.get(key, None) == value
    spark.conf.unset(key)
