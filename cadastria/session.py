"""Session defaults and the shared folder that tables and checkpoints go to."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cadastria")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; only a local session may fall back to its own."""
    conf = spark.sparkContext.getConf()
    configured = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    own = tempfile.mkdtemp(prefix="cadastria-", dir=os.environ.get("TMPDIR"))
    spark.sparkContext.setCheckpointDir(own)
    delete_at_end(spark, own)
    return own


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Let the application remove ``path``, which exists, when its driver ends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)


#: Spark's setting to delete the shuffle files of a query when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go when the write ends.

    Spark otherwise keeps them until the driver happens to collect its garbage, so a chain of tables
    would hold the shuffles of all its steps at once. What is written is read from the table later.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts the lineage and survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder, for what several branches of a query read."""
    path = f"{shared_folder(df.sparkSession)}/stored/{uuid.uuid4().hex}"
    with shuffles_released(df.sparkSession):
        df.write.parquet(path)
    delete_at_end(df.sparkSession, path)
    return df.sparkSession.read.parquet(path)


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join where NULL keys match each other; the left spelling of the keys is kept."""
    renamed = right.select(
        *[F.col(k).alias(f"__{k}") if k in keys else F.col(k) for k in right.columns]
    )
    cond = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    joined = left.join(renamed, cond, how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how in ("full", "right"):
        # a key may be NULL on a matched row too, so coalesce is right for every row
        joined = joined.withColumns({k: F.coalesce(F.col(k), F.col(f"__{k}")) for k in keys})
    return joined.drop(*[f"__{k}" for k in keys])
