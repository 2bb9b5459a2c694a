"""Incremental landing: a stream of unseen files, and a refresh that reloads what the source has republished.

Both write a partition per file and overwrite the partitions of the files they load, so a repeated batch or a
republished file replaces its rows. Files that were landed before aren't opened again.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastria.session import checkpointed, shared_folder
from cadastria.sources import landing
from cadastria.sources.landing import stamped

# The columns of a listing of files; the content is never asked for.
LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def land_files(spark: SparkSession, paths: list[str], columns: list[str], target: str, required: list[str]) -> None:
    """Write the rows of ``paths`` to their partitions of ``target``, bound by each file's own header."""
    if paths:
        rows = landing.read_csv_by_name(spark, paths, columns, required=required)
        refresh_partitions(spark, stamped(rows), target)


def land_new_files(spark: SparkSession, folder: str, columns: list[str], target: str,
                   required: list[str] | None = None, files_per_batch: int = 1000) -> None:
    """Land the files of ``folder`` that no earlier run has; progress belongs to the folder and the target.

    The stream is one of names, dates and sizes: a batch opens its own files only, first for their headers and then for
    their rows. A file without the ``required`` columns (the first one, if none are named) fails its batch, and the next run
    tries it again. A batch is written once however often it is tried.
    """
    required = columns[:1] if required is None else required

    def land(batch: DataFrame, _: int) -> None:
        # at most files_per_batch names
        paths = [r["path"] for r in batch.select("path").collect()]
        land_files(batch.sparkSession, paths, columns, target, required)

    progress = md5(f"{folder}\n{target}".encode()).hexdigest()
    (
        spark.readStream.format("binaryFile").schema(LISTING).option("maxFilesPerTrigger", files_per_batch)
        .load(folder).select("path").writeStream.foreachBatch(land)
        .option("checkpointLocation", f"{shared_folder(spark)}/streams/{progress}")
        .trigger(availableNow=True).start().awaitTermination()
    )


def refresh_changed(spark: SparkSession, folder: str | list[str], columns: list[str], target: str,
                    stored: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Reload the files that are new or republished since ``stored``; returns the manifest to store."""
    remote = checkpointed(landing.manifest(spark, folder))
    # names of changed files only
    paths = [r["file"] for r in landing.changed_files(stored, remote).collect()]
    land_files(spark, paths, columns, target, required or [])
    return remote


def refresh(spark: SparkSession, folder: str | list[str], columns: list[str], target: str,
            required: list[str] | None = None) -> DataFrame:
    """The rows of all files that the source has now; ``target`` keeps them and the manifest of the last run.

    Files that are as they were aren't read from the source; files that are gone keep their partition and are left out. The manifest is
    stored last: a run that was cut short is made up for by the next one.
    """
    rows, known = f"{target}/rows", f"{target}/manifest"
    schema = "file string, last_modified string, content_length string, etag string, _loaded_at string"
    stored = spark.read.schema(schema).parquet(known) if exists(spark, known) else spark.createDataFrame([], schema)
    remote = refresh_changed(spark, folder, columns, rows, stored, required)
    stamped(remote).write.mode("overwrite").parquet(known)
    return landed(spark, columns, target)


def landed(spark: SparkSession, columns: list[str], target: str) -> DataFrame:
    """What ``refresh`` has landed of the files in its manifest."""
    names = spark.read.parquet(f"{target}/manifest").select(F.substring_index("file", "/", -1).alias("_source_file"))
    schema = ", ".join(f"`{c}` string" for c in [*columns, "_loaded_at", "_source_file"])
    if not exists(spark, f"{target}/rows"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{target}/rows").join(names, "_source_file", "left_semi").select(*columns, *landing.PROVENANCE)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def replace_files(landed: DataFrame, republished: DataFrame) -> DataFrame:
    """Rows of a republished file replace the rows landed from its earlier version."""
    names = republished.select("_source_file").distinct()
    return landed.join(names, "_source_file", "left_anti").unionByName(republished)


def refresh_partitions(spark: SparkSession, rows: DataFrame, target: str) -> None:
    """Overwrite only the file partitions present in ``rows``: reloading a file is idempotent."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "_source_file").parquet(target)
