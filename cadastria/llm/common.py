"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastria.session import delete_at_end, shared_folder, shuffles_released

#: The characters that separate words.
WHITE = r"[\x20\x09-\x0D]"
NOT_WHITE = r"[^\x20\x09-\x0D]"
#: Bytes of text that a Python task holds at once, besides a single longer text.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{WHITE}+"), "")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, readable after lost executors.

    The application removes it when it ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    with shuffles_released(spark):
        df.write.parquet(path)
    delete_at_end(spark, path)
    return spark.read.parquet(path)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` again, in batches of about ``most`` bytes of ``column``; none is split."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(size)
        if len(sizes) > start:
            yield batch.slice(start)
