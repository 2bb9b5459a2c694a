"""Tables written once per application to the shared folder and read back as Parquet.

The sale grain, the fact, the dimensions and the marts are tables in their own right: many queries
read them, and a written table survives lost executors and gives the optimiser real sizes.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import md5

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cadastria.session import delete_at_end, shared_folder, shuffles_released


class TableStore:
    def __init__(self, spark: SparkSession, scope: str):
        app = spark.sparkContext.applicationId
        self.spark = spark
        self.root = f"{shared_folder(spark)}/tables/{app}/{md5(scope.encode()).hexdigest()[:12]}"
        self._written: set[str] = set()
        self._watched: dict[str, list[Column]] = {}
        self._seen: dict[str, list[int]] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def watch(self, name: str, marks: list[Column]) -> None:
        """Count the rows that each of ``marks`` marks while the table is written, if it isn't yet."""
        if marks and name not in self._written:
            self._watched[name] = marks

    def seen(self, name: str, marks: int) -> list[int] | None:
        """What the write of a table counted for so many marks, or None."""
        found = self._seen.get(name)
        return found if found is not None and len(found) == marks else None

    def table(self, name: str, build: Callable[[], DataFrame],
              partition_by: list[str] | None = None) -> DataFrame:
        if name not in self._written:
            df, marks = build(), self._watched.get(name, [])
            counted = Observation()
            if marks:
                df = df.observe(counted, *[F.count_if(m).alias(f"_{i}") for i, m in enumerate(marks)])
            writer = df.write.mode("overwrite")
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            with shuffles_released(self.spark):
                writer.parquet(self.path(name))
            if marks:
                self._seen[name] = [counted.get[f"_{i}"] for i in range(len(marks))]
            delete_at_end(self.spark, self.path(name))
            self._written.add(name)
        return self.spark.read.parquet(self.path(name))
