"""A table that grows by numbered batches, each of them visible whole or not at all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class BatchTable:
    """Batches are written under a staging name and renamed when complete, so a reader never sees half of one.

    A number that is there already is not written again: a job or a stream that repeats a batch after a
    loss changes nothing. A batch whose staging was left behind is written anew.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _fs(self, name: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def append(self, number: int, rows: DataFrame) -> bool:
        """Add batch ``number``; false if it was there."""
        at, fs = self._fs(f"batch={number}")
        if fs.exists(at):
            return False
        staging, _ = self._fs(f"_staging-{number}")
        rows.write.mode("overwrite").parquet(staging.toString())
        if not fs.rename(staging, at):
            raise OSError(f"batch {number} could not be committed")
        return True

    def read(self, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/batch=*")
