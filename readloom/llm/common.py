"""Shared pieces: table access, let-bindings for column expressions, Arrow batch bounds."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.session import app_folder

def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def words(text: Column) -> Column:
    """The non-empty pieces between separators; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[ \t-\r]+"), "")


def wrapped(docs: DataFrame) -> Column:
    """All columns as one struct, so that no name of theirs can clash with a helper column."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def small_batches(spark: SparkSession, rows: int = 1 << 16, bytes_: int = 4 << 20) -> None:
    """Bound what one Arrow batch holds, so that long texts do not meet in one Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(bytes_))


class Scratch:
    """Stage tables of one job in the shared folder: lineage ends there, lost executors do not hurt."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{app_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
        self.count = 0

    def write(self, df: DataFrame, large: bool = False) -> DataFrame:
        """``large``: what the table took in shuffle files goes at once, not when the driver's heap fills."""
        self.count += 1
        path = f"{self.root}/{self.count:03d}"
        df.write.option("compression", "zstd").parquet(path)
        if large:
            self.free()
        return self.spark.read.schema(df.schema).parquet(path)

    def free(self) -> None:
        """Shuffle files stay until the driver drops what refers to them; a stage table needs none."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, df: DataFrame) -> None:
        """Remove a stage table of this job that no later step reads."""
        files = [f for f in df.inputFiles() if "/readloom/" in f]
        if files:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
