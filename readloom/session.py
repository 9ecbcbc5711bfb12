"""Session settings, the shared folder for stage tables, and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A dimension is broadcast only when a count proves it has at most this many rows.
BROADCAST_MAX_ROWS = 100_000

_local_folders: dict[str, str] = {}
_app_folders: set[str] = set()
_small_plans: dict[tuple[str, int, int], bool] = {}


def build_session(app_name: str, cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local session may fall back to its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="readloom-")
    return _local_folders[app]


def app_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder; it is removed when the driver's JVM ends."""
    root = f"{shared_folder(spark)}/readloom/{spark.sparkContext.applicationId}"
    if root not in _app_folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _app_folders.add(root)
    return root


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """A bounded count: it never looks at more than ``max_rows`` + 1 rows.

    The same plan is counted once per application.
    """
    key = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), max_rows)
    if key not in _small_plans:
        _small_plans[key] = df.limit(max_rows + 1).count() <= max_rows
    return _small_plans[key]


def broadcast_if_small(df: DataFrame, bound: DataFrame | None = None) -> DataFrame:
    """Hint a broadcast when a bounded count proves the table small; else leave it to a shuffle.

    ``bound`` names a table that is cheaper to count and has at least as many rows.
    """
    return F.broadcast(df) if is_small(df if bound is None else bound) else df


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage of a table: write it to the shared folder and read it back."""
    path = f"{app_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, path: str, column: str) -> DataFrame:
    """The table written in sorted buckets of a column, so that a join on it moves the other side only.

    The catalog entry that a bucketed write needs goes at once; the files are read by their path.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"bucketed_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, column).write.bucketBy(buckets, column).sortBy(column)
     .format("parquet").option("path", path).saveAsTable(name))
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


@contextmanager
def sorted_groups(spark: SparkSession) -> Iterator[None]:
    """Jobs within this block collect lists from sorted rows.

    Spark hashes the first 128 groups of a task else, then sorts what is left once an aggregate, though the
    rows of a classification are sorted by query and region already.
    """
    setting = "spark.sql.execution.useObjectHashAggregateExec"
    old = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        yield
    finally:
        spark.conf.set(setting, old)


class Stages:
    """Named Parquet tables in the shared folder; each is written once and then read back.

    A written table cuts the lineage, survives lost executors and is shared by every report
    that starts from it.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{app_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
        self._tables: dict[str, DataFrame] = {}
        self._files: set[str] = set()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def fresh_path(self, name: str) -> str:
        """A folder no earlier write has used, for sinks that are run more than once."""
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def table(
        self,
        name: str,
        build: Callable[[], DataFrame],
        partition_by: tuple[str, ...] = (),
    ) -> DataFrame:
        if name not in self._tables:
            df = build()
            if partition_by:
                # Else every task writes a file for every value it meets.
                df = df.hint("rebalance", *partition_by)
            df.write.mode("overwrite").partitionBy(*partition_by).parquet(self.path(name))
            self._tables[name] = self.spark.read.parquet(self.path(name))
        return self._tables[name]

    def files(self, name: str, write: Callable[[str], None]) -> str:
        """A folder of text files, written once."""
        path = self.path(f"files/{name}")
        if path not in self._files:
            write(path)
            self._files.add(path)
        return path

    def dimension(
        self, name: str, build: Callable[[], DataFrame], key: str | None = None
    ) -> DataFrame:
        """A staged table, hinted for broadcast when its row count is proven small.

        A larger one that is looked up by ``key`` is kept in buckets of it.
        """
        table = self.table(name, build)
        if is_small(table):
            return F.broadcast(table)
        if key is None:
            return table
        by_key = f"{name}-by-{key}"
        if by_key not in self._tables:
            self._tables[by_key] = bucketed(table, self.path(by_key), key)
        return self._tables[by_key]
