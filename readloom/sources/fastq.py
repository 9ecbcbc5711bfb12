"""FASTQ reader as a Spark data source, and one on Spark's text source for other stores.

Records are four lines, and a quality line may start with '@' like a header does, so no separator
splits them. Plain files are cut into byte ranges: a task finds the first record that starts in its
range and reads on until a record starts beyond it. Gzip files are one task each.

Paths that only Spark's file systems open are read as text pieces between line starts with '@': a piece
is a record, or a record without its quality line and the quality line that follows it. Where a split of
the file comes between the two, they are brought together by the order of splits.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.window import Window

_SCHEMA = "file string, header string, sequence string, line3 string, quality string"
_FIELDS = ["file", "header", "sequence", "line3", "quality"]
_BATCH_BYTES = 8 << 20
_DEFAULT_SPLIT_BYTES = 128 << 20


@dataclass
class FastqRange(InputPartition):
    """Records that start in [start, end) of a file; no end for compressed files."""

    path: str
    start: int
    end: int | None


class FastqSource(DataSource):
    """Options: ``paths`` (JSON list of files or folders; or one ``path``) and ``splitbytes``."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> "FastqReader":
        return FastqReader(self.options)


class FastqReader(DataSourceReader):
    def __init__(self, options):
        self.paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
        self.split_bytes = int(options.get("splitbytes", _DEFAULT_SPLIT_BYTES))

    def partitions(self) -> list[FastqRange]:
        ranges = []
        for path in self.paths:
            filesystem, location = _opened(path)
            info = filesystem.get_file_info(location)
            if info.type == fs.FileType.NotFound:
                raise FileNotFoundError(path)
            files = [info] if info.is_file else [
                f for f in filesystem.get_file_info(fs.FileSelector(location, recursive=True))
                if f.is_file and not f.base_name.startswith(("_", "."))
            ]
            prefix = path[: len(path) - len(location)] if path.endswith(location) else ""
            for f in files:
                if f.path.endswith(".gz"):
                    ranges.append(FastqRange(prefix + f.path, 0, None))
                else:
                    for start in range(0, f.size, self.split_bytes):
                        end = min(start + self.split_bytes, f.size)
                        ranges.append(FastqRange(prefix + f.path, start, end))
        return ranges

    def read(self, partition: FastqRange | None) -> Iterator[pa.RecordBatch]:
        if partition is None:
            # What Spark hands over for a folder without files.
            return
        filesystem, location = _opened(partition.path)
        if partition.end is None:
            raw = filesystem.open_input_stream(location, compression="gzip")
        else:
            raw = filesystem.open_input_file(location)
        with io.BufferedReader(raw, 1 << 20) as handle:
            rows: list[tuple[str, ...]] = []
            size = 0
            for record in _records(handle, partition.start, partition.end):
                rows.append((partition.path, *record))
                size += sum(map(len, record))
                if size >= _BATCH_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)


# Schemes whose files tasks open themselves; Spark's names for a store beside its own.
_OWN_SCHEMES = {"file", "hdfs", "s3", "gs", "gcs", "abfs", "abfss"}
_SAME_STORE = {"s3a": "s3", "s3n": "s3"}


def _scheme(path: str) -> str:
    return path.split(":/", 1)[0].lower() if ":/" in path else ""


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    scheme = _scheme(path)
    if scheme in _SAME_STORE:
        path = _SAME_STORE[scheme] + path[len(scheme):]
    return fs.FileSystem.from_uri(path)


def _batch(rows: list[tuple[str, ...]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, pa.string()) for column in zip(*rows)], _FIELDS
    )


def _records(handle, start: int, end: int | None) -> Iterator[tuple[str, ...]]:
    """Records that start in [start, end). Lines carry the offset they start at."""
    position = 0
    if start > 0:
        # Finish the line before the range, so that a line starting at ``start`` is seen whole.
        handle.seek(start - 1)
        position = start - 1 + len(handle.readline())
    window: list[tuple[int, bytes]] = []

    def fill(n: int) -> bool:
        nonlocal position
        while len(window) < n:
            line = handle.readline()
            if not line:
                return False
            window.append((position, line))
            position += len(line)
        return True

    if start > 0:
        # A header is followed two lines on by the '+' line; a quality line is followed two
        # lines on by a sequence, which never starts with '+'.
        while True:
            if not fill(3):
                return
            if window[0][1][:1] == b"@" and window[2][1][:1] == b"+":
                break
            window.pop(0)
    while fill(1) and (end is None or window[0][0] < end):
        if not window[0][1].strip():
            window.pop(0)
            continue
        whole = fill(4)
        lines = [line.rstrip(b"\r\n").decode("utf-8") for _, line in window]
        if not whole or lines[0][:1] != "@" or lines[2][:1] != "+" or len(lines[1]) != len(lines[3]):
            raise ValueError(f"no whole FASTQ record at byte {window[0][0]}: {lines[0][:80]!r}")
        yield tuple(lines)
        window.clear()


def read_fastq(
    spark: SparkSession, path: str | list[str], split_bytes: int = _DEFAULT_SPLIT_BYTES
) -> DataFrame:
    """All records of the given files or folders.

    Paths of stores that are not known here go through Spark's text source, which reads the files a second
    time for the few records that lie across two splits; ``split_bytes`` does not apply to them.
    """
    paths = [path] if isinstance(path, str) else list(path)
    known = {"", *_OWN_SCHEMES, *_SAME_STORE}
    if any(_scheme(p) not in known for p in paths):
        return read_fastq_as_text(spark, paths)
    spark.dataSource.register(FastqSource)
    return spark.read.format("fastq").option("splitbytes", split_bytes).option(
        "paths", json.dumps(paths)).load()


# Kinds of pieces: whole records, quality lines whose record began in an earlier split, records whose
# quality line comes in a later one. Within a split the second kind comes first, the third last.
_RECORD, _QUALITY, _OPEN = 0, 1, 2
_PIECES = "file string, block long, kind int, header string, sequence string, line3 string, quality string"


def _torn(header: str) -> ValueError:
    return ValueError(f"no whole FASTQ record: {header[:80]!r}")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (file, block, text) in the order of a task to records and what lies across splits."""
    place: tuple[str, int] | None = None
    open_: list[str] | None = None
    out: list[tuple] = []

    def row(kind: int, lines: list[str]) -> tuple:
        return (*place, kind, *lines)

    def table() -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int32(), *[pa.string()] * 4]
        names = ["file", "block", "kind", "header", "sequence", "line3", "quality"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    for batch in batches:
        for file, block, text in zip(*[c.to_pylist() for c in batch.columns]):
            at_start = place != (file, block)
            if at_start and open_ is not None:
                out.append(row(_OPEN, ["@" + open_[0], *open_[1:], None]))
                open_ = None
            place = (file, block)
            first = at_start and block == 0
            if first:
                # What precedes the first header of a file is blank, or its own mark.
                text = text.lstrip("\r\n")
                if not text:
                    continue
                if text[0] != "@":
                    raise _torn(text)
                text = text[1:]
            lines = text.replace("\r", "").split("\n")
            while len(lines) > 4 and not lines[-1].strip():
                lines.pop()
            if open_ is not None or (at_start and not first and not any(x.strip() for x in lines[1:])):
                # The quality line that '@' began, with blank lines behind it.
                if any(x.strip() for x in lines[1:]):
                    raise _torn(open_[0])
                quality = "@" + lines[0]
                if open_ is None:
                    out.append(row(_QUALITY, [None, None, None, quality]))
                else:
                    if len(quality) != len(open_[1]):
                        raise _torn(open_[0])
                    out.append(row(_RECORD, ["@" + open_[0], *open_[1:], quality]))
                    open_ = None
            elif len(lines) == 4 and lines[2][:1] == "+" and len(lines[1]) == len(lines[3]):
                out.append(row(_RECORD, ["@" + lines[0], *lines[1:]]))
            elif len(lines) == 3 and lines[2][:1] == "+" and lines[1]:
                open_ = lines
            else:
                raise _torn(lines[0])
            if len(out) >= 1 << 14:
                yield table()
                out.clear()
    if open_ is not None:
        out.append(row(_OPEN, ["@" + open_[0], *open_[1:], None]))
    if out:
        yield table()


def read_fastq_as_text(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Records of any path that Spark's text source reads, plain or compressed."""
    text = spark.read.text(paths, lineSep="\n@").select(
        F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("file"),
        F.col("_metadata.file_block_start").alias("block"), "value")
    pieces = text.mapInArrow(_pieces, _PIECES)
    across = Window.partitionBy("file").orderBy("block", "kind")
    parts = pieces.where(F.col("kind") != _RECORD)
    joined = (
        parts.withColumn("next_kind", F.lead("kind").over(across))
        .withColumn("last_kind", F.lag("kind").over(across))
        .withColumn("next_quality", F.lead("quality").over(across))
    )
    fits = F.when(F.col("kind") == _OPEN, (F.col("next_kind") == _QUALITY)
                  & (F.length("next_quality") == F.length("sequence"))).otherwise(
        F.col("last_kind") == _OPEN)
    checked = F.when(F.coalesce(fits, F.lit(False)), F.col("next_quality")).otherwise(
        F.raise_error(F.concat(F.lit("no whole FASTQ record: "), F.coalesce("header", "quality"))).cast("string"))
    whole = joined.withColumn("checked", checked).where(
        (F.col("kind") == _OPEN) | F.col("checked").isNull())
    across_splits = whole.where(F.col("kind") == _OPEN).select(
        "file", "header", "sequence", "line3", F.col("checked").alias("quality"))
    return pieces.where(F.col("kind") == _RECORD).select(
        "file", "header", "sequence", "line3", "quality").unionByName(across_splits)
