"""Writers of FASTQ, FASTA and tab-separated files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.schemas import HIT_COLUMNS


def _write_lines(
    df: DataFrame, line: Column, path: str, partition_by: Sequence[str], compression: str
) -> None:
    lines = df.select(*partition_by, line.alias("line"))
    if partition_by:
        # Else every task writes a file for every value it meets.
        lines = lines.hint("rebalance", *partition_by)
    lines.write.partitionBy(*partition_by).text(path, compression=compression)


def partition_value(file: Column, name: str) -> Column:
    """Value of a partition folder in a file's path; the empty value has a name of its own."""
    folder = F.regexp_extract(file, name + "=([^/]+)", 1)
    plain = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
    return F.when(folder == "__HIVE_DEFAULT_PARTITION__", "").otherwise(plain)


def write_fastq(
    records: DataFrame, path: str, partition_by: Sequence[str] = (), compression: str = "none"
) -> None:
    """Four lines per record."""
    line = F.concat_ws("\n", "header", "sequence", "line3", "quality")
    _write_lines(records, line, path, partition_by, compression)


def write_fasta(
    records: DataFrame, path: str, partition_by: Sequence[str] = (), compression: str = "none"
) -> None:
    """A '>' header line and one sequence line per record."""
    line = F.concat(F.lit(">"), F.concat_ws("\n", "header", "sequence"))
    _write_lines(records, line, path, partition_by, compression)


def write_hits(hits: DataFrame, path: str) -> None:
    """The aligner's twelve columns, without a header."""
    hits.select(*[name for name, _ in HIT_COLUMNS]).write.csv(path, sep="\t")


def write_hit_list(hits: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Hits with their functions '|'-joined in a 13th column."""
    joined = F.concat_ws("|", "functions").alias("functions")
    rows = hits.select(*partition_by, *[name for name, _ in HIT_COLUMNS], joined)
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    rows.write.partitionBy(*partition_by).csv(path, sep="\t")


def write_matrix(table: DataFrame, path: str) -> None:
    """A report table as tab-separated text with a header."""
    table.write.csv(path, sep="\t", header=True)


def write_annotated(annotated: DataFrame, path: str) -> None:
    """Annotated queries as nested JSON, one object per line."""
    annotated.write.json(path)
