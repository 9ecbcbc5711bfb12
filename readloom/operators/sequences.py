"""Reads joined to their records and to those of their mates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions.ids import parse_read_id, region_key
from readloom.functions.sequences import region_slice
from readloom.params import END1, END2, GOOD
from readloom.session import is_small

RECORD = ["header", "sequence", "line3", "quality"]


def with_read_ids(records: DataFrame) -> DataFrame:
    """FASTQ records with the read id and end their header names."""
    parsed = parse_read_id(F.col("header"))
    return records.withColumn("parsed", parsed).select(
        *records.columns, F.col("parsed.read_id").alias("read_id"),
        F.col("parsed.end").alias("read_end"),
    )


def candidate_records(
    records: DataFrame, candidates: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Records of candidate reads only."""
    return records.join(candidates.select(*keys), list(keys), "left_semi")


def with_mates(
    candidates: DataFrame, records: DataFrame, pair_keys: Sequence[str]
) -> DataFrame:
    """Every candidate read with its own record and that of its mate, where they exist.

    Records are read once and gathered per pair; each candidate takes both ends from there. Those of
    other pairs are left out before if the candidates are few enough to be sent to them. Else records
    move by their pair to find out, where the join leaves them out as well, and candidates move once.
    """
    if is_small(candidates):
        wanted = F.broadcast(candidates.select(*pair_keys).distinct())
        records = records.join(wanted, list(pair_keys), "left_semi")
    one = lambda e: F.min(F.when(F.col("end") == e, F.struct(*RECORD)))
    pairs = records.groupBy(*pair_keys).agg(one(END1).alias("first"), one(END2).alias("second"))
    first = F.col("end") == END1
    return (
        candidates.join(pairs, list(pair_keys), "left")
        .withColumn("own", F.when(first, F.col("first")).otherwise(F.col("second")))
        .withColumn("mate", F.when(first, F.col("second")).otherwise(F.col("first")))
        .drop("first", "second")
    )


def hit_regions(with_records: DataFrame) -> DataFrame:
    """One record per hit region: region key, sequence slice and, for FASTQ, its quality."""
    h_start, h_end = F.col("hit.q_start"), F.col("hit.q_end")
    return with_records.withColumn("hit", F.explode("hits")).select(
        "sample_id", "end", "read_id",
        region_key(F.col("read_id"), h_start, h_end).alias("header"),
        region_slice(F.col("own.sequence"), h_start, h_end).alias("sequence"),
        F.col("own.line3").alias("line3"),
        region_slice(F.col("own.quality"), h_start, h_end).alias("quality"),
    ).where(F.col("sequence").isNotNull())


def good_records(with_records: DataFrame) -> DataFrame:
    """Own records of good reads."""
    return with_records.where(F.col("status") == GOOD).select(
        "sample_id", "end", "read_id", "own.*"
    ).where(F.col("header").isNotNull())


def mate_records(with_records: DataFrame, only_good: bool) -> DataFrame:
    """Mate records, of good reads only or of every candidate."""
    rows = with_records.where(F.col("status") == GOOD) if only_good else with_records
    return rows.select("sample_id", "end", "read_id", "mate.*").where(
        F.col("header").isNotNull()
    )


def assembly_export(with_records: DataFrame, coassembly: bool) -> DataFrame:
    """Records of good reads per function, or in one pool; each read once per function.

    A pair met in several samples or at both ends is exported at its first place in the order of
    samples and ends, together with its mate.
    """
    function = (
        F.array(F.lit("Coassembly")) if coassembly else F.map_keys("functions")
    )
    rows = with_records.where((F.col("status") == GOOD) & F.col("own").isNotNull()).select(
        F.explode(function).alias("function"), "sample_id", "end", "read_id", "own", "mate"
    )
    first = F.min(F.struct("sample_id", "end", "own", "mate")).alias("first")
    chosen = rows.groupBy("function", "read_id").agg(first).select(
        "function", "read_id", "first.*"
    )
    other = F.when(F.col("end") == END1, END2).otherwise(END1)
    ends = F.array(
        F.struct(F.col("end").alias("file_end"), F.col("own").alias("record")),
        F.struct(other.alias("file_end"), F.col("mate").alias("record")),
    )
    return chosen.select("function", "read_id", "sample_id", F.inline(ends)).where(
        F.col("record").isNotNull()
    ).select("function", "read_id", "sample_id", "file_end", "record.*")
