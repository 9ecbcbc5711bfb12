"""Library statistics and normalisation factors of samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def library_stats(reads: DataFrame, keys: list[str]) -> DataFrame:
    """Reads, bases and average length per library."""
    return reads.groupBy(*keys).agg(
        F.count("*").alias("reads"), F.sum(F.length("sequence")).alias("bases")
    ).withColumn("avg_length", F.col("bases") / F.col("reads"))


def average_read_lengths(samples: DataFrame) -> DataFrame:
    """One row per (sample, end); an empty library has length 0."""
    def mean(bases: str, reads: str) -> Column:
        return F.when(F.col(reads) > 0, F.col(bases) / F.col(reads)).otherwise(0.0)

    ends = F.array(
        F.struct(F.lit("pe1").alias("end"), mean("fwd_bases", "fwd_reads").alias("read_length")),
        F.struct(F.lit("pe2").alias("end"), mean("rev_bases", "rev_reads").alias("read_length")),
    )
    return samples.select("sample_id", F.inline(ends))


def normalisation_factors(samples: DataFrame) -> DataFrame:
    """Per-million and per-genome factors; 0 where a factor cannot be had."""
    genome = F.col("genome_size")
    per_genome = (
        F.when(F.coalesce(genome, F.lit(0.0)) == 0, 0.0)
        .when(F.col("fwd_bases") > 0, genome / F.col("fwd_bases"))
        .when(F.col("rev_bases") > 0, genome / F.col("rev_bases"))
        .otherwise(F.raise_error(F.lit("a base count is needed to normalise by genome size")))
    )
    per_million = F.when(F.col("fwd_reads") > 0, F.lit(1e6) / F.col("fwd_reads")).otherwise(0.0)
    return samples.withColumn("per_million", per_million).withColumn("per_genome", per_genome)
