"""Coverage of contigs and the abundance it gives the proteins on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions.ids import contig_of_protein
from readloom.functions.scores import relative_abundance


def average_coverage(coverage: DataFrame) -> DataFrame:
    """Unweighted mean coverage per sample."""
    return coverage.groupBy("sample_id").agg(F.avg("coverage").alias("average"))


def protein_coverage(
    proteins: DataFrame, coverage: DataFrame, strip_prefix: bool = True
) -> DataFrame:
    """Coverage of the contig a protein lies on; 1 where none is on file."""
    contig: Column = contig_of_protein(F.col("read_id"), strip_prefix)
    return (
        proteins.withColumn("contig_id", contig)
        .join(coverage, ["sample_id", "contig_id"], "left")
        .withColumn("coverage", F.coalesce("coverage", F.lit(1.0)))
    )


def protein_abundance(
    proteins: DataFrame, coverage: DataFrame, strip_prefix: bool = True
) -> DataFrame:
    """Coverage of each protein relative to its sample; a sample without a file averages 1."""
    average = F.coalesce("average", F.lit(1.0))
    covered = protein_coverage(proteins, coverage, strip_prefix)
    return covered.join(average_coverage(coverage), "sample_id", "left").select(
        *proteins.columns, relative_abundance(F.col("coverage"), average).alias("abundance")
    )
