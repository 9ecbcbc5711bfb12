"""Contigs, read alignments and genes: coverage, RPKM and shares of genes in their contigs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions.ids import parse_gene_id
from readloom.functions.scores import relative_abundance
from readloom.params import GOOD
from readloom.session import broadcast_if_small

CONTIG = ["function", "contig_id"]
ALL_SAMPLES = "All samples"


def long_contigs(contigs: DataFrame, min_length: int) -> DataFrame:
    return contigs.where(F.length("sequence") >= min_length)


def align_contigs(
    alignments: DataFrame, contigs: DataFrame, reads: DataFrame
) -> DataFrame:
    """Alignment rows x known contigs x the sample of each read, summed per contig and sample.

    Sums are compared with the known contigs, not alignments, which then move to their reads only.
    """
    known = contigs.select(*CONTIG)
    return (
        alignments.join(reads, ["function", "read_id"])
        .groupBy(*CONTIG, "sample_id")
        .agg(F.count("*").alias("read_count"), F.sum("aligned_length").alias("segment_length"))
        .join(known, CONTIG, "left_semi")
    )


def contig_lengths(contigs: DataFrame) -> DataFrame:
    return contigs.select(*CONTIG, F.length("sequence").alias("length"))


def add_total_series(contig_samples: DataFrame) -> DataFrame:
    """The per-sample rows and one 'All samples' row per contig."""
    total = contig_samples.groupBy(*CONTIG).agg(
        F.sum("read_count").alias("read_count"),
        F.sum("segment_length").alias("segment_length"),
    ).withColumn("sample_id", F.lit(ALL_SAMPLES))
    return contig_samples.unionByName(total)


def contig_coverage(contigs: DataFrame, contig_samples: DataFrame) -> DataFrame:
    """Coverage per contig and sample and over all samples; a contig without reads has 0."""
    lengths = contig_lengths(contigs)
    covered = lengths.join(add_total_series(contig_samples), CONTIG).select(
        *CONTIG, "sample_id", "length", "read_count",
        (F.col("segment_length") / F.col("length")).alias("coverage"),
    )
    bare = lengths.join(contig_samples.select(*CONTIG).distinct(), CONTIG, "left_anti").select(
        *CONTIG, F.lit(ALL_SAMPLES).alias("sample_id"), "length",
        F.lit(0).cast("bigint").alias("read_count"), F.lit(0.0).alias("coverage"),
    )
    return covered.unionByName(bare)


def total_coverage(contigs: DataFrame, contig_samples: DataFrame) -> DataFrame:
    """One row per contig over all samples."""
    coverage = contig_coverage(contigs, contig_samples)
    return coverage.where(F.col("sample_id") == ALL_SAMPLES).drop("sample_id")


def average_coverage(contigs: DataFrame, contig_samples: DataFrame) -> DataFrame:
    """Unweighted mean coverage of all contigs, per sample and over all samples."""
    count = contigs.agg(F.count("*")).scalar()
    return (
        contig_coverage(contigs, contig_samples)
        .groupBy("sample_id").agg(F.sum("coverage").alias("coverage"))
        .select("sample_id", (F.col("coverage") / count).alias("avg_coverage"))
    )


def rpkm(read_count: Column, length: Column, library_reads: Column) -> Column:
    return read_count * 1e9 / length / library_reads


def library_totals(samples: DataFrame, both_ends: bool) -> DataFrame:
    """Reads each series is normalised by: forward reads per sample, and the project's total."""
    reads = F.col("fwd_reads") + F.col("rev_reads") if both_ends else F.col("fwd_reads")
    total = samples.agg(F.sum(reads).alias("library_reads")).select(
        F.lit(ALL_SAMPLES).alias("sample_id"), "library_reads"
    )
    return samples.select("sample_id", F.col("fwd_reads").alias("library_reads")).unionByName(total)


def contig_rpkm(
    contigs: DataFrame, contig_samples: DataFrame, samples: DataFrame, both_ends: bool = False
) -> DataFrame:
    """RPKM, RPM, coverage and reads of each contig, per sample and over all samples."""
    libraries = broadcast_if_small(library_totals(samples, both_ends), samples)
    return contig_coverage(contigs, contig_samples).join(libraries, "sample_id").select(
        *CONTIG, "sample_id", "length", "read_count", "coverage",
        rpkm(F.col("read_count"), F.col("length"), F.col("library_reads")).alias("rpkm"),
        (F.col("read_count") * 1e6 / F.col("library_reads")).alias("rpm"),
    )


def place_genes(genes: DataFrame) -> DataFrame:
    """Genes with the assembly function and contig their id names."""
    return genes.withColumn("place", parse_gene_id(F.col("gene_id"))).select(
        "place.function", "place.contig_id", "place.gene_number",
        *[c for c in genes.columns],
    )


def gene_abundance(
    genes: DataFrame, contigs: DataFrame, contig_samples: DataFrame
) -> DataFrame:
    """Coverage of each gene's contig relative to the mean of the assembly."""
    average = average_coverage(contigs, contig_samples).where(
        F.col("sample_id") == ALL_SAMPLES
    ).select("avg_coverage")
    coverage = total_coverage(contigs, contig_samples).select(*CONTIG, "coverage")
    abundance = relative_abundance(F.col("coverage"), average.scalar())
    return place_genes(genes).join(coverage, CONTIG).select(
        "gene_id", abundance.alias("abundance")
    )


def good_genes(annotated: DataFrame, genes: DataFrame) -> DataFrame:
    """Good genes with their place, sequence and annotation."""
    found = annotated.where(F.col("status") == GOOD)
    return place_genes(genes).join(found, "gene_id")


def gene_share(
    annotated: DataFrame, genes: DataFrame, contigs: DataFrame, contig_samples: DataFrame,
    samples: DataFrame,
) -> DataFrame:
    """Reads and RPKM of the contig apportioned to each good gene by 3 x protein length.

    One row per (gene, series, hit); the hit gives identity and completeness.
    """
    series = contig_rpkm(contigs, contig_samples, samples)
    genes_on_contigs = good_genes(annotated, genes).withColumnRenamed("functions", "scores").select(
        *CONTIG, "gene_id", "taxonomy", "scores",
        F.length("protein_sequence").alias("protein_length"),
        F.posexplode("hits").alias("hit_no", "hit"),
    )
    nucleotides = F.col("protein_length") * 3 / F.col("length")
    return genes_on_contigs.join(series, CONTIG).select(
        *CONTIG, "gene_id", "taxonomy", "scores", "sample_id", "hit_no", "protein_length",
        F.col("hit.functions").alias("hit_functions"),
        F.col("hit.identity").alias("identity"),
        (F.col("protein_length") * 100 / F.col("hit.s_len")).alias("completeness"),
        "coverage",
        (F.col("read_count") * nucleotides).alias("count"),
        (F.col("rpkm") * nucleotides).alias("rpkm"),
    )


def gene_function_scores(shares: DataFrame) -> DataFrame:
    """Taxon x function scores of genes over all samples; every hit of a gene adds once."""
    return (
        shares.where(F.col("sample_id") == ALL_SAMPLES)
        .withColumn("function", F.explode("hit_functions"))
        .groupBy("taxonomy", "function")
        .agg(
            F.sum("rpkm").alias("rpkm"), F.sum("count").alias("count"),
            F.count("*").alias("hit_count"), F.sum("identity").alias("identity"),
        )
    )


def gene_sample_rows(shares: DataFrame) -> DataFrame:
    """(function, gene, series): the first hit that carries one of the gene's functions."""
    matching = shares.withColumn(
        "function",
        F.explode(F.filter("hit_functions", lambda f: F.map_contains_key("scores", f))),
    )
    fields = ["identity", "completeness", "coverage", "count", "rpkm", "protein_length"]
    first = matching.groupBy("function", "gene_id", "taxonomy", "sample_id").agg(
        F.min(F.struct("hit_no", *fields)).alias("first")
    )
    return first.select("function", "gene_id", "taxonomy", "sample_id",
                        *[f"first.{f}" for f in fields])


def gene_sample_scores(shares: DataFrame) -> DataFrame:
    """Function x taxon x series scores of genes, 'All samples' included."""
    return gene_sample_rows(shares).groupBy("function", "taxonomy", "sample_id").agg(
        F.sum("rpkm").alias("rpkm"), F.sum("count").alias("count"),
        F.count("*").alias("hit_count"), F.sum("identity").alias("identity"),
    )


def read_balance(
    reads: DataFrame, contig_samples: DataFrame, paired: bool
) -> DataFrame:
    """Per assembly function: exported, assembled and unassembled reads.

    A paired export writes both ends of every read.
    """
    ends = 2 if paired else 1
    exported = reads.groupBy("function").agg((F.count("*") * ends).alias("all_reads"))
    assembled = contig_samples.groupBy("function").agg(F.sum("read_count").alias("assembled"))
    used = F.coalesce("assembled", F.lit(0).cast("bigint"))
    return exported.join(assembled, "function", "left").select(
        "function", "all_reads", used.alias("assembled_reads"),
        (F.col("all_reads") - used).alias("unassembled_reads"),
    )


def reads_per_sample(reads: DataFrame, paired: bool) -> DataFrame:
    ends = 2 if paired else 1
    return reads.groupBy("function", "sample_id").agg((F.count("*") * ends).alias("reads"))
