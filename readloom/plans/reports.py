"""Report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions.sequences import region_slice, reverse_complement
from readloom.operators import assembly
from readloom.operators.catalogue import annotate
from readloom.operators.rollup import mean_identity, preorder_lines, tree_nodes
from readloom.operators.samples import normalisation_factors
from readloom.params import BAD, GOOD, RANKS, ROOT_TAXID, RunParams

VALUES = ["score", "count", "hit_count", "identity"]
_LINEAGE_COLUMNS = [f"level{i}" for i in range(1, len(RANKS))]


def fixed_decimals(column: str, digits: int) -> Column:
    """A number as text; halves are settled by the exact binary value."""
    return F.expr(f"format_number(`{column}`, '0.{'0' * digits}')").alias(column)


def dense_grid(
    functions: DataFrame, scores: DataFrame, sample_list: Sequence[str]
) -> DataFrame:
    """Every catalogue function x every sample, 0 where there is no score."""
    samples = F.array(*[F.lit(s) for s in sample_list])
    grid = functions.select(
        "function", "group", "name", F.explode(samples).alias("sample_id")
    )
    found = scores.select("function", "sample_id", "score")
    return grid.join(found, ["function", "sample_id"], "left").withColumn(
        "score", F.coalesce("score", F.lit(0.0))
    )


def pivoted(
    table: DataFrame, rows: Sequence[str], column: str, values: Sequence[str],
    cells: Sequence[Column], fill: float = 0.0,
) -> DataFrame:
    """Pivot over a known list of values, so that no extra job has to find them."""
    return table.groupBy(*rows).pivot(column, list(values)).agg(*cells).na.fill(fill)


def function_matrix(
    functions: DataFrame, scores: DataFrame, sample_list: Sequence[str]
) -> DataFrame:
    grid = dense_grid(functions, scores, sample_list).withColumnRenamed("name", "definition")
    return pivoted(grid, ["function", "definition"], "sample_id", sample_list, [F.sum("score")])


def category_sums(functions: DataFrame, scores: DataFrame) -> DataFrame:
    """Sum of the scores of each group's functions per sample."""
    groups = functions.select("function", "group")
    return scores.join(groups, "function").groupBy("group", "sample_id").agg(
        F.sum("score").alias("score")
    )


def category_matrix(
    functions: DataFrame, scores: DataFrame, sample_list: Sequence[str]
) -> DataFrame:
    """Every group of the catalogue, also those without a score."""
    groups = functions.select("group").distinct()
    sums = groups.join(category_sums(functions, scores), "group", "left")
    return pivoted(sums, ["group"], "sample_id", sample_list, [F.sum("score")])


def function_average(functions: DataFrame, scores: DataFrame) -> DataFrame:
    """Per taxon and sample: values summed over functions, the score per catalogue function."""
    catalogue = functions.agg(F.count("*")).scalar()
    sums = scores.groupBy("taxonomy", "sample_id").agg(*[F.sum(v).alias(v) for v in VALUES])
    return sums.withColumn("score", F.col("score") / catalogue)


def _lined(nodes: DataFrame, scope: Sequence[str]) -> DataFrame:
    return nodes.join(preorder_lines(nodes, scope), [*scope, "taxid"])


def taxon_function_table(
    scores: DataFrame, taxa: DataFrame, function_list: Sequence[str]
) -> DataFrame:
    """Per sample: taxon lines x (score, identity, count) of each function.

    A residual node is added where the read counts of the children fall short.
    """
    nodes = tree_nodes(scores, taxa, ["sample_id"], ["function"], VALUES, "count")
    cells = [F.sum("score").alias("score"), F.sum(mean_identity()).alias("identity"),
             F.sum("count").alias("count")]
    return pivoted(
        _lined(nodes, ["sample_id"]), ["sample_id", "line", "rank", "name"],
        "function", function_list, cells,
    )


def taxon_function_score_table(
    scores: DataFrame, taxa: DataFrame, function_list: Sequence[str]
) -> DataFrame:
    """Per sample: taxon lines x score of each function, residuals by score."""
    nodes = tree_nodes(scores, taxa, ["sample_id"], ["function"], ["score"], "score")
    return pivoted(
        _lined(nodes, ["sample_id"]), ["sample_id", "line", "rank", "name"],
        "function", function_list, [F.sum("score")],
    )


def taxon_sample_table(
    scores: DataFrame, functions: DataFrame, taxa: DataFrame, sample_list: Sequence[str]
) -> DataFrame:
    """Per function, and for their average: taxon lines x score of each sample."""
    average = function_average(functions, scores).withColumn("function", F.lit("Average"))
    sheets = scores.select("taxonomy", "function", "sample_id", "score").unionByName(
        average.select("taxonomy", "function", "sample_id", "score")
    )
    nodes = tree_nodes(sheets, taxa, ["function"], ["sample_id"], ["score"], "score")
    return pivoted(
        _lined(nodes, ["function"]), ["function", "line", "rank", "name"],
        "sample_id", sample_list, [F.sum("score")],
    )


def text_matrix(
    functions: DataFrame, scores: DataFrame, sample_list: Sequence[str]
) -> DataFrame:
    """Scored functions x samples as text with three decimals."""
    names = functions.select("function", F.col("name").alias("definition"))
    wide = pivoted(scores, ["function"], "sample_id", sample_list, [F.sum("score")])
    return wide.join(names, "function", "left").select(
        "function",
        *[fixed_decimals(s, 3) for s in sample_list],
        F.coalesce("definition", F.lit("")).alias("definition"),
    )


def statistics_table(
    functions: DataFrame, scores: DataFrame, sample_list: Sequence[str]
) -> DataFrame:
    """Category, function and one column per sample, ready for statistics tools."""
    groups = functions.select("function", F.col("group").alias("category"))
    wide = pivoted(scores, ["function"], "sample_id", sample_list, [F.sum("score")])
    return wide.join(groups, "function", "left").withColumn(
        "category", F.coalesce("category", F.lit(""))
    )


def statistics_taxonomy_table(
    scores: DataFrame, taxa: DataFrame, sample_list: Sequence[str]
) -> DataFrame:
    """Per function: leaf and residual taxa with a lineage of fixed width x samples."""
    nodes = tree_nodes(scores, taxa, ["function"], ["sample_id"], ["score"], "score")
    inner = nodes.where(F.col("parent").isNotNull()).select(
        "function", F.col("parent").alias("taxid")
    ).distinct()
    leaves = nodes.join(inner, ["function", "taxid"], "left_anti")
    names = taxa.select(
        F.col("taxid").alias("step"), F.col("name").alias("step_name")
    )
    # A path element is a taxon, a residual mark or an id the taxonomy lacks.
    ends = leaves.select("function", "taxid", "path", "name").distinct()
    steps = ends.select("function", "taxid", "name", F.posexplode("path").alias("pos", "step"))
    labelled = steps.join(names, "step", "left").withColumn(
        "label",
        F.when(F.col("step") == F.col("taxid"), F.col("name"))
        .otherwise(F.coalesce("step_name", F.col("step"))),
    ).where(F.col("step") != ROOT_TAXID)
    label = F.when(
        F.col("step") == F.concat(F.lit("~"), F.lit(ROOT_TAXID)), "unclassified"
    ).otherwise(F.col("label"))
    lineages = labelled.groupBy("function", "taxid").agg(
        F.array_sort(F.collect_list(F.struct("pos", label.alias("label")))).alias("steps")
    ).select(
        "function", "taxid", F.transform("steps", lambda s: s["label"]).alias("labels")
    )
    wide = pivoted(leaves, ["function", "taxid"], "sample_id", sample_list, [F.sum("score")])
    padded = wide.join(lineages, ["function", "taxid"], "left")
    return padded.select(
        "function",
        *[
            F.coalesce(F.get("labels", F.lit(i)), F.lit("unclassified")).alias(column)
            for i, column in enumerate(_LINEAGE_COLUMNS)
        ],
        *sample_list,
    )


def sample_metadata(samples: DataFrame) -> DataFrame:
    return samples.select("sample_id", "sample_name", "replicate")


def read_listing(annotated: DataFrame) -> DataFrame:
    """Every read with its status, functions and taxon, one row per numbered hit."""
    functions = F.array_join(F.array_sort(F.map_keys("functions")), ",")
    return annotated.select(
        "sample_id", "end", "read_id", "status", functions.alias("functions"),
        F.coalesce("taxonomy", F.lit("No taxonomy")).alias("taxonomy"),
        F.posexplode_outer("hits").alias("position", "hit"),
    ).select(
        "sample_id", "end", "read_id", "status", "functions", "taxonomy",
        (F.col("position") + 1).cast("bigint").alias("hit_number"),
        "hit.subject_id", "hit.identity", "hit.q_start", "hit.q_end", "hit.bitscore",
        F.array_join("hit.functions", "|").alias("hit_functions"),
    )


def protein_list(annotated: DataFrame, functions: DataFrame, taxa: DataFrame) -> DataFrame:
    """Good proteins with functions, descriptions, mean identity and taxon."""
    key = ["sample_id", "read_id"]
    good = annotated.where(F.col("status") == GOOD)
    identity = F.aggregate("hits", F.lit(0.0), lambda a, h: a + h["identity"]) / F.size("hits")
    listed = good.select(*key, F.explode(F.map_keys("functions")).alias("function"))
    names = functions.select("function", "name")
    described = listed.join(names, "function", "left").groupBy(*key).agg(
        F.array_join(F.array_sort(F.collect_list("function")), ",").alias("functions"),
        F.array_join(
            F.array_sort(F.collect_list(F.coalesce("name", F.lit("")))), "|"
        ).alias("descriptions"),
    )
    taxon = taxa.select(F.col("taxid").alias("taxonomy"), F.col("name").alias("taxon_name"))
    return (
        good.select(*key, "taxonomy", identity.alias("identity"))
        .join(described, key)
        .join(taxon, "taxonomy", "left")
        .withColumnRenamed("read_id", "protein_id")
    )


def mapped_protein_hits(annotated: DataFrame, taxa: DataFrame) -> DataFrame:
    """Proteins that were not rejected, one row per hit."""
    taxon = taxa.select(F.col("taxid").alias("taxonomy"), F.col("name").alias("taxon_name"))
    return (
        annotated.where(F.col("status") != BAD)
        .select("sample_id", "read_id", "taxonomy", F.explode("hits").alias("hit"))
        .join(taxon, "taxonomy", "left")
        .select("sample_id", "read_id", "taxon_name", "hit.*")
    )


def protein_lengths(annotated: DataFrame, proteins: DataFrame, taxa: DataFrame) -> DataFrame:
    """Length of each good protein relative to the reference protein of its first hit."""
    taxon = taxa.select(F.col("taxid").alias("taxonomy"), F.col("name").alias("taxon_name"))
    first = F.try_element_at("hits", F.lit(1))["s_len"]
    return (
        annotated.where(F.col("status") == GOOD)
        .join(proteins.select("sample_id", "read_id", "sequence"), ["sample_id", "read_id"])
        .join(taxon, "taxonomy", "left")
        .select(
            "sample_id", "read_id",
            F.array_join(F.array_sort(F.map_keys("functions")), ";").alias("functions"),
            (F.length("sequence") / first).alias("length_ratio"), "taxonomy", "taxon_name",
        )
    )


def sample_summary(
    samples: DataFrame, annotated: DataFrame, insert_sizes: DataFrame
) -> DataFrame:
    """Library sizes, factors, insert size and mapped reads of each sample.

    Mapped are all annotated reads, whatever their status.
    """
    mapped = annotated.groupBy("sample_id").agg(
        F.count_if(F.col("end") == "pe1").alias("mapped_pe1"),
        F.count_if(F.col("end") == "pe2").alias("mapped_pe2"),
    )
    factors = normalisation_factors(samples).drop("insert_size")
    return (
        factors.join(insert_sizes.select("sample_id", "insert_size"), "sample_id", "left")
        .join(mapped, "sample_id", "left")
        .select(
            "sample_id", "sample_name", "replicate", "fwd_reads", "fwd_bases", "rev_reads",
            "rev_bases", "per_million", "per_genome",
            (F.col("per_genome") * F.col("fwd_bases")).alias("genome_size"), "insert_size",
            F.coalesce("mapped_pe1", F.lit(0)).alias("mapped_pe1"),
            F.coalesce("mapped_pe2", F.lit(0)).alias("mapped_pe2"),
        )
    )


# Assembly ------------------------------------------------------------------------------------

def _contig_triplets(
    series: DataFrame, sample_list: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    cells = [F.sum("read_count").alias("reads"), F.sum("rpkm").alias("rpkm"),
             F.sum("coverage").alias("coverage")]
    return pivoted(series, keys, "sample_id", sample_list, cells)


def assembled_reads_table(
    reads: DataFrame, contig_samples: DataFrame, functions: DataFrame,
    sample_list: Sequence[str], paired: bool,
) -> DataFrame:
    """Reads per function: each sample, all, assembled, unassembled."""
    wide = pivoted(
        assembly.reads_per_sample(reads, paired), ["function"], "sample_id", sample_list,
        [F.sum("reads")], fill=0,
    )
    names = functions.select("function", F.col("name").alias("definition"))
    return (
        wide.join(assembly.read_balance(reads, contig_samples, paired), "function")
        .join(names, "function", "left")
        .withColumn("definition", F.coalesce("definition", F.lit("")))
    )


def contig_table(
    contigs: DataFrame, genes: DataFrame, contig_samples: DataFrame, samples: DataFrame,
    functions: DataFrame, sample_list: Sequence[str],
) -> DataFrame:
    """Contigs with length, reads, RPKM, coverage, number of genes and per-sample triplets."""
    series = assembly.contig_rpkm(contigs, contig_samples, samples, both_ends=True)
    total = series.where(F.col("sample_id") == assembly.ALL_SAMPLES).select(
        *assembly.CONTIG, "length", "read_count", "rpkm", "coverage"
    )
    counts = assembly.place_genes(genes).groupBy(*assembly.CONTIG).agg(
        F.count("*").alias("genes")
    )
    triplets = _contig_triplets(series, sample_list, assembly.CONTIG)
    names = functions.select("function", F.col("name").alias("definition"))
    return (
        total.join(counts, assembly.CONTIG, "left")
        .join(triplets, assembly.CONTIG, "left")
        .join(names, "function", "left")
        .withColumn("genes", F.coalesce("genes", F.lit(0)))
    )


def gene_table(
    annotated: DataFrame, genes: DataFrame, contigs: DataFrame, contig_samples: DataFrame,
    samples: DataFrame, proteins: DataFrame, functions: DataFrame, taxa: DataFrame,
    sample_list: Sequence[str], params: RunParams,
) -> DataFrame:
    """One row per gene: place, read share, annotation of good genes, per-sample triplets.

    The total read share uses the gene's span, the per-sample shares three times its protein.
    """
    series = assembly.contig_rpkm(contigs, contig_samples, samples, both_ends=True)
    total = series.where(F.col("sample_id") == assembly.ALL_SAMPLES).select(
        *assembly.CONTIG, "length", "read_count", "rpkm", "coverage"
    )
    good = annotated.where(F.col("status") == GOOD)
    subjects = annotate(
        good.select("gene_id", F.posexplode("hits").alias("hit_no", "hit")).select(
            "gene_id", "hit_no", "hit.subject_id", "hit.identity", "hit.s_len",
            F.col("hit.functions").alias("hit_functions"),
        ),
        proteins, params,
    )
    organism = taxa.select(
        F.col("taxid").alias("subject_taxid"), F.col("name").alias("organism"), "lineage"
    )
    described = subjects.join(organism, "subject_taxid", "left").groupBy("gene_id").agg(
        F.array_sort(F.collect_list(F.struct(
            "hit_no", "subject_id", "subject_taxid", "organism", "lineage", "hit_functions",
        ))).alias("rows"),
        F.avg("identity").alias("gene_identity"),
        F.sum("s_len").alias("reference_length"), F.count("*").alias("hits"),
    )

    def joined(field: str, separator: str) -> Column:
        return F.array_join(
            F.transform("rows", lambda r: F.coalesce(r[field], F.lit(""))), separator
        ).alias(field)

    annotation = described.select(
        "gene_id", "gene_identity", "reference_length", "hits",
        F.array_join(
            F.array_sort(F.array_distinct(F.flatten(
                F.transform("rows", lambda r: r["hit_functions"])
            ))), ",",
        ).alias("gene_functions"),
        joined("subject_id", ","), joined("subject_taxid", ","), joined("organism", ","),
        joined("lineage", "|"),
    )
    lca = taxa.select(
        F.col("taxid").alias("taxonomy"), F.col("name").alias("lca_organism"),
        F.col("lineage").alias("lca_lineage"),
    )
    placed = assembly.place_genes(genes)
    protein_share = F.length("protein_sequence") * 3 / F.col("length")
    per_sample = (
        placed.select(*assembly.CONTIG, "gene_id", "protein_sequence")
        .join(series.where(F.col("sample_id") != assembly.ALL_SAMPLES), assembly.CONTIG)
        .withColumn("read_count", F.col("read_count") * protein_share)
    )
    triplets = _contig_triplets(per_sample, sample_list, ["gene_id"])
    span = F.col("gene_end") - F.col("gene_start") + 1
    status = annotated.select("gene_id", "status", "taxonomy")
    names = functions.select("function", F.col("name").alias("definition"))
    return (
        placed.join(total, assembly.CONTIG)
        .join(status, "gene_id", "left")
        .join(annotation, "gene_id", "left")
        .join(lca, "taxonomy", "left")
        .join(triplets, "gene_id", "left")
        .join(names, "function", "left")
        .select(
            "gene_id", "function", "contig_id", "gene_start", "gene_end",
            span.alias("gene_length"), "strand",
            (F.col("read_count") * span / F.col("length")).alias("read_count"), "rpkm", "coverage",
            F.coalesce("status", F.lit("unaccounted")).alias("status"),
            "gene_functions", "gene_identity",
            (F.length("protein_sequence") * 100 * F.col("hits") / F.col("reference_length"))
            .alias("completeness"),
            "subject_id", "subject_taxid", "organism", "lineage",
            F.when(F.col("status") == GOOD, F.col("taxonomy")).alias("lca_taxid"),
            "lca_organism", "lca_lineage",
            *[c for c in triplets.columns if c != "gene_id"], "definition",
        )
    )


def assembly_listing(
    annotated: DataFrame, genes: DataFrame, contigs: DataFrame, contig_samples: DataFrame,
    samples: DataFrame,
) -> DataFrame:
    """Good genes with reads, coverage and RPKM of their contig in each sample."""
    series = assembly.contig_rpkm(contigs, contig_samples, samples)
    functions = F.array_join(F.array_sort(F.map_keys("functions")), ",")
    return (
        assembly.good_genes(annotated, genes)
        .select(*assembly.CONTIG, "gene_id", functions.alias("functions"))
        .join(series.where(F.col("sample_id") != assembly.ALL_SAMPLES), assembly.CONTIG)
        .select(
            *assembly.CONTIG, "length", "gene_id", "functions", "sample_id", "read_count",
            fixed_decimals("coverage", 2),
            fixed_decimals("rpkm", 2),
        )
    )


def gene_sequences(
    annotated: DataFrame, genes: DataFrame, contigs: DataFrame, taxa: DataFrame
) -> DataFrame:
    """Nucleotide and protein sequence of each good gene under every function of its hits."""
    lineage = taxa.select(F.col("taxid").alias("taxonomy"), "lineage")
    cut = region_slice(F.col("sequence"), F.col("gene_start"), F.col("gene_end"))
    listed = F.array_distinct(F.flatten(F.transform("hits", lambda h: h["functions"])))
    placed = assembly.good_genes(annotated, genes).withColumn("hit_function", F.explode(listed))
    return (
        placed.join(contigs, assembly.CONTIG)
        .join(lineage, "taxonomy", "left")
        .select(
            F.col("hit_function").alias("function"), "gene_id",
            F.concat_ws(
                "|", "gene_id", F.col("gene_start").cast("string"),
                F.col("gene_end").cast("string"), "strand",
                F.coalesce("lineage", F.lit("")),
            ).alias("header"),
            F.when(F.col("strand") == "-1", reverse_complement(cut)).otherwise(cut)
            .alias("sequence"),
            F.col("protein_sequence").alias("protein"),
        )
    )


def rank_of(profile: DataFrame, rank: str) -> DataFrame:
    """The lines of a profile at one rank."""
    if rank not in RANKS:
        raise ValueError(f"unknown rank {rank!r}")
    return profile.where(F.col("rank") == rank)
