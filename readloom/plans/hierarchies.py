"""Node tables for hierarchical charts: every node with its path and values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.operators.rollup import mean_identity, roll_up, tree_nodes
from readloom.operators.stats import LIBRARY, group_read_counts
from readloom.params import GOOD
from readloom.plans.reports import VALUES


def function_hierarchy(annotated: DataFrame, functions: DataFrame) -> DataFrame:
    """Library -> function group -> function, with reads, score and mean identity."""
    counted = group_read_counts(annotated, functions)
    score = F.aggregate(F.map_values("functions"), F.lit(0.0), lambda a, v: a + v)
    top = annotated.where(F.col("status") == GOOD).groupBy(*LIBRARY).agg(
        F.count("*").alias("reads"), F.sum(score).alias("score")
    ).select(
        *LIBRARY, F.concat_ws("_", *LIBRARY).alias("path"), "reads", "score",
        F.lit(0.0).alias("avg_identity"),
    )
    path = F.concat_ws(
        "/", F.concat_ws("_", *LIBRARY), "group",
        F.when(F.col("level") == "function", F.col("function")),
    )
    return top.unionByName(
        counted.select(*LIBRARY, path.alias("path"), "reads", "score", "avg_identity")
    )


def taxonomy_hierarchy(
    scores: DataFrame, taxa: DataFrame, series: str, scope: list[str], residual: bool
) -> DataFrame:
    """Taxon nodes with values per data series, with or without residual nodes."""
    if residual:
        nodes = tree_nodes(scores, taxa, scope, [series], VALUES, "count")
    else:
        nodes = roll_up(scores, taxa, [*scope, series], VALUES)
    return nodes.select(
        *scope, F.array_join("path", "/").alias("path"), "rank", "name", series, "score", "count",
        mean_identity().alias("avg_identity"),
    )


def assembly_hierarchy(
    gene_rows: DataFrame, scores: DataFrame, taxa: DataFrame, series: str, scope: list[str]
) -> DataFrame:
    """Taxon nodes and, below the node of its own taxon, one leaf per gene."""
    values = ["rpkm", "count", "hit_count", "identity"]
    profile = roll_up(scores, taxa, [*scope, series], values)
    nodes = profile.select(
        *scope, F.array_join("path", "/").alias("path"), F.lit("taxon").alias("kind"),
        F.col("name"), series, "rpkm", "count", mean_identity().alias("avg_identity"),
        F.lit(0.0).alias("completeness"), F.lit(0.0).alias("coverage"),
        F.lit(0).alias("protein_length"),
    )
    places = taxa.select(
        F.col("taxid").alias("taxonomy"),
        F.array_join(F.transform("ranked_path", lambda t: t["taxid"]), "/").alias("place"),
    )
    leaves = gene_rows.join(places, "taxonomy").select(
        *scope, F.concat_ws("/", "place", "gene_id").alias("path"), F.lit("gene").alias("kind"),
        F.col("gene_id").alias("name"), series, "rpkm", "count",
        F.col("identity").alias("avg_identity"), "completeness", "coverage", "protein_length",
    )
    return nodes.unionByName(leaves)
