"""Scores on the taxonomy tree: roll-up, residual nodes and line numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from readloom.params import LOWER_RANK, RANKS, ROOT_TAXID, UNKNOWN_TAXID
from readloom.session import written

# Starts the id of a residual node and sorts it after the taxa beside it.
RESIDUAL_MARK = "~"
# Relative slack for "the children add up to the node" on floating-point scores, whose sums round.
SCORE_SLACK = 1e-9


def tree_paths(taxa: DataFrame) -> DataFrame:
    """Path of each taxon over ranked taxa only, from the root down to its nearest ranked taxon."""
    return taxa.select(F.col("taxid").alias("taxonomy"), F.col("ranked_path").alias("tree_path"))


def roll_up(
    scores: DataFrame, taxa: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Sum every taxon's values into its nearest ranked taxon and all ranked ancestors.

    Values are first summed per taxon, so the join that multiplies rows by the depth of the tree
    sees at most one row per (taxon, key). Ids the taxonomy lacks hang below the unknown taxon.
    """
    per_taxon = scores.groupBy("taxonomy", *keys).agg(*[F.sum(v).alias(v) for v in values])
    node = lambda taxid, rank, name: F.struct(
        taxid.alias("taxid"), rank.alias("rank"), name.alias("name")
    )
    norank = F.lit(RANKS[0])
    stray = F.array(
        node(F.lit(ROOT_TAXID), norank, F.lit("root")),
        node(F.lit(UNKNOWN_TAXID), norank, F.lit("Unknown")),
        node(F.col("taxonomy"), norank, F.col("taxonomy")),
    )
    placed = per_taxon.join(tree_paths(taxa), "taxonomy", "left").withColumn(
        "tree_path", F.coalesce("tree_path", stray)
    )
    steps = F.transform(
        "tree_path",
        lambda t, i: F.struct(
            t["taxid"].alias("taxid"), t["rank"].alias("rank"), t["name"].alias("name"),
            F.transform(F.slice("tree_path", F.lit(1), i + 1), lambda x: x["taxid"]).alias("path"),
        ),
    )
    return (
        placed.select(*keys, *values, F.inline(steps))
        .groupBy("taxid", "rank", "name", "path", *keys)
        .agg(*[F.sum(v).alias(v) for v in values])
        .withColumn("parent", F.get("path", F.size("path") - 2))
    )


def child_sums(
    profile: DataFrame, scope: Sequence[str], keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Every (node, key) that has children in the tree, with the sums over those children.

    Each combination of ``scope`` columns has a tree of its own. A node whose children lack the
    key has sums of 0.
    """
    inner = profile.where(F.col("parent").isNotNull())
    sums = inner.groupBy(F.col("parent").alias("taxid"), *scope, *keys).agg(
        *[F.sum(v).alias(f"child_{v}") for v in values]
    )
    parents = sums.select("taxid", *scope).distinct()
    nodes = profile.join(parents, ["taxid", *scope], "left_semi")
    return nodes.join(sums, ["taxid", *scope, *keys], "left").na.fill(
        0, [f"child_{v}" for v in values]
    )


def residual_nodes(
    profile: DataFrame, scope: Sequence[str], keys: Sequence[str], values: Sequence[str],
    trigger: str, slack: float = SCORE_SLACK,
) -> DataFrame:
    """One node below every parent whose children do not add up to it on ``trigger``.

    Whole numbers are compared exactly, floating-point scores with a relative ``slack``. The
    species rank has no lower rank and gets none.
    """
    lower = F.create_map(*[F.lit(x) for pair in LOWER_RANK.items() for x in pair])
    gap = F.col(trigger) - F.col(f"child_{trigger}")
    inexact = isinstance(profile.schema[trigger].dataType, (T.DoubleType, T.FloatType))
    room = F.abs(F.col(trigger)) * slack if inexact else F.lit(0)
    summed = child_sums(profile, scope, keys, values)
    residual_id = F.concat(F.lit(RESIDUAL_MARK), "taxid")
    return summed.where(
        (gap > room) & F.col("rank").isin(list(LOWER_RANK))
    ).select(
        residual_id.alias("taxid"),
        F.try_element_at(lower, F.col("rank")).alias("rank"),
        F.when(F.col("taxid") == ROOT_TAXID, "Unclassified")
        .otherwise(F.concat(F.lit("Unclassified "), F.col("name")))
        .alias("name"),
        F.concat("path", F.array(residual_id)).alias("path"),
        *scope, *keys,
        *[(F.col(v) - F.col(f"child_{v}")).alias(v) for v in values],
        F.col("taxid").alias("parent"),
    )


def with_residuals(
    profile: DataFrame, scope: Sequence[str], keys: Sequence[str], values: Sequence[str],
    trigger: str,
) -> DataFrame:
    return profile.unionByName(residual_nodes(profile, scope, keys, values, trigger))


def tree_nodes(
    scores: DataFrame, taxa: DataFrame, scope: Sequence[str], keys: Sequence[str],
    values: Sequence[str], trigger: str,
) -> DataFrame:
    """Profile and residual nodes of all trees, written: reports read them for lines, leaves and cells.

    The profile is written on the way, since children, sums and residuals each start from it.
    """
    profile = written(roll_up(scores, taxa, [*scope, *keys], values))
    return written(with_residuals(profile, scope, keys, values, trigger))


def preorder_lines(nodes: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Depth-first line number of each node, children in string order, residual nodes last.

    The line of a node is the sum, along its path, of 1 plus the sizes of the subtrees that come
    before it among its siblings. Only siblings are ever sorted together.
    """
    distinct = nodes.select(*scope, "taxid", "parent", "path").distinct()
    sizes = distinct.select(*scope, F.explode("path").alias("taxid")).groupBy(
        *scope, "taxid"
    ).agg(F.count("*").alias("size"))
    before = Window.partitionBy(*scope, "parent").orderBy("taxid").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = distinct.join(sizes, [*scope, "taxid"]).select(
        *scope, F.col("taxid").alias("step"),
        (F.coalesce(F.sum("size").over(before), F.lit(0)) + 1).alias("offset"),
    )
    return (
        distinct.select(*scope, "taxid", F.explode("path").alias("step"))
        .join(offsets, [*scope, "step"])
        .groupBy(*scope, "taxid")
        .agg(F.sum("offset").alias("line"))
    )


def mean_identity() -> Column:
    return F.when(F.col("hit_count") > 0, F.col("identity") / F.col("hit_count")).otherwise(0.0)
