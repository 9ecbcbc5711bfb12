"""Operators on the taxonomy tree: ancestor paths, lookups, lowest common ancestors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.params import RANKS, ROOT_TAXID, UNKNOWN_TAXID
from readloom.session import broadcast_if_small, written

# Sorts below every character of a taxon id, so joined lineages sort like the arrays they join.
_SEPARATOR = "\x01"
# Number of the unknown taxon; all others have 0 or more.
UNKNOWN_TOUR = -1


def complete_taxonomy(rows: DataFrame) -> DataFrame:
    """Add the unknown taxon below the root and give the root the rank 'norank'."""
    unknown = rows.sparkSession.createDataFrame(
        [(UNKNOWN_TAXID, "Unknown", "norank", ROOT_TAXID)],
        "taxid string, name string, rank string, parent string",
    )
    rank = F.when(F.col("taxid") == ROOT_TAXID, "norank").otherwise(F.col("rank"))
    known = rows.where(F.col("taxid") != UNKNOWN_TAXID).withColumn("rank", rank)
    return known.select("taxid", "name", "rank", "parent").unionByName(unknown)


def ancestor_paths(taxonomy: DataFrame) -> DataFrame:
    """Add ``path``: the taxa from the root down to each taxon, itself included.

    Paths grow by pointer doubling: each round joins the table with itself once and doubles the
    levels covered, so a tree of depth d takes log2(d) rounds. Every round is a written table.
    """
    me = F.struct("taxid", "rank", "name")
    state = written(
        taxonomy.select(
            "taxid", "name", "rank", "parent",
            F.array(me).alias("path"),
            F.when(F.col("taxid") != ROOT_TAXID, F.col("parent")).alias("above"),
        )
    )
    while not state.where(F.col("above").isNotNull()).isEmpty():
        # A path that meets its own taxon again never reaches the root.
        again = F.filter("path", lambda t: t["taxid"] == F.col("taxid"))
        looped = state.where(F.size(again) > 1).select("taxid").first()
        if looped:
            raise ValueError(f"the taxonomy has a cycle through {looped['taxid']}")
        upper = broadcast_if_small(
            state.select(
                F.col("taxid").alias("above"),
                F.col("path").alias("upper_path"),
                F.col("above").alias("next_above"),
            )
        )
        state = written(
            state.join(upper, "above", "left").select(
                "taxid", "name", "rank", "parent",
                F.coalesce(F.concat("upper_path", "path"), "path").alias("path"),
                F.col("next_above").alias("above"),
            )
        )
    return state.drop("above")


def is_ranked(rank: Column) -> Column:
    return rank.isin(RANKS)


def below_root(path: Column) -> Column:
    """Ids of a path without the root."""
    return F.filter(F.transform(path, lambda t: t["taxid"]), lambda t: t != ROOT_TAXID)


def numbered_lineages(paths: DataFrame) -> DataFrame:
    """Taxa numbered in the order of a walk down the lineages an LCA compares.

    A lineage leaves the root out, except right below it: such a taxon, and the root itself, hang below a
    root of their own. ``tour`` numbers the lineages so that those that begin with the same taxa are an
    interval (numbers have gaps). ``trail`` lists the taxa of a lineage, each with the last number of its
    interval; ``path_tours`` the own numbers of the path's taxa below the root. The unknown taxon has no
    lineage and is not in the result.
    """
    spark = paths.sparkSession
    ids = below_root(F.col("path"))
    deep = F.size("ids") > 1
    lineage = F.when(deep, F.array_join("ids", _SEPARATOR)).otherwise(
        F.concat(F.lit(ROOT_TAXID + _SEPARATOR), F.coalesce(F.get("ids", F.lit(0)), F.lit(ROOT_TAXID))))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        paths.where(F.col("taxid") != UNKNOWN_TAXID).select("taxid", ids.alias("ids"))
        .withColumn("lineage", lineage)
        .repartitionByRange(tasks, "lineage").sortWithinPartitions("lineage")
    )
    # Ranges and rows in them are in order, and so are Spark's row ids; written, since they are given once.
    numbered = written(ordered.select("taxid", "ids", F.monotonically_increasing_id().alias("tour")))
    nodes = F.when(deep, F.col("ids")).otherwise(F.array(F.lit(ROOT_TAXID)))
    steps = numbered.select("taxid", "tour", F.posexplode(nodes).alias("pos", "node"))
    ends = steps.groupBy("node").agg(F.max("tour").alias("last"))
    own = numbered.select(F.col("taxid").alias("node"), F.col("tour").alias("own"))
    trails = steps.join(ends.join(own, "node", "left"), "node").groupBy("taxid").agg(
        F.array_sort(F.collect_list(F.struct("pos", "node", "last", "own"))).alias("steps"))
    trail = F.transform("steps", lambda x: F.struct(x["node"].alias("taxid"), x["last"].alias("last")))
    itself = F.array(F.struct("taxid", F.col("tour").alias("last")))
    return numbered.join(trails, "taxid").select(
        "taxid", "tour",
        F.when(deep, trail).otherwise(F.concat(trail, itself)).alias("trail"),
        F.when(deep, F.transform("steps", lambda x: x["own"]))
        .otherwise(F.slice(F.array("tour"), F.lit(1), F.size("ids"))).alias("path_tours"),
    )


def taxon_dimension(taxonomy: DataFrame) -> DataFrame:
    """One row per taxon with everything the other operators look up."""
    paths = ancestor_paths(taxonomy)
    ranked = F.filter("path", lambda t: is_ranked(t["rank"]))
    above = F.filter(
        F.slice("path", 1, F.size("path") - 1), lambda t: is_ranked(t["rank"])
    )
    names = F.transform(
        F.filter(above, lambda t: t["taxid"] != ROOT_TAXID), lambda t: t["name"]
    )
    joined = F.array_join(F.concat(names, F.array("name")), "_")

    def tours_at(rank: str) -> Column:
        """Numbers of the taxa of a rank on the path, usually one or none."""
        below = F.filter("path", lambda t: t["taxid"] != ROOT_TAXID)
        numbers = F.zip_with(
            below, "path_tours", lambda t, tour: F.when(t["rank"] == rank, tour))
        return F.filter(numbers, lambda tour: tour.isNotNull())

    return (
        paths.withColumn("ranked_path", ranked)
        .withColumn("upper", F.try_element_at(above, F.lit(-1)))
        .withColumn(
            "lineage",
            F.when(F.col("taxid") == ROOT_TAXID, "").otherwise(F.translate(joined, " ()", "___")),
        )
        .join(numbered_lineages(paths), "taxid", "left")
        .withColumn("tour", F.coalesce("tour", F.lit(UNKNOWN_TOUR)))
        .withColumn("path_tours", F.coalesce("path_tours", F.array("tour")))
        .select(
            "taxid", "name", "rank", "parent", "path", "ranked_path", "lineage",
            F.when(F.col("taxid") == ROOT_TAXID, ROOT_TAXID)
            .otherwise(F.coalesce("upper.taxid", F.lit(UNKNOWN_TAXID)))
            .alias("ranked_parent"),
            F.when(F.col("taxid") == ROOT_TAXID, "norank")
            .otherwise(F.coalesce("upper.rank", F.lit("norank")))
            .alias("ranked_parent_rank"),
            "tour", "trail", "path_tours",
            *[end(tours_at(r)).alias(f"{name}_{r}")
              for r in RANKS[1:] for name, end in (("low", F.array_min), ("high", F.array_max))],
        )
    )


def lineage_closure(taxa: DataFrame) -> DataFrame:
    """All (taxon, ancestor) pairs with the distance between them, itself at distance 0."""
    steps = taxa.select("taxid", F.size("path").alias("n"), F.posexplode("path"))
    return steps.select(
        "taxid", F.col("col.taxid").alias("ancestor"), F.col("col.rank").alias("ancestor_rank"),
        (F.col("n") - 1 - F.col("pos")).alias("distance"),
    )


def lca_parts(tour: Column, prefix: str = "") -> list[Column]:
    """Aggregates an LCA needs: the least and the largest number of a taxon that is not unknown."""
    known = F.when(tour != UNKNOWN_TOUR, tour)
    return [F.min(known).alias(prefix + "lowest"), F.max(known).alias(prefix + "highest")]


def lca_label(trail: Column, highest: Column) -> Column:
    """LCA of a set of lineages, given the trail of its least and the number of its largest.

    It is the deepest taxon of the trail whose interval reaches the largest number.
    """
    shared = F.filter(trail, lambda t: t["last"] >= highest)
    return F.coalesce(F.try_element_at(shared, F.lit(-1))["taxid"], F.lit(UNKNOWN_TAXID))


def with_lca(grouped: DataFrame, taxa: DataFrame, name: str = "lca") -> DataFrame:
    """``name`` in place of ``lowest`` and ``highest``: one lookup a group; no known taxon gives unknown.

    ``taxa`` has ``tour`` and ``trail``.
    """
    trails = taxa.select(F.col("tour").alias("lowest"), "trail")
    return grouped.join(trails, "lowest", "left").withColumn(
        name, lca_label(F.col("trail"), F.col("highest"))).drop("lowest", "highest", "trail")


def _fingerprint(taxid: str) -> Column:
    """A number that tells ids apart, so that finding groups of one id needs no text in the aggregate."""
    return F.when(F.col(taxid).isNotNull(), F.xxhash64(taxid))


def _single_strangers(
    keyed: DataFrame, grouped: DataFrame, keys: Sequence[str], taxid: str
) -> DataFrame:
    """``grouped`` with ``stranger``: the only id of a group, if the taxonomy lacks it.

    ``grouped`` has ``one`` and ``other``, the least and the largest fingerprint of a group.
    """
    lacking = keyed.where(F.col("tour").isNull() & (F.col(taxid) != "")).select(
        *keys, F.col(taxid).alias("stranger"), F.col("print").alias("one")).distinct()
    return grouped.withColumn(
        "one", F.when(F.col("one") == F.col("other"), F.col("one"))
    ).join(lacking, [*keys, "one"], "left").drop("other")


def lowest_common_ancestor(
    members: DataFrame, keys: Sequence[str], taxa: DataFrame, taxid: str = "taxid"
) -> DataFrame:
    """LCA of the distinct taxa of each group; one shuffle of four numbers per group.

    A group of one taxon returns it as is, even when the taxonomy lacks it; an empty id is
    unknown. Beside others, ids the taxonomy lacks are ignored.
    """
    lookup = taxa.select(F.col("taxid").alias(taxid), "tour")
    keyed = members.join(lookup, taxid, "left").withColumn("print", _fingerprint(taxid))
    grouped = keyed.groupBy(*keys).agg(
        *lca_parts(F.col("tour")), F.min("print").alias("one"), F.max("print").alias("other"))
    found = with_lca(_single_strangers(keyed, grouped, keys, taxid), taxa)
    return found.select(*keys, F.coalesce("stranger", "lca").alias("lca"))


def lowest_common_ranked_ancestor(
    members: DataFrame, keys: Sequence[str], taxa: DataFrame, taxid: str = "taxid"
) -> DataFrame:
    """LCA over the allowed ranks only: the lowest rank with one taxon, above the first with two.

    Each rank needs the least and the largest number of its taxa in a group, all in one aggregate.
    """
    ranks = RANKS[1:]
    lookup = taxa.select(
        F.col("taxid").alias(taxid), "tour", *[f"{e}_{r}" for r in ranks for e in ("low", "high")])
    keyed = members.join(lookup, taxid, "left").withColumn("print", _fingerprint(taxid))
    counted = F.col("tour") != UNKNOWN_TOUR
    grouped = keyed.groupBy(*keys).agg(
        *[F.min(F.when(counted, F.col(f"low_{r}"))).alias(f"low_{r}") for r in ranks],
        *[F.max(F.when(counted, F.col(f"high_{r}"))).alias(f"high_{r}") for r in ranks],
        F.min("tour").alias("own"), F.min("print").alias("one"), F.max("print").alias("other"))
    levels = F.array(*[
        F.struct(F.col(f"low_{r}").alias("low"), (F.col(f"low_{r}") != F.col(f"high_{r}")).alias("split"))
        for r in ranks])
    there = F.filter(levels, lambda x: x["low"].isNotNull())
    # Levels up to the first that is split.
    first_split = F.array_position(F.transform("there", lambda x: x["split"]), True)
    agreed = F.when(first_split == 0, F.size("there")).otherwise(first_split - 1).cast("int")
    ranked = F.when(agreed > 0, F.try_element_at("there", agreed)["low"])
    only = F.col("one").isNotNull()
    numbers = (
        _single_strangers(keyed, grouped, keys, taxid).withColumn("there", there)
        .select(*keys, "stranger", F.when(only, F.col("own")).otherwise(ranked).alias("tour"))
    )
    labels = taxa.select("tour", F.col("taxid").alias("label"))
    return numbers.join(labels, "tour", "left").select(
        *keys, F.coalesce("stranger", "label", F.lit(UNKNOWN_TAXID)).alias("lca"))
