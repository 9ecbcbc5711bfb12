"""Function and protein catalogues: lookups and identity thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.operators.hits import deduplicate
from readloom.operators.skew import join_dimension, join_written
from readloom.operators.taxonomy import UNKNOWN_TOUR, is_ranked
from readloom.params import RANKS, ROOT_TAXID, UNKNOWN_TAXID, RunParams
from readloom.session import is_small


def function_cutoff(params: RunParams) -> Column:
    """Identity a function asks for: its own cutoff, else the general one."""
    return F.coalesce(F.col("function_cutoff"), F.lit(params.identity_cutoff))


def rank_cutoff(rank: Column | str, params: RunParams) -> Column:
    """Identity a function asks for at a rank; without own cutoffs the general one."""
    return F.coalesce(F.try_element_at("cutoffs", F.lit(rank)), F.lit(params.identity_cutoff))


def identity_thresholds(functions: DataFrame, params: RunParams) -> DataFrame:
    """Every (function, rank) threshold, and those without a function or without a rank."""
    ranks = F.array(*[F.lit(r) for r in RANKS])
    own = functions.select("function", "function_cutoff", "cutoffs", F.explode(ranks).alias("rank"))
    per_rank = own.select("function", "rank", rank_cutoff(F.col("rank"), params).alias("cutoff"))
    per_function = functions.select(
        "function", F.lit(None).cast("string").alias("rank"),
        function_cutoff(params).alias("cutoff"),
    )
    spark = functions.sparkSession
    general = [(None, rank, params.rank_cutoffs.get(rank, params.identity_cutoff))
               for rank in [*RANKS, None]]
    config = spark.createDataFrame(general, "function string, rank string, cutoff double")
    return per_rank.unionByName(per_function).unionByName(config)


def protein_dimension(
    proteins: DataFrame, functions: DataFrame, taxa: DataFrame, params: RunParams
) -> DataFrame:
    """Proteins with all that a hit needs to know about its subject.

    ``identity_cutoff`` is the strictest cutoff of its functions. ``steps`` are the ranked taxa
    from its own taxon upwards with the identity each asks for, so that the taxon a hit supports
    is an array lookup instead of a climb. ``trail`` and ``shallow_last`` let ``lineage_nodes`` find the
    LCA of such taxa.
    """
    listed = proteins.select("protein_id", F.explode("functions").alias("function"))
    cutoffs = functions.select("function", "function_cutoff", "cutoffs")
    per_rank = [F.min(rank_cutoff(r, params)).alias(f"min_{r}") for r in RANKS]
    by_protein = (
        listed.join(cutoffs, "function", "left")
        .groupBy("protein_id")
        .agg(F.max(function_cutoff(params)).alias("strictest"), *per_rank)
    )
    paths = taxa.select("taxid", "path", "path_tours", "trail")
    # The last number among lineages of the root and of taxa right below it.
    shallow = F.col("trail")[0]
    shallow_last = taxa.where((F.size("trail") > 0) & (shallow["taxid"] == ROOT_TAXID)).agg(
        F.max(shallow["last"])).scalar()
    known = proteins.join(paths, "taxid", "left")
    unknown_path = F.array(
        F.struct(F.lit(UNKNOWN_TAXID).alias("taxid"), F.lit(RANKS[0]).alias("rank"),
                 F.lit("Unknown").alias("name"))
    )
    joined = (
        known.join(by_protein, "protein_id")
        .withColumn("path", F.coalesce("path", unknown_path))
        .withColumn("path_tours", F.coalesce("path_tours", F.array(F.lit(UNKNOWN_TOUR).cast("bigint"))))
        .withColumn("shallow_last", shallow_last)
    )
    minimum = F.create_map(*[c for r in RANKS for c in (F.lit(r), F.col(f"min_{r}"))])
    under = F.filter("path", lambda t: t["taxid"] != ROOT_TAXID)
    numbered = F.transform(
        F.arrays_zip(under.alias("taxon"), F.col("path_tours").alias("tour")),
        lambda x, i: F.struct(
            (i + 1).alias("depth"), x["taxon"]["rank"].alias("rank"), x["taxon"]["taxid"].alias("taxid"),
            x["tour"].alias("tour"),
        ),
    )
    ranked = F.filter(numbered, lambda t: is_ranked(t["rank"]))
    steps = F.reverse(
        F.transform(
            ranked,
            lambda t: F.struct(
                t["depth"].alias("depth"),
                F.least(F.lit(100.0), F.try_element_at("minimum", t["rank"])).alias("min_identity"),
                t["taxid"].alias("taxid"), t["tour"].alias("tour"),
            ),
        )
    )
    return joined.withColumn("minimum", minimum).select(
        "protein_id", "taxid", "functions",
        F.when(F.col("strictest") == 0, params.identity_cutoff)
        .otherwise(F.col("strictest"))
        .alias("identity_cutoff"),
        steps.alias("steps"), "trail", "shallow_last",
    )


def lineage_nodes(proteins: DataFrame) -> DataFrame:
    """``tour``, ``trail`` of all taxa that hits on the catalogue's proteins may support."""
    trail_at = F.when(
        F.col("step.depth") > 1, F.slice("trail", F.lit(1), F.col("step.depth"))
    ).otherwise(F.array(
        F.struct(F.lit(ROOT_TAXID).alias("taxid"), F.col("shallow_last").alias("last")),
        F.struct(F.col("step.taxid").alias("taxid"), F.col("step.tour").alias("last"))))
    return (
        proteins.select(F.explode("steps").alias("step"), "trail", "shallow_last")
        .where(F.col("step.tour") != UNKNOWN_TOUR)
        .select(F.col("step.tour").alias("tour"), trail_at.alias("trail"))
        .dropDuplicates(["tour"])
    )


def annotate(hits: DataFrame, proteins: DataFrame, params: RunParams) -> DataFrame:
    """Attach functions, the identity cutoff and the taxonomy steps of the subject.

    A subject the catalogue lacks has one empty function and the unknown taxon. A catalogue too large to
    broadcast should be in buckets of ``protein_id``; then only hits of subjects that are not hot move.
    """
    subject = _subjects(proteins)
    if is_small(proteins):
        return _with_unknown(hits.join(F.broadcast(subject), "subject_id", "left"), params)
    return _with_unknown(join_dimension(hits, subject, "subject_id"), params)


def is_broadcast(proteins: DataFrame) -> bool:
    """Whether ``annotate`` sends the catalogue to the hits."""
    return is_small(proteins)


def annotate_distinct(
    hits: DataFrame, keys: Sequence[str], proteins: DataFrame, params: RunParams,
    hits_are_written: bool = False,
) -> DataFrame:
    """``annotate`` of the de-duplicated hits.

    With a catalogue in buckets, hits move to their subjects once and are de-duplicated there; copies of hot
    subjects' hits combine where they are.
    """
    if is_small(proteins):
        return annotate(deduplicate(hits, keys), proteins, params)
    join = join_written if hits_are_written else join_dimension
    return _with_unknown(
        join(hits, _subjects(proteins), "subject_id", reduce=lambda rows: deduplicate(rows, keys)), params)


def _subjects(proteins: DataFrame) -> DataFrame:
    return proteins.select(
        F.col("protein_id").alias("subject_id"),
        "functions", "identity_cutoff", "steps",
        F.col("taxid").alias("subject_taxid"),
    )


def _with_unknown(joined: DataFrame, params: RunParams) -> DataFrame:
    unknown_step = F.array(
        F.struct(
            F.lit(1).alias("depth"), F.lit(params.identity_cutoff).alias("min_identity"),
            F.lit(UNKNOWN_TAXID).alias("taxid"), F.lit(UNKNOWN_TOUR).cast("bigint").alias("tour"))
    )
    return (
        joined
        .withColumn("functions", F.coalesce("functions", F.array(F.lit(""))))
        .withColumn("identity_cutoff",
                    F.coalesce("identity_cutoff", F.lit(params.identity_cutoff)))
        .withColumn("steps", F.coalesce("steps", unknown_step))
        .withColumn("subject_taxid", F.coalesce("subject_taxid", F.lit(UNKNOWN_TAXID)))
    )


def filter_by_identity(annotated: DataFrame) -> DataFrame:
    return annotated.where(F.col("identity") >= F.col("identity_cutoff"))


def supported_step() -> Column:
    """The lowest ranked taxon (``taxid``, ``tour``) whose threshold the hit's identity reaches."""
    passing = F.filter("steps", lambda s: F.col("identity") >= s["min_identity"])
    return F.try_element_at(passing, F.lit(1))
