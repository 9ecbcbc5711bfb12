"""Candidate search and classification of reads, proteins and genes.

Both searches first de-duplicate hits under their whole key: copies combine on the map side and
the hits of one hot query spread over every task. The classification then reduces the hits of a
region in shares, by subject, and only the levels left in reach of the best bit-score are brought
together by query.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from readloom.functions.scores import effective_per_kilobase
from readloom.operators.catalogue import (
    annotate, annotate_distinct, is_broadcast, lineage_nodes, supported_step,
)
from readloom.operators.hits import (
    deduplicate, filter_by_fixed_identity, filter_by_length, fold_overlaps,
)
from readloom.operators.skew import hot_buckets, in_buckets
from readloom.operators.taxonomy import lca_parts, with_lca
from readloom.params import BAD, CANDIDATE, GOOD, RunParams
from readloom.schemas import HIT_ORDER, HIT_PAYLOAD, KEPT_HIT_FIELDS
from readloom.session import written

# Tasks that share the hits of one region.
REGION_SPLIT = 32

_REGION = ["r_start", "r_end"]
_RAW_HIT = ["subject_id", "q_start", "q_end", *HIT_PAYLOAD]
_LCA = ["lowest", "highest"]
# A number in front of the names rows are grouped by: sorts then compare it, and names only where it is equal.
_LEAD = "_lead"


def _led(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows dealt out by the hash of ``by``, which leads the keys they are grouped by."""
    return rows.withColumn(_LEAD, F.xxhash64(*by)).repartition(_LEAD)


def non_overlapping_hits(
    hits: DataFrame, keys: Sequence[str], overlap_cutoff: int, extra: Sequence[str] = ()
) -> DataFrame:
    """De-duplicated hits to one row per query with the ordered hits that survive the fold."""
    payload = [f for f in HIT_PAYLOAD if f not in HIT_ORDER]
    return fold_overlaps(hits.select(*keys, *HIT_ORDER, *payload, *extra), keys, overlap_cutoff)


def find_candidates(
    hits: DataFrame,
    proteins: DataFrame,
    params: RunParams,
    keys: Sequence[str],
    fixed_identity: bool = False,
) -> DataFrame:
    """First search: queries with at least one accepted hit, their hits numbered as regions.

    With ``fixed_identity`` the general cutoffs are applied before overlaps are resolved (genes);
    otherwise each function's cutoff is applied after (reads, proteins).
    """
    if fixed_identity:
        accepted = filter_by_fixed_identity(hits, params.identity_cutoff, params.length_cutoff)
    else:
        accepted = filter_by_length(hits, params.length_cutoff)
    annotated = annotate_distinct(
        accepted.select(*keys, *_RAW_HIT), keys, proteins, params)
    resolved = non_overlapping_hits(
        annotated, keys, params.overlap_cutoff, ["functions", "identity_cutoff"]
    )
    if not fixed_identity:
        strong = F.filter("hits", lambda h: h["identity"] >= h["identity_cutoff"])
        resolved = resolved.withColumn("hits", strong)
    return resolved.where(F.size("hits") > 0)


def candidate_regions(candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per region. Where two hits share coordinates the later one stands for them.

    The earlier one stays with the query under coordinates that no search result carries.
    """
    later_twin = F.transform(
        "hits",
        lambda h, i: F.struct(
            i.alias("region_no"),
            *[h[f].alias(f) for f in [*_RAW_HIT, "functions"]],
            F.exists(
                F.slice("hits", i + 2, F.size("hits")),
                lambda o: (o["q_start"] == h["q_start"]) & (o["q_end"] == h["q_end"]),
            ).alias("shadowed"),
        ),
    )
    rows = candidates.select(*keys, F.inline(later_twin))
    aside = -1 - F.col("region_no")
    return rows.withColumn(
        "r_start", F.when(F.col("shadowed"), aside).otherwise(F.col("q_start"))
    ).withColumn("r_end", F.when(F.col("shadowed"), aside).otherwise(F.col("q_end")))


def _region_hits(
    regions: DataFrame, background: DataFrame, params: RunParams, keys: Sequence[str],
    distinct: bool,
) -> DataFrame:
    """Hits of both searches by region; those of the second are de-duplicated if ``distinct``."""
    region = [*keys, *_REGION]
    known = regions.select(*region, F.lit(1).alias("src"), "region_no", *_RAW_HIT)
    # Which copy is the first is settled before any cutoff is applied.
    found = filter_by_length(background, params.length_cutoff)
    found = deduplicate(found, region) if distinct else found
    return known.unionByName(found.select(
        *region, F.lit(0).alias("src"), F.lit(None).cast("int").alias("region_no"), *_RAW_HIT))


def _supported(annotated: DataFrame) -> DataFrame:
    """Looked up first: hits then move with what they support, not with their subject's lineage."""
    accepted = (F.col("src") == 1) | (F.col("identity") >= F.col("identity_cutoff"))
    return annotated.withColumn("accepted", accepted).withColumn(
        "tour", F.when(F.col("accepted"), supported_step()["tour"])
    ).drop("identity_cutoff", "steps", "subject_taxid")


def _per_query(
    regions: DataFrame, background: DataFrame, proteins: DataFrame, params: RunParams,
    keys: Sequence[str], score: Callable[[Column], Column], move_hits: bool,
    finish: Callable[[DataFrame], DataFrame], read_lengths: DataFrame | None = None,
) -> DataFrame:
    """Regions decided and finished; ``finish`` groups by no less than the keys.

    Under a catalogue that is not broadcast, hits are written once and counted by query. All hits of a query
    move together once, except those of queries with very many: shares of their regions are reduced first.
    """
    region = [*keys, *_REGION]
    shared = F.pmod(F.xxhash64("subject_id"), F.lit(REGION_SPLIT))

    def decided(levels: DataFrame) -> DataFrame:
        return finish(_decide_regions(levels, params, keys, score, move_hits))

    def levels_of(placed: DataFrame) -> DataFrame:
        levels = _score_levels(placed, params, keys)
        return levels if read_lengths is None else levels.join(read_lengths, ["sample_id", "end"], "left")

    def spread(rows: DataFrame) -> DataFrame:
        placed = _led(rows.withColumn("share", shared), [*region, "share"])
        return decided(_led(levels_of(placed), keys))

    if is_broadcast(proteins):
        rows = _region_hits(regions, background, params, keys, True)
        return spread(_supported(annotate(rows, proteins, params)))
    rows = written(_region_hits(regions, background, params, keys, False))
    # A region has one known hit, so those of the first search are left as they are.
    annotated = _supported(annotate_distinct(
        rows, [*region, "src", "region_no"], proteins, params, hits_are_written=True))
    hot, _ = hot_buckets(rows, keys)
    if hot:
        annotated = written(annotated)
    rest = annotated.where(~in_buckets(keys, hot)) if hot else annotated
    together = decided(levels_of(_led(rest.withColumn("share", F.lit(0)), keys)))
    return together.unionByName(spread(annotated.where(in_buckets(keys, hot)))) if hot else together


def _score_levels(placed: DataFrame, params: RunParams, keys: Sequence[str]) -> DataFrame:
    """Hits of each region reduced to distinct (bit-score, function list) levels.

    A level holds the number of its hits, the first of them and the ends of their lineages, which
    is all the vote, the best hits and the LCA need. Hits below their identity cutoff form one
    level without a score, which marks the region as searched. Levels outside the bit-score band
    of their own share of the region cannot be inside the band of the whole region and are
    dropped here. All hits of a subject are in one ``share`` of a region.
    """
    share = [_LEAD, *keys, *_REGION, "share"]
    level = [*share, "src", "level", "functions"]
    rest = ["identity", "length", "mismatch", "s_len", "s_start", "s_end", "evalue"]
    whole = Window.partitionBy(*share)
    known = F.col("src") == 1
    in_reach = F.col("level") > F.col("share_best") * (1.0 - params.bitscore_range)
    # The known hit is in one share, which has all hits of its subject.
    of_known = F.col("has_known") & F.col("subject_id").eqNullSafe(F.col("known_subject"))
    # Sorted once for the window and both aggregates.
    return (
        placed.withColumn("level", F.when(F.col("accepted"), F.col("bitscore")))
        .withColumn("functions", F.when(F.col("accepted"), F.col("functions")))
        .sortWithinPartitions(*level)
        .select(
            "*", F.max(F.when(~known, F.col("level"))).over(whole).alias("share_best"),
            F.max(F.when(known, F.col("subject_id"))).over(whole).alias("known_subject"),
            F.max(known).over(whole).alias("has_known"))
        .where(known | F.col("level").isNull() | in_reach)
        .groupBy(*level)
        .agg(
            F.min(F.struct(*HIT_ORDER, *rest)).alias("first"),
            F.count("*").alias("n"),
            F.max(F.when(~known & of_known, F.col("level"))).alias("same_subject"),
            F.max("region_no").alias("region_no"),
            *lca_parts(F.col("tour")),
        )
        .drop("share")
    )


def _decide_regions(
    levels: DataFrame, params: RunParams, keys: Sequence[str],
    score: Callable[[Column], Column], move_hits: bool,
) -> DataFrame:
    """Band filter, vote, best hits and supporting lineages of each region."""
    region = [_LEAD, *keys, *_REGION]
    packed = F.struct("src", "first", "level", "functions", "n", "same_subject", *_LCA)
    carried = [c for c in levels.columns
               if c not in [*region, "src", "first", "level", "functions", "n", "same_subject",
                            "region_no", *_LCA]]
    grouped = (
        levels.groupBy(*region)
        .agg(
            F.array_sort(F.collect_list(packed)).alias("levels"),
            F.max("region_no").alias("region_no"),
            *[F.max(c).alias(c) for c in carried],
        )
        .where(F.col("region_no").isNotNull())
    )
    band_floor = F.col("best") * (1.0 - params.bitscore_range)
    known = F.try_element_at(F.filter("levels", lambda x: x["src"] == 1), F.lit(1))
    found = F.filter("levels", lambda x: (x["src"] == 0) & x["level"].isNotNull())
    same_subject = F.array_max(F.transform(found, lambda x: x["same_subject"]))
    adds_known = (F.col("known.level") >= F.col("best")) & F.coalesce(
        same_subject <= band_floor, F.lit(True)
    )
    chosen = F.filter(
        "levels",
        lambda x: F.when(x["src"] == 1, adds_known).otherwise(
            F.coalesce(x["level"] > band_floor, F.lit(False))
        ),
    )
    total = F.aggregate("chosen", F.lit(0).cast("bigint"), lambda acc, x: acc + x["n"])

    def votes_for(function: Column) -> Column:
        return F.aggregate(
            "chosen", F.lit(0).cast("bigint"),
            lambda acc, x: acc
            + x["n"] * F.size(F.filter(x["functions"], lambda g: g == function)),
        )

    names = F.array_distinct(F.flatten(F.transform("chosen", lambda x: x["functions"])))

    def best_hit(function: Column) -> Column:
        carriers = F.filter("chosen", lambda x: F.array_contains(x["functions"], function))
        return F.array_min(
            F.transform(
                carriers,
                lambda x: F.struct(
                    (-x["level"]).alias("rank"), x["src"].alias("src"),
                    x["first"].alias("first"), x["functions"].alias("functions"),
                ),
            )
        )

    def pick(function: Column) -> Column:
        return F.struct(function.alias("function"), best_hit(function).alias("best"))

    def kept_pick(p: Column) -> Column:
        first = p["best"]["first"]
        fields = {f: first[f] for f in KEPT_HIT_FIELDS if f not in ("bitscore", "functions")}
        fields["bitscore"] = -p["best"]["rank"]
        fields["functions"] = p["best"]["functions"]
        if move_hits:
            fields["q_start"], fields["q_end"] = F.col("r_start"), F.col("r_end")
        return F.struct(*[fields[f].alias(f) for f in KEPT_HIT_FIELDS])

    supporting = F.filter("chosen", lambda x: F.arrays_overlap(x["functions"], "selected"))

    def ends(field: str, pick_end: Callable[[Column], Column]) -> Column:
        return pick_end(F.transform(supporting, lambda x: x[field])).alias(field)

    decided = (
        grouped.withColumn("known", known)
        .withColumn("seen", F.exists("levels", lambda x: x["src"] == 0))
        .withColumn("best", F.array_max(F.transform(found, lambda x: x["level"])))
        .withColumn(
            "chosen",
            F.when(F.col("best") > 0, chosen).otherwise(F.slice("levels", 1, 0)),
        )
        .withColumn("total", total)
        .withColumn("selected", F.filter(names, lambda f: votes_for(f) * 2 > F.col("total")))
        .withColumn(
            "status",
            F.when(~F.col("seen"), CANDIDATE)
            .when((F.size("selected") > 0) & ~F.array_contains("selected", ""), GOOD)
            .otherwise(BAD),
        )
        .withColumn(
            "picks",
            F.when(F.col("status") == GOOD, F.transform("selected", pick)),
        )
    )
    known_hit = F.struct(*[
        (F.col("known.level") if f == "bitscore"
         else F.col("known.functions") if f == "functions"
         else F.col(f"known.first.{f}")).alias(f)
        for f in KEPT_HIT_FIELDS
    ])
    return decided.select(
        _LEAD, *keys, "region_no", "r_start", "r_end", "status",
        F.transform(
            "picks",
            lambda p: F.struct(
                p["function"].alias("function"),
                score(p["best"]["first"]["s_len"]).alias("score"),
            ),
        ).alias("scores"),
        F.array_distinct(F.transform("picks", kept_pick)).alias("new_hits"),
        known_hit.alias("known_hit"),
        F.when(
            F.col("status") == GOOD,
            F.struct(ends("lowest", F.array_min), ends("highest", F.array_max)),
        ).alias("lca"),
    )


def _assemble_queries(decided: DataFrame, keys: Sequence[str], keep_good: bool) -> DataFrame:
    """Regions of a query to its status, function scores, ends of its lineages and hits."""
    fields = ["region_no", "status", "scores", "new_hits", "known_hit", "lca"]
    grouped = decided.groupBy(_LEAD, *keys).agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("regions")
    )
    processed = F.filter("regions", lambda r: r["status"] != CANDIDATE)
    good = F.filter("regions", lambda r: r["status"] == GOOD)
    last = F.coalesce(F.try_element_at(processed, F.lit(-1))["status"], F.lit(CANDIDATE))
    status = F.when(F.size("good") > 0, GOOD).otherwise(last) if keep_good else last
    scores = F.flatten(F.transform("good", lambda r: r["scores"]))
    names = F.array_distinct(F.transform("scores", lambda s: s["function"]))

    def total(function: Column) -> Column:
        mine = F.filter("scores", lambda s: s["function"] == function)
        return F.aggregate(mine, F.lit(0.0), lambda acc, s: acc + s["score"])

    listed = F.concat(
        F.transform(
            F.filter("regions", lambda r: r["status"] != GOOD), lambda r: r["known_hit"]
        ),
        F.flatten(F.transform("good", lambda r: r["new_hits"])),
    )
    first_of_kind = F.filter(
        "listed",
        lambda h, i: ~F.exists(
            F.slice("listed", F.lit(1), i),
            lambda o: (o["subject_id"] == h["subject_id"])
            & (o["q_start"] == h["q_start"]) & (o["q_end"] == h["q_end"]),
        ),
    )
    lca = F.try_element_at("good", F.lit(-1))["lca"]
    return (
        grouped.withColumn("good", good)
        .withColumn("scores", scores)
        .withColumn("listed", listed)
        .select(
            *keys,
            status.alias("status"),
            F.map_from_entries(
                F.transform(names, lambda f: F.struct(f, total(f)))
            ).alias("functions"),
            (F.size("good") > 0).alias("has_good"),
            *[lca[part].alias(part) for part in _LCA],
            first_of_kind.alias("hits"),
        )
    )


def _with_taxonomy(assembled: DataFrame, keys: Sequence[str], nodes: DataFrame) -> DataFrame:
    """``nodes`` (tour, trail) finds the taxon that two numbers have in common."""
    return with_lca(assembled, nodes, "taxon").select(
        *keys, "status", "functions",
        F.when(F.col("has_good"), F.col("taxon")).alias("taxonomy"), "hits",
    )


def _nodes(proteins: DataFrame, taxa: DataFrame | None) -> DataFrame:
    return lineage_nodes(proteins) if taxa is None else taxa.select("tour", "trail")


def classify_reads(
    candidates: DataFrame, background: DataFrame, proteins: DataFrame,
    read_lengths: DataFrame, params: RunParams, keys: Sequence[str], taxa: DataFrame | None = None,
) -> DataFrame:
    """Status, ERPK per function, taxon and hits of every candidate read.

    ``read_lengths`` has one average read length per (sample, end). Without ``taxa``, LCAs are looked up
    among the lineages of the catalogue's proteins.
    """
    queries = _per_query(
        candidate_regions(candidates, keys), background, proteins, params, keys,
        lambda s_len: effective_per_kilobase(s_len, F.col("read_length"), params.length_cutoff),
        True, lambda decided: _assemble_queries(decided, keys, False), read_lengths,
    )
    return _with_taxonomy(queries, keys, _nodes(proteins, taxa))


def decide_regions(
    candidates: DataFrame, background: DataFrame, proteins: DataFrame, params: RunParams,
    keys: Sequence[str],
) -> DataFrame:
    """Status of every region on its own, before a read takes that of its last one."""
    return _per_query(
        candidate_regions(candidates, keys), background, proteins, params, keys, lambda _: F.lit(1.0),
        False, lambda decided: decided.select(*keys, "region_no", "r_start", "r_end", "status"),
    )


def classify_by_coverage(
    candidates: DataFrame, background: DataFrame, proteins: DataFrame,
    abundance: DataFrame, params: RunParams, keys: Sequence[str], keep_good: bool,
    taxa: DataFrame | None = None,
) -> DataFrame:
    """Proteins and genes: every region adds the relative abundance of the query's contig.

    ``abundance`` has ``keys`` and ``abundance``. A gene that was good once stays good
    (``keep_good``); a protein follows its last region.
    """
    assembled = _per_query(
        candidate_regions(candidates, keys), background, proteins, params, keys, lambda _: F.lit(1.0),
        False, lambda decided: _assemble_queries(decided, keys, keep_good),
    )
    queries = _with_taxonomy(assembled, keys, _nodes(proteins, taxa))
    scaled = F.transform_values("functions", lambda _, v: v * F.col("abundance"))
    return (
        queries.join(abundance, list(keys), "left")
        .withColumn("functions", scaled)
        .drop("abundance")
    )
