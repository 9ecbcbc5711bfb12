"""Score cubes: function x sample and taxon x function x sample, single-end and paired-end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions.scores import effective_fragments_per_kilobase, per_kilobase
from readloom.operators.samples import average_read_lengths, normalisation_factors
from readloom.operators.taxonomy import UNKNOWN_TOUR, lca_label
from readloom.params import END1, END2, GOOD, RunParams
from readloom.session import broadcast_if_small

# Metric names and the factor each is scaled by.
SINGLE_END_METRICS = {
    "readcount": "one", "proteincount": "one", "erpk": "one",
    "erpkm": "per_million", "erpkg": "per_genome",
}
# The taxon cube also takes these two names for the effective scores.
TAXON_ONLY_METRICS = {"rpkm": "per_million", "rpkg": "per_genome"}
PAIRED_END_METRICS = {
    "fragmentcount": "one", "fpk": "one", "efpk": "one", "fpkm": "per_million",
    "efpkm": "per_million", "fpkg": "per_genome", "efpkg": "per_genome",
}
_COUNTS = ("readcount", "proteincount", "fragmentcount")


def library_is_paired(samples: DataFrame) -> bool:
    """Whether the project is paired-end; a mix of both kinds is refused."""
    kinds = [row[0] for row in samples.select("is_paired_end").distinct().collect()]
    if not kinds:
        raise ValueError("the project has no samples")
    if len(kinds) > 1:
        raise ValueError("single-end and paired-end samples must be processed apart")
    return bool(kinds[0])


def metric_factor(metric: str, paired: bool, by_taxon: bool) -> str:
    """Name of the factor a metric is scaled by, or an error when it does not apply."""
    allowed = PAIRED_END_METRICS if paired else SINGLE_END_METRICS
    if by_taxon and not paired:
        allowed = {**allowed, **TAXON_ONLY_METRICS}
    if metric not in allowed:
        kind = "paired-end" if paired else "single-end"
        raise ValueError(f"metric {metric!r} does not apply to {kind} samples")
    return allowed[metric]


def choose_metric(samples: DataFrame, metric: str | None = None) -> str:
    """The requested or recommended metric; raw counts when its factor is missing anywhere."""
    paired = library_is_paired(samples)
    chosen = metric or ("efpkg" if paired else "erpkg")
    factor = metric_factor(chosen, paired, by_taxon=True)
    if factor == "one":
        return chosen
    missing = normalisation_factors(samples).where(F.col(factor) == 0)
    if missing.isEmpty():
        return chosen
    return "fragmentcount" if paired else "readcount"


def metric_choices(samples: DataFrame) -> DataFrame:
    """Every metric of both kinds of library and both cubes with each sample's factor (0 if it has none).

    ``reported`` is the metric a project of that kind reports when this one is asked for: raw counts if
    any of its samples lacks the factor.
    """
    listed = [
        (kind, cube, metric, metric_factor(metric, kind == "paired", cube == "taxon"), raw)
        for kind, own, raw in (
            ("paired", PAIRED_END_METRICS, "fragmentcount"), ("single", SINGLE_END_METRICS, "readcount"))
        for cube in ("function", "taxon")
        for metric in [*own, *(TAXON_ONLY_METRICS if (kind, cube) == ("single", "taxon") else [])]
    ]
    metrics = samples.sparkSession.createDataFrame(
        listed, "kind string, cube string, metric string, scaled_by string, raw string")
    factors = normalisation_factors(samples).withColumn("one", F.lit(1.0))
    names = ["one", "per_million", "per_genome"]
    each = factors.select("sample_id", F.inline(F.array(*[
        F.struct(F.lit(n).alias("scaled_by"), F.col(n).cast("double").alias("factor")) for n in names])))
    lacking = each.groupBy("scaled_by").agg(F.bool_or(F.col("factor") == 0).alias("lacking"))
    return each.join(F.broadcast(metrics), "scaled_by").join(lacking, "scaled_by").select(
        "kind", "cube", "metric", "sample_id", "factor",
        F.when(F.col("lacking"), F.col("raw")).otherwise(F.col("metric")).alias("reported"))


def with_metric_factor(samples: DataFrame, factor: str) -> DataFrame:
    """(sample_id, factor); a missing factor is an error."""
    if factor == "one":
        return samples.select("sample_id", F.lit(1.0).alias("factor"))
    value = F.when(F.col(factor) != 0, F.col(factor)).otherwise(
        F.raise_error(F.lit("no normalisation factor for this sample"))
    )
    return normalisation_factors(samples).select("sample_id", value.alias("factor"))


def best_hit_of(function: Column, hits: Column) -> Column:
    """Best hit among those that carry a function, first on ties; null when none does."""
    ranked = F.transform(
        hits,
        lambda h, i: F.struct(
            (-h["bitscore"]).alias("rank"), i.alias("position"), h["identity"].alias("identity"),
            h["s_len"].alias("s_len"), h["functions"].alias("functions"),
        ),
    )
    return F.array_min(F.filter(ranked, lambda h: F.array_contains(h["functions"], function)))


def read_functions(annotated: DataFrame) -> DataFrame:
    """One row per (good read, function) with its score and best hit."""
    entry = F.transform(
        F.map_keys("functions"),
        lambda f: F.struct(
            f.alias("function"), F.try_element_at("functions", f).alias("score"),
            best_hit_of(f, F.col("hits")).alias("best"),
        ),
    )
    return annotated.where(F.col("status") == GOOD).select(
        "sample_id", "end", "read_id", "taxonomy", F.inline(entry)
    )


def _scaled(sums: DataFrame, samples: DataFrame, factors: dict[str, str]) -> DataFrame:
    """Raw sums per sample to the requested metrics, one row per metric.

    Each metric's raw sum is the column of its name without the scaling letter.
    """
    keys = [c for c in ("taxonomy", "function", "sample_id") if c in sums.columns]
    scaled = sums
    for factor in sorted(set(factors.values())):
        known = with_metric_factor(samples, factor).withColumnRenamed("factor", factor)
        scaled = scaled.join(broadcast_if_small(known, samples), "sample_id")
    cells = F.array(*[
        F.struct(
            F.lit(metric).alias("metric"),
            (F.col(_raw_name(metric)) * F.col(factor)).alias("score"),
        )
        for metric, factor in factors.items()
    ])
    return scaled.select(*keys, F.inline(cells), "count", "hit_count", "identity")


def _raw_name(metric: str) -> str:
    if metric in _COUNTS:
        return "reads"
    return "erpk" if metric in TAXON_ONLY_METRICS else metric.rstrip("mg")


def _sums(rows: DataFrame, by_taxon: bool, raw: dict[str, Column]) -> DataFrame:
    """One pass over (read or fragment, function) rows for all raw sums."""
    keys = (["taxonomy"] if by_taxon else []) + ["function", "sample_id"]
    return rows.groupBy(*keys).agg(
        *[F.sum(value).alias(name) for name, value in raw.items()],
        F.count("*").alias("count"),
        F.count_if(F.col("best").isNotNull()).alias("hit_count"),
        F.sum(F.coalesce("best.identity", F.lit(0.0))).alias("identity"),
    )


def single_end_metrics(
    annotated: DataFrame, samples: DataFrame, metrics: Sequence[str], by_taxon: bool = False
) -> DataFrame:
    """Scores, counts, hit counts and summed identity of single-end reads or proteins."""
    factors = {m: metric_factor(m, False, by_taxon) for m in metrics}
    rows = read_functions(annotated.where(F.col("end") == END1))
    raw = {"reads": F.lit(1.0), "erpk": F.col("score")}
    return _scaled(_sums(rows, by_taxon, raw), samples, factors)


def single_end_scores(
    annotated: DataFrame, samples: DataFrame, metric: str, by_taxon: bool = False
) -> DataFrame:
    """The cube of one metric."""
    return single_end_metrics(annotated, samples, [metric], by_taxon).drop("metric")


def fragments(annotated: DataFrame, taxa: DataFrame | None = None) -> DataFrame:
    """Paired ends joined to fragments that count.

    Both ends good: one fragment with the functions of both. First end good and no second end
    known: the first alone. First end good and the second known but not good: not counted.
    Second end good and the first not: the second alone.
    """
    def end(name: str, n: int) -> DataFrame:
        good = F.col("status") == GOOD
        return annotated.where(F.col("end") == name).select(
            "sample_id", "read_id", F.col("status").alias(f"status{n}"),
            F.when(good, F.map_keys("functions")).alias(f"functions{n}"),
            F.when(good, F.col("hits")).alias(f"hits{n}"),
            F.col("taxonomy").alias(f"taxonomy{n}"),
        )

    first = end(END1, 1).where(F.col("status1") == GOOD)
    joined = first.join(end(END2, 2), ["sample_id", "read_id"], "full_outer").where(
        (F.col("status2") == GOOD) | (F.col("status1").isNotNull() & F.col("status2").isNull())
    )
    both = (F.col("status1") == GOOD) & (F.col("status2") == GOOD)
    merged = joined.withColumn("both", F.coalesce(both, F.lit(False)))
    if taxa is not None:
        for n in (1, 2):
            lineage = taxa.select(
                F.col("taxid").alias(f"taxonomy{n}"), F.col("tour").alias(f"tour{n}"),
                F.col("trail").alias(f"trail{n}"),
            )
            merged = merged.join(lineage, f"taxonomy{n}", "left")
        unknown = lambda n: F.coalesce(F.col(f"tour{n}") == UNKNOWN_TOUR, F.lit(True))
        shared = F.when(
            F.col("tour1") <= F.col("tour2"), lca_label(F.col("trail1"), F.col("tour2"))
        ).otherwise(lca_label(F.col("trail2"), F.col("tour1")))
        taxon = (
            F.when(~F.col("both"), F.coalesce("taxonomy1", "taxonomy2"))
            .when(unknown(1), F.col("taxonomy2"))
            .when(unknown(2), F.col("taxonomy1"))
            .otherwise(shared)
        )
        merged = merged.withColumn("taxonomy", taxon)
    only = lambda a, b: F.coalesce(a, b)
    return merged.select(
        "sample_id", "read_id", "both",
        F.when(F.col("both"), F.array_union("functions1", "functions2"))
        .otherwise(only("functions1", "functions2")).alias("functions"),
        F.when(F.col("both"), F.concat("hits1", "hits2"))
        .otherwise(only("hits1", "hits2")).alias("hits"),
        F.when(F.col("both"), F.size("hits1")).alias("hits_of_first"),
        *(["taxonomy"] if taxa is not None else []),
    )


def shared_subject_pairs(
    annotated: DataFrame, samples: DataFrame, min_alignment: int
) -> DataFrame:
    """Fragments whose two ends hit the same protein, with the length they span on it.

    Each hit of the first end takes the first long enough hit of the second end on its subject;
    the last hit of the first end that yields a length decides.
    """
    read_length = average_read_lengths(samples).where(F.col("end") == END1).drop("end")
    pairs = fragments(annotated).where("both").join(read_length, "sample_id")
    first = F.slice("hits", F.lit(1), F.col("hits_of_first"))
    second = F.slice("hits", F.col("hits_of_first") + 1, F.size("hits"))

    def span(h: Column) -> Column:
        return h["s_end"] - h["s_start"]

    def length(h: Column) -> Column:
        partners = F.filter(
            "second",
            lambda o: (o["subject_id"] == h["subject_id"]) & (span(o) >= min_alignment),
        )
        other = F.get(partners, F.lit(0))
        return 3 * F.greatest(h["s_end"] - other["s_start"], other["s_end"] - h["s_start"])

    usable = F.filter(
        "first", lambda h: (h["s_len"] * 3 >= F.col("read_length")) & (span(h) >= min_alignment)
    )
    lengths = F.filter(
        F.transform(
            usable,
            lambda h: F.struct(
                length(h).alias("tlen"), (h["s_len"] * 3).alias("ref_len"),
                h["subject_id"].alias("ref_name"),
            ),
        ),
        lambda x: x["tlen"] > 3 * min_alignment,
    )
    return (
        pairs.withColumn("first", first).withColumn("second", second)
        .withColumn("pair", F.try_element_at(lengths, F.lit(-1)))
        .where(F.col("pair").isNotNull())
        .select("sample_id", "read_id", "pair.*")
    )


def insert_sizes(annotated: DataFrame, samples: DataFrame, params: RunParams) -> DataFrame:
    """Recorded insert sizes; a recorded 0 is replaced by the mean of the shared-subject pairs.

    Only the reads of samples without a record are looked at.
    """
    unknown = samples.where(F.col("is_paired_end") & (F.col("insert_size") == 0))
    reads = annotated.join(
        broadcast_if_small(unknown.select("sample_id"), samples), "sample_id", "left_semi"
    )
    found = shared_subject_pairs(reads, samples, params.length_cutoff)
    means = found.groupBy("sample_id").agg(
        F.count("*").alias("pairs"), F.avg("tlen").alias("mean")
    )
    estimate = F.when(F.col("pairs") > 1, F.col("mean")).otherwise(0.0)
    return samples.select("sample_id", "is_paired_end", "insert_size").join(
        means, "sample_id", "left"
    ).select(
        "sample_id",
        F.when(~F.col("is_paired_end"), F.lit(None).cast("double"))
        .when(F.col("insert_size") == 0, estimate)
        .otherwise(F.col("insert_size"))
        .alias("insert_size"),
        F.coalesce("pairs", F.lit(0)).alias("pairs"),
    )


def fragment_functions(
    annotated: DataFrame, taxa: DataFrame | None = None
) -> DataFrame:
    """One row per (fragment, function) with the best hit over both ends."""
    entry = F.transform(
        "functions",
        lambda f: F.struct(f.alias("function"), best_hit_of(f, F.col("hits")).alias("best")),
    )
    rows = fragments(annotated, taxa)
    taxon = ["taxonomy"] if taxa is not None else []
    return rows.select("sample_id", "read_id", *taxon, F.inline(entry))


def paired_end_metrics(
    rows: DataFrame, annotated: DataFrame, samples: DataFrame, metrics: Sequence[str],
    params: RunParams, by_taxon: bool = False, sizes: DataFrame | None = None,
) -> DataFrame:
    """Scores of fragments under several metrics from one pass over their functions.

    ``rows`` are the fragment functions, with taxa when ``by_taxon``. A function without a
    supporting hit still counts in the function cube, not in the taxon cube. ``sizes`` are the samples'
    insert sizes, if they are known already.
    """
    factors = {m: metric_factor(m, True, by_taxon) for m in metrics}
    found = F.col("best").isNotNull()
    if by_taxon:
        rows = rows.where(found)
    raw = {"reads": F.when(found, 1.0).otherwise(0.0)}
    s_len = F.col("best.s_len")
    if {"fpk", "fpkm", "fpkg"} & set(metrics):
        raw["fpk"] = F.coalesce(per_kilobase(s_len), F.lit(0.0))
    if {"efpk", "efpkm", "efpkg"} & set(metrics):
        lengths = average_read_lengths(samples).where(F.col("end") == END1).drop("end")
        if sizes is None:
            sizes = insert_sizes(annotated, samples, params)
        libraries = lengths.join(sizes.select("sample_id", "insert_size"), "sample_id")
        rows = rows.join(broadcast_if_small(libraries, samples), "sample_id")
        efpk = effective_fragments_per_kilobase(
            s_len, F.col("read_length"), params.length_cutoff, F.col("insert_size")
        )
        raw["efpk"] = F.when(found, efpk).otherwise(0.0)
    return _scaled(_sums(rows, by_taxon, raw), samples, factors)


def paired_end_scores(
    annotated: DataFrame, samples: DataFrame, metric: str, params: RunParams,
    taxa: DataFrame | None = None,
) -> DataFrame:
    """The cube of one metric; with ``taxa`` it also has the fragment's taxon."""
    rows = fragment_functions(annotated, taxa)
    return paired_end_metrics(
        rows, annotated, samples, [metric], params, by_taxon=taxa is not None
    ).drop("metric")
