"""Queries on classified reads, proteins and genes, and on their score cubes."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.adapters import READ_KEYS, Domain
from readloom.operators import cubes, samples, stats
from readloom.operators.catalogue import annotate
from readloom.operators.classify import decide_regions
from readloom.operators.hits import filter_by_length
from readloom.params import GOOD
from readloom.registry.core import query
from readloom.session import sorted_groups, written

_K = 'sample_id, "end", read_id'


def flat_annotation(annotated: DataFrame, keys: list[str]) -> DataFrame:
    """Annotated queries with their maps and arrays written out as text."""
    functions = F.array_sort(F.map_keys("functions"))
    hits = F.transform(
        "hits",
        lambda h: F.concat_ws(
            ":", h["subject_id"], h["q_start"].cast("string"), h["q_end"].cast("string")
        ),
    )
    total = F.aggregate(F.map_values("functions"), F.lit(0.0), lambda acc, v: acc + v)
    return annotated.select(
        *keys, "status", F.coalesce("taxonomy", F.lit("")).alias("taxonomy"),
        F.array_join(functions, ",").alias("functions"), total.alias("score"),
        F.array_join(hits, ",").alias("hits"),
    )


def flat_sql(p: str, keys: str = _K) -> str:
    return f"""
SELECT {keys}, status, coalesce(taxonomy, '') AS taxonomy, coalesce(f.functions, '') AS functions,
  round(coalesce(f.score, 0.0), 6) AS score, h.hits
FROM {p}_ann
LEFT JOIN (SELECT {_K}, string_agg(function, ',' ORDER BY function) AS functions,
  sum(score) AS score FROM {p}_fn GROUP BY {_K}) f USING ({_K})
LEFT JOIN (SELECT {_K}, string_agg(subject_id || ':' || q_start || ':' || q_end, ','
  ORDER BY hit_no) AS hits FROM {p}_hits GROUP BY {_K}) h USING ({_K})"""


@query("classify_reads", flat_sql("rd"))
def _(d: Domain) -> DataFrame:
    return flat_annotation(d.classified_reads(), READ_KEYS)


@query("classify_proteins", flat_sql("pr"))
def _(d: Domain) -> DataFrame:
    return flat_annotation(d.classified_proteins(), READ_KEYS)


@query("classify_genes", flat_sql("gn", "read_id AS gene_id"))
def _(d: Domain) -> DataFrame:
    with sorted_groups(d.spark):
        annotated = written(d.classified_genes())
    return flat_annotation(annotated, ["gene_id"])


@query("function_vote", f"""
SELECT {_K}, function, votes, n AS hits FROM (
  SELECT {_K}, function, count(*) AS votes FROM (
    SELECT {_K}, unnest(coalesce(p.functions, [''])) AS function FROM bg_hits h
    LEFT JOIN proteins p ON p.protein_id = h.subject_id WHERE h.length >= 15) GROUP BY ALL)
JOIN (SELECT {_K}, count(*) AS n FROM bg_hits WHERE length >= 15 GROUP BY ALL) USING ({_K})
WHERE 2 * votes > n""")
def _(d: Domain) -> DataFrame:
    selected = annotate(
        filter_by_length(d.background_rows, d.params.length_cutoff), d.protein_catalogue, d.params
    )
    # A marker row per hit carries the number of hits through the same aggregation.
    marked = F.concat(F.array(F.lit(None).cast("string")), "functions")
    counts = selected.select(*READ_KEYS, F.explode(marked).alias("function")).groupBy(
        *READ_KEYS, "function"
    ).agg(F.count("*").alias("votes"))
    votes = F.collect_list(
        F.when(F.col("function").isNotNull(), F.struct("function", "votes"))
    )
    per_query = counts.groupBy(*READ_KEYS).agg(
        F.max(F.when(F.col("function").isNull(), F.col("votes"))).alias("hits"),
        votes.alias("found"),
    )
    winners = F.filter("found", lambda v: v["votes"] * 2 > F.col("hits"))
    return per_query.select(*READ_KEYS, F.inline(winners), "hits")


@query("function_best_hit", f"""
SELECT {_K}, function, subject_id, bitscore FROM (
  SELECT *, row_number() OVER (PARTITION BY {_K}, function
    ORDER BY bitscore DESC, ord, subject_id, q_start, q_end) AS n
  FROM (SELECT h.*, unnest(coalesce(p.functions, [''])) AS function FROM bg_hits h
    LEFT JOIN proteins p ON p.protein_id = h.subject_id)) WHERE n = 1""")
def _(d: Domain) -> DataFrame:
    listed = annotate(d.background_rows, d.protein_catalogue, d.params).withColumn(
        "function", F.explode("functions")
    )
    ranked = F.struct((-F.col("bitscore")).alias("rank"), "ord", "subject_id", "q_start", "q_end")
    return listed.groupBy(*READ_KEYS, "function").agg(F.min(ranked).alias("best")).select(
        *READ_KEYS, "function", "best.subject_id", (-F.col("best.rank")).alias("bitscore")
    )


@query("last_region_status", f"""
SELECT {_K}, a.status, coalesce(a.taxonomy, '') AS taxonomy, count(*) AS regions,
  count(*) FILTER (r.status = 'function') AS good_regions
FROM rd_ann a JOIN rd_region r USING ({_K}) GROUP BY ALL""")
def _(d: Domain) -> DataFrame:
    decided = decide_regions(
        d.candidates, d.background_hits, d.protein_catalogue, d.params, READ_KEYS
    )
    counts = decided.groupBy(*READ_KEYS).agg(
        F.count("*").alias("regions"), F.count_if(F.col("status") == GOOD).alias("good_regions")
    )
    return d.annotated.select(
        *READ_KEYS, "status", F.coalesce("taxonomy", F.lit("")).alias("taxonomy")
    ).join(counts, READ_KEYS)


@query("read_functions_sum", f"SELECT {_K}, function, round(score, 6) AS score FROM rd_fn")
def _(d: Domain) -> DataFrame:
    return d.annotated.select(*READ_KEYS, F.explode("functions").alias("function", "score"))


# Samples -------------------------------------------------------------------------------------

@query("library_stats", """
SELECT doc_id % 5 AS library, "end", count(*) AS reads, CAST(sum(length(sequence)) AS BIGINT) AS bases,
  round(sum(length(sequence)) / count(*), 6) AS avg_length FROM read_texts GROUP BY ALL""")
def _(d: Domain) -> DataFrame:
    reads = d.read_texts.withColumn("library", F.col("doc_id") % 5)
    return samples.library_stats(reads, ["library", "end"])


@query("norm_factors", """
SELECT sample_id, round(1e6 / fwd_reads, 6) AS per_million,
  round(genome_size / fwd_bases, 6) AS per_genome FROM samples""")
def _(d: Domain) -> DataFrame:
    return samples.normalisation_factors(d.samples).select(
        "sample_id", "per_million", "per_genome"
    )


@query("mixed_library_guard", """
SELECT sample_id, true AS is_paired_end, 'efpkg' AS metric FROM samples""")
def _(d: Domain) -> DataFrame:
    paired = cubes.library_is_paired(d.samples)
    return d.samples.select(
        "sample_id", F.lit(paired).alias("is_paired_end"),
        F.lit(cubes.choose_metric(d.samples)).alias("metric"),
    )


_METRIC_ROWS = """(SELECT * FROM (VALUES
  ('paired', 'fragmentcount'), ('paired', 'fpk'), ('paired', 'efpk'), ('paired', 'fpkm'), ('paired', 'efpkm'),
  ('paired', 'fpkg'), ('paired', 'efpkg'), ('single', 'readcount'), ('single', 'proteincount'),
  ('single', 'erpk'), ('single', 'erpkm'), ('single', 'erpkg')) v(kind, metric) CROSS JOIN (SELECT unnest(['function', 'taxon']) AS cube)
  UNION ALL SELECT * FROM (VALUES ('single', 'rpkm', 'taxon'), ('single', 'rpkg', 'taxon')) v(kind, metric, cube))"""


@query("metric_select", f"""
SELECT sizes, kind, cube, metric, s.sample_id,
  round(CASE WHEN metric LIKE '%m' THEN 1e6 / fwd_reads WHEN metric LIKE '%g'
    THEN CASE WHEN sizes = 'all' OR sample_id <> 'S2' THEN genome_size / fwd_bases ELSE 0.0 END ELSE 1.0 END, 6) AS factor,
  CASE WHEN sizes = 'all' OR metric NOT LIKE '%g' THEN metric
    WHEN kind = 'paired' THEN 'fragmentcount' ELSE 'readcount' END AS reported
FROM samples s CROSS JOIN {_METRIC_ROWS} CROSS JOIN (SELECT unnest(['all', 'one missing']) AS sizes)""")
def _(d: Domain) -> DataFrame:
    """Every metric of both kinds of library and both cubes; the second time a genome size is missing."""
    one_missing = F.when(F.col("sample_id") == "S2", 0.0).otherwise(F.col("genome_size"))
    known, partly = d.samples, d.samples.withColumn("genome_size", one_missing)
    return cubes.metric_choices(known).withColumn("sizes", F.lit("all")).unionByName(
        cubes.metric_choices(partly).withColumn("sizes", F.lit("one missing")))


# Fragments -----------------------------------------------------------------------------------

_FRAG = f"""
SELECT coalesce(a.sample_id, b.sample_id) AS sample_id, coalesce(a.read_id, b.read_id) AS read_id,
  a.status = 'function' AND b.status = 'function' AS is_both,
  CASE WHEN a.status = 'function' AND b.status = 'function' THEN 'both'
    WHEN a.status = 'function' THEN 'pe1' ELSE 'pe2' END AS kind,
  a.taxonomy AS t1, b.taxonomy AS t2
FROM (SELECT * FROM rd_ann WHERE "end" = 'pe1') a
FULL JOIN (SELECT * FROM rd_ann WHERE "end" = 'pe2') b
  ON a.sample_id = b.sample_id AND a.read_id = b.read_id
WHERE (a.status = 'function' AND (b.status = 'function' OR b.read_id IS NULL))
  OR (b.status = 'function' AND (a.status IS NULL OR a.status <> 'function'))
"""
_PAIR_LCA_MEMBERS = "(SELECT sample_id, read_id, unnest([t1, t2]) AS taxid FROM frag WHERE kind = 'both')"


def _register_fragment_views() -> None:
    from readloom.registry.views import VIEWS, lca_sql
    VIEWS["frag"] = _FRAG
    VIEWS["frag_lca"] = lca_sql(_PAIR_LCA_MEMBERS, "sample_id, read_id")
    VIEWS["frag_taxon"] = """
SELECT f.*, CASE kind WHEN 'pe1' THEN t1 WHEN 'pe2' THEN t2 ELSE l.lca END AS taxonomy
FROM frag f LEFT JOIN frag_lca l USING (sample_id, read_id)
"""
    VIEWS["frag_hits"] = """
SELECT f.sample_id, f.read_id, h."end", h.hit_no, h.subject_id, h.identity, h.s_len, h.bitscore,
  h.s_start, h.s_end, h.functions
FROM frag f JOIN rd_hits h ON h.sample_id = f.sample_id AND h.read_id = f.read_id
  AND (f.kind = 'both' OR h."end" = f.kind)
"""
    VIEWS["frag_fn"] = """
SELECT x.sample_id, x.read_id, x.function, h.identity, h.s_len, h.bitscore IS NOT NULL AS found
FROM (SELECT DISTINCT f.sample_id, f.read_id, n.function FROM frag f JOIN rd_fn n
    ON n.sample_id = f.sample_id AND n.read_id = f.read_id
    AND (f.kind = 'both' OR n."end" = f.kind)) x
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY sample_id, read_id, function
      ORDER BY bitscore DESC, "end", hit_no) AS n
    FROM (SELECT *, unnest(functions) AS function FROM frag_hits)) h
  ON h.sample_id = x.sample_id AND h.read_id = x.read_id AND h.function = x.function AND h.n = 1
"""
    VIEWS["subject_pairs"] = """
SELECT sample_id, read_id, tlen, 3 * s_len AS ref_len, subject_id AS ref_name
FROM (SELECT *, row_number() OVER (PARTITION BY sample_id, read_id ORDER BY hit_no DESC) AS last
  FROM (SELECT a.sample_id, a.read_id, a.hit_no, a.subject_id, a.s_len,
      3 * greatest(a.s_end - b.s_start, b.s_end - a.s_start) AS tlen,
      row_number() OVER (PARTITION BY a.sample_id, a.read_id, a.hit_no ORDER BY b.hit_no) AS first
    FROM frag_hits a JOIN frag_hits b ON a.sample_id = b.sample_id AND a.read_id = b.read_id
      AND a."end" = 'pe1' AND b."end" = 'pe2' AND a.subject_id = b.subject_id
    WHERE a.s_len * 3 >= 150 AND a.s_end - a.s_start >= 15 AND b.s_end - b.s_start >= 15)
  WHERE first = 1 AND tlen > 45)
WHERE last = 1
"""
    VIEWS["insert_sizes"] = """
SELECT s.sample_id, CASE WHEN s.insert_size = 0 THEN CASE WHEN p.n > 1 THEN p.mean ELSE 0.0 END
  ELSE s.insert_size END AS insert_size,
  CASE WHEN s.insert_size = 0 THEN coalesce(p.n, 0) ELSE 0 END AS pairs
FROM samples s LEFT JOIN (SELECT sample_id, count(*) AS n, avg(tlen) AS mean FROM subject_pairs
  GROUP BY sample_id) p USING (sample_id)
"""
    VIEWS["coarse_pairs"] = VIEWS["subject_pairs"].replace(
        "frag_hits a", "coarse_hits a").replace("frag_hits b", "coarse_hits b")
    VIEWS["coarse_hits"] = """
SELECT * REPLACE (right(subject_id, 1) AS subject_id) FROM frag_hits
"""
    VIEWS["coarse_sizes"] = VIEWS["insert_sizes"].replace("subject_pairs", "coarse_pairs")
    # Raw (unscaled) values of every paired-end metric per fragment and function.
    VIEWS["frag_values"] = """
SELECT *, 1000.0::DOUBLE / 3 / s_len AS fpk, CASE WHEN e > 0 THEN 1000.0::DOUBLE / e ELSE 1000.0 END AS efpk
FROM (SELECT f.*, t.taxonomy, CASE WHEN insert_size > 300 + s_len THEN 2 * (3 * s_len - 90 + 150 + 1)
    ELSE 3 * s_len - 90 + insert_size + 1 END AS e
  FROM frag_fn f JOIN insert_sizes USING (sample_id) JOIN frag_taxon t USING (sample_id, read_id))
"""
    _register_good_views(VIEWS)


def _register_good_views(views: dict[str, str]) -> None:
    """The same views where only good reads are handed on, as a pipeline does with its own reads."""
    names = ["frag", "frag_lca", "frag_taxon", "frag_hits", "frag_fn", "subject_pairs",
             "insert_sizes", "frag_values"]
    word = re.compile(rf"\b({'|'.join(names)})\b")
    for name in names:
        text = word.sub(r"good_\1", views[name])
        if name == "frag":
            text = text.replace("rd_ann", "good_ann")
        views[f"good_{name}"] = text
    views["good_ann"] = "SELECT * FROM rd_ann WHERE status = 'function'"


_register_fragment_views()


@query("fragment_join", """
SELECT f.sample_id, f.read_id, coalesce(is_both, false) AS is_both, n.n_functions, h.n_hits
FROM frag f
JOIN (SELECT sample_id, read_id, count(*) AS n_functions FROM frag_fn GROUP BY ALL) n USING (sample_id, read_id)
JOIN (SELECT sample_id, read_id, count(*) AS n_hits FROM frag_hits GROUP BY ALL) h USING (sample_id, read_id)
""")
def _(d: Domain) -> DataFrame:
    return cubes.fragments(d.annotated).select(
        "sample_id", "read_id", F.col("both").alias("is_both"),
        F.size("functions").cast("bigint").alias("n_functions"),
        F.size("hits").cast("bigint").alias("n_hits"),
    )


@query("fragment_functions", """
SELECT sample_id, read_id, string_agg(function, ',' ORDER BY function) AS functions
FROM frag_fn GROUP BY ALL""")
def _(d: Domain) -> DataFrame:
    listed = F.array_join(F.array_sort("functions"), ",")
    return cubes.fragments(d.annotated).select("sample_id", "read_id", listed.alias("functions"))


@query("ends_union", """
SELECT sample_id, kind, count(*) AS fragments FROM frag GROUP BY ALL""")
def _(d: Domain) -> DataFrame:
    good = d.annotated.where(F.col("status") == GOOD)
    end = lambda table, e: table.where(F.col("end") == e).select("sample_id", "read_id")
    first, second = end(good, "pe1"), end(good, "pe2")
    known_second = end(d.annotated, "pe2")
    keys = ["sample_id", "read_id"]
    kinds = {
        "both": first.join(second, keys, "left_semi"),
        "pe1": first.join(known_second, keys, "left_anti"),
        "pe2": second.join(first, keys, "left_anti"),
    }
    counted = None
    for kind, rows in kinds.items():
        rows = rows.withColumn("kind", F.lit(kind))
        counted = rows if counted is None else counted.unionByName(rows)
    return counted.groupBy("sample_id", "kind").agg(F.count("*").alias("fragments"))


def coarse_subjects(annotated: DataFrame) -> DataFrame:
    """Subjects by their last digit: the source tables hardly ever give both ends one protein."""
    return annotated.withColumn(
        "hits",
        F.transform(
            "hits", lambda h: h.withField("subject_id", F.substring(h["subject_id"], -1, 1))
        ),
    )


@query("shared_subject_pairs", """
SELECT sample_id, read_id, tlen, ref_len, ref_name FROM coarse_pairs""")
def _(d: Domain) -> DataFrame:
    return cubes.shared_subject_pairs(
        coarse_subjects(d.annotated), d.samples, d.params.length_cutoff
    )


@query("insert_size", """
SELECT sample_id, round(insert_size, 6) AS insert_size, pairs FROM coarse_sizes""")
def _(d: Domain) -> DataFrame:
    return cubes.insert_sizes(coarse_subjects(d.annotated), d.samples, d.params)


# Cubes ---------------------------------------------------------------------------------------

_SINGLE = {
    "readcount": "count(*)", "proteincount": "count(*)", "erpk": "sum(score)",
    "erpkm": "sum(score) * 1e6 / any_value(fwd_reads)",
    "erpkg": "sum(score) * any_value(genome_size) / any_value(fwd_bases)",
}


def _single_sql(metric: str, by_taxon: bool, p: str = "rd") -> str:
    taxon = "taxonomy, " if by_taxon else ""
    return f"""
SELECT {taxon}function, sample_id, '{metric}' AS metric,
  round({_SINGLE[metric.replace('rpk', 'erpk') if metric[0] == 'r' and metric != 'readcount' else metric]}::DOUBLE, 6) AS score,
  count(*) AS count, count(bitscore) AS hit_count, round(coalesce(sum(identity), 0.0), 6) AS identity
FROM {p}_fbest JOIN {p}_ann USING ({_K}) JOIN samples USING (sample_id)
WHERE status = 'function' AND "end" = 'pe1' GROUP BY {taxon}function, sample_id"""


@query("function_scores_single", " UNION ALL ".join(
    _single_sql(m, False) for m in cubes.SINGLE_END_METRICS))
def _(d: Domain) -> DataFrame:
    return cubes.single_end_metrics(
        d.annotated, d.single_samples, list(cubes.SINGLE_END_METRICS)
    )


@query("taxon_function_scores_single", " UNION ALL ".join(
    _single_sql(m, True) for m in [*cubes.SINGLE_END_METRICS, *cubes.TAXON_ONLY_METRICS]))
def _(d: Domain) -> DataFrame:
    return cubes.single_end_metrics(
        d.annotated, d.single_samples, [*cubes.SINGLE_END_METRICS, *cubes.TAXON_ONLY_METRICS],
        by_taxon=True,
    )


@query("protein_function_scores", _single_sql("proteincount", False, "pr"))
def _(d: Domain) -> DataFrame:
    return cubes.single_end_metrics(
        d.annotated_proteins, d.protein_samples, ["proteincount"]
    )


_PAIRED = {
    "fragmentcount": "count(*) FILTER (found)", "fpk": "sum(fpk)", "efpk": "sum(efpk)",
    "fpkm": "sum(fpk) * 1e6 / any_value(fwd_reads)",
    "efpkm": "sum(efpk) * 1e6 / any_value(fwd_reads)",
    "fpkg": "sum(fpk) * any_value(genome_size) / any_value(fwd_bases)",
    "efpkg": "sum(efpk) * any_value(genome_size) / any_value(fwd_bases)",
}


def paired_sql(metric: str, by_taxon: bool, rounding: bool = True, values: str = "frag_values") -> str:
    taxon = "taxonomy, " if by_taxon else ""
    only = "WHERE found" if by_taxon else ""
    r = (lambda x: f"round({x}, 6)") if rounding else (lambda x: x)
    return f"""
SELECT {taxon}function, sample_id, '{metric}' AS metric,
  {r(f"({_PAIRED[metric]})::DOUBLE")} AS score, count(*) AS count,
  count(*) FILTER (found) AS hit_count, {r("coalesce(sum(identity), 0.0)")} AS identity
FROM {values} JOIN samples USING (sample_id) {only} GROUP BY {taxon}function, sample_id"""


@query("function_scores_paired", " UNION ALL ".join(
    paired_sql(m, False) for m in cubes.PAIRED_END_METRICS))
def _(d: Domain) -> DataFrame:
    return cubes.paired_end_metrics(
        cubes.fragment_functions(d.annotated), d.annotated, d.samples,
        list(cubes.PAIRED_END_METRICS), d.params,
    )


@query("taxon_function_scores_paired", " UNION ALL ".join(
    paired_sql(m, True) for m in cubes.PAIRED_END_METRICS))
def _(d: Domain) -> DataFrame:
    return cubes.paired_end_metrics(
        cubes.fragment_functions(d.annotated, d.taxa), d.annotated, d.samples,
        list(cubes.PAIRED_END_METRICS), d.params, by_taxon=True,
    )


@query("scores_slice", f"""
SELECT taxonomy, function, score, count, hit_count, identity FROM ({paired_sql('efpkg', True)})
WHERE sample_id = 'S3'""")
def _(d: Domain) -> DataFrame:
    cube = cubes.paired_end_scores(d.annotated, d.samples, "efpkg", d.params, d.taxa)
    return cube.where(F.col("sample_id") == "S3").drop("sample_id")


# Statistics ----------------------------------------------------------------------------------

@query("status_counts", """
SELECT sample_id, "end", status, count(*) AS reads FROM rd_ann GROUP BY ALL""")
def _(d: Domain) -> DataFrame:
    return stats.status_counts(d.annotated).orderBy("sample_id", "end", F.col("reads").desc())


_GOOD = f"(SELECT * FROM rd_ann WHERE status = 'function')"
_FN_ROWS = f"""(SELECT g.sample_id, g."end", g.read_id, f.function, f.score,
  1.0::DOUBLE / count(*) OVER (PARTITION BY g.sample_id, g."end", g.read_id) AS share
  FROM {_GOOD} g JOIN rd_fn f USING ({_K}))"""
_HIT_ROWS = f"""(SELECT h.sample_id, h."end", h.read_id, unnest(h.functions) AS function, h.identity
  FROM {_GOOD} g JOIN rd_hits h USING ({_K}))"""


@query("function_stats", f"""
SELECT sample_id, "end", function, round(score, 6) AS score, round(read_count, 6) AS read_count,
  round(coalesce(avg_identity, 0.0), 6) AS avg_identity
FROM (SELECT sample_id, "end", function, sum(score) AS score, sum(share) AS read_count
  FROM {_FN_ROWS} GROUP BY ALL)
LEFT JOIN (SELECT sample_id, "end", function, avg(identity) AS avg_identity
  FROM {_HIT_ROWS} GROUP BY ALL) USING (sample_id, "end", function)""")
def _(d: Domain) -> DataFrame:
    return stats.function_stats(d.annotated)


@query("group_stats", f"""
SELECT sample_id, "end", grp AS "group", round(score, 6) AS score, round(read_count, 6) AS read_count,
  round(coalesce(avg_identity, 0.0), 6) AS avg_identity
FROM (SELECT sample_id, "end", coalesce(grp, '') AS grp, sum(score) AS score, sum(share) AS read_count
  FROM {_FN_ROWS} LEFT JOIN functions USING (function) GROUP BY ALL)
LEFT JOIN (SELECT sample_id, "end", coalesce(grp, '') AS grp, avg(identity) AS avg_identity
  FROM {_HIT_ROWS} LEFT JOIN functions USING (function) GROUP BY ALL) USING (sample_id, "end", grp)""")
def _(d: Domain) -> DataFrame:
    return stats.group_stats(d.annotated, d.function_catalogue)


@query("distinct_reads_by_group", f"""
SELECT f.sample_id, f."end", f.level, f.grp AS "group", f.function, f.reads, round(f.score, 6) AS score,
  round(coalesce(h.avg_identity, 0.0), 6) AS avg_identity
FROM (SELECT sample_id, "end", CASE WHEN grouping(function) = 0 THEN 'function' ELSE 'group' END AS level,
    grp, coalesce(function, '') AS function, count(DISTINCT read_id) AS reads, sum(score) AS score
  FROM {_FN_ROWS} JOIN functions USING (function)
  GROUP BY GROUPING SETS ((sample_id, "end", grp, function), (sample_id, "end", grp))) f
LEFT JOIN (SELECT sample_id, "end", grp, coalesce(function, '') AS function, avg(identity) AS avg_identity
  FROM {_HIT_ROWS} JOIN functions USING (function)
  GROUP BY GROUPING SETS ((sample_id, "end", grp, function), (sample_id, "end", grp))) h
  ON h.sample_id = f.sample_id AND h."end" = f."end" AND h.grp = f.grp AND h.function = f.function""")
def _(d: Domain) -> DataFrame:
    return stats.group_read_counts(d.annotated, d.function_catalogue)


_RANK_STATS = f"""(SELECT sample_id, "end", rank, name, sum(reads) AS reads, sum(score) AS score,
  sum(identity) / sum(reads) AS avg_identity
FROM (SELECT t.*, x.rank, x.name FROM (
    SELECT g.sample_id, g."end", g.taxonomy, count(*) AS reads, sum(s.score) AS score,
      sum(h.identity) AS identity
    FROM {_GOOD} g
    JOIN (SELECT {_K}, sum(score) AS score FROM rd_fn GROUP BY ALL) s USING ({_K})
    JOIN (SELECT {_K}, sum(identity) AS identity FROM rd_hits GROUP BY ALL) h USING ({_K})
    GROUP BY ALL) t
  JOIN (SELECT '0' AS taxid, 'superkingdom' AS rank, 'Unknown' AS name
    UNION ALL SELECT taxid, 'superkingdom', 'Non-cellular' FROM anc GROUP BY taxid
      HAVING NOT bool_or(anc = '131567') AND taxid <> '0'
    UNION ALL SELECT taxid, anc_rank, anc_name FROM anc WHERE ranked AND anc <> '1'
      AND taxid IN (SELECT taxid FROM anc WHERE anc = '131567')) x ON x.taxid = t.taxonomy)
GROUP BY ALL)"""


@query("rank_stats", f"""
SELECT sample_id, "end", rank, name, CAST(reads AS BIGINT) AS reads, round(score, 6) AS score,
  round(avg_identity, 6) AS avg_identity FROM {_RANK_STATS}""")
def _(d: Domain) -> DataFrame:
    return stats.rank_stats(d.annotated, d.taxa)


@query("top_taxa_per_rank", f"""
SELECT sample_id, "end", rank, name, place, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY sample_id, "end", rank ORDER BY CAST(printf('%.11e', score) AS DOUBLE) DESC, name) AS place
  FROM {_RANK_STATS}) WHERE place <= {stats.TOP_TAXA}""")
def _(d: Domain) -> DataFrame:
    return stats.top_taxa(stats.rank_stats(d.annotated, d.taxa)).select(
        "sample_id", "end", "rank", "name", F.col("place").cast("bigint").alias("place"), "score"
    )


@query("taxa_by_count", f"""
SELECT sample_id, "end", rank, name, CAST(reads AS BIGINT) AS reads FROM {_RANK_STATS}""")
def _(d: Domain) -> DataFrame:
    table = stats.rank_stats(d.annotated, d.taxa)
    return table.select("sample_id", "end", "rank", "name", "reads").orderBy(
        "sample_id", "end", "rank", F.col("reads").desc(), "name"
    )


def _mapping_sql() -> str:
    out = [
        "count(a.read_id) AS pe1_total", "count(b.read_id) AS pe2_total",
        "count(*) FILTER (a.ok) AS pe1_mapped", "count(*) FILTER (b.ok) AS pe2_mapped",
        "count(*) FILTER (a.ok AND b.ok) AS both_mapped",
        "count(*) FILTER (a.ok AND NOT coalesce(b.ok, false)) AS pe1_only",
        "count(*) FILTER (b.ok AND NOT coalesce(a.ok, false)) AS pe2_only",
    ]
    for n, t in ((1, "a"), (2, "b")):
        for name, condition in {
            "single_function": f"{t}.ok AND {t}.nf = 1",
            "multiple_functions": f"{t}.ok AND {t}.nf > 1",
            "single_hit": f"{t}.ok AND {t}.nh = 1", "multiple_hits": f"{t}.ok AND {t}.nh > 1",
            "multiple_functions_single_hit": f"{t}.ok AND {t}.nf > 1 AND {t}.nh = 1",
            "multiple_functions_multiple_hits": f"{t}.ok AND {t}.nf > 1 AND {t}.nh > 1",
            "single_function_both": f"a.ok AND b.ok AND {t}.nf = 1",
            "multiple_functions_both": f"a.ok AND b.ok AND {t}.nf > 1",
            "single_hit_both": f"a.ok AND b.ok AND {t}.nh = 1",
            "multiple_hits_both": f"a.ok AND b.ok AND {t}.nh > 1",
        }.items():
            out.append(f"count(*) FILTER ({condition}) AS pe{n}_{name}")
    table = f"""(SELECT r.*, status = 'function' AS ok, coalesce(f.nf, 0) AS nf, h.nh FROM rd_ann r
  LEFT JOIN (SELECT {_K}, count(*) AS nf FROM rd_fn GROUP BY ALL) f USING ({_K})
  LEFT JOIN (SELECT {_K}, count(*) AS nh FROM rd_hits GROUP BY ALL) h USING ({_K})
  WHERE "end" = '{{}}')"""
    return f"""SELECT coalesce(a.sample_id, b.sample_id) AS sample_id, {', '.join(out)}
FROM {table.format('pe1')} a FULL JOIN {table.format('pe2')} b
  ON a.sample_id = b.sample_id AND a.read_id = b.read_id
GROUP BY coalesce(a.sample_id, b.sample_id)"""


@query("mapping_qc", _mapping_sql())
def _(d: Domain) -> DataFrame:
    return stats.mapping_quality(d.annotated)


@query("besthit_taxon_profile", f"""
SELECT sample_id, "end", taxid, function, round(sum(score / taxa), 6) AS score,
  round(sum(hits / all_hits::DOUBLE), 6) AS count, CAST(sum(hits) AS BIGINT) AS hit_count,
  round(sum(identity), 6) AS identity
FROM (SELECT *, count(*) OVER (PARTITION BY {_K}, function) AS taxa,
    sum(hits) OVER (PARTITION BY {_K}) AS all_hits
  FROM (SELECT {_K}, f.function, coalesce(p.taxid, '0') AS taxid, f.score, count(*) AS hits,
      sum(h.identity) AS identity
    FROM {_GOOD} g JOIN rd_fn f USING ({_K})
    JOIN (SELECT *, unnest(functions) AS function FROM rd_hits) h USING ({_K}, function)
    LEFT JOIN proteins p ON p.protein_id = h.subject_id GROUP BY ALL))
GROUP BY ALL""")
def _(d: Domain) -> DataFrame:
    return stats.best_hit_taxa(d.annotated, d.proteins)


@query("sorted_reads", """
SELECT sample_id, "end", read_id, status FROM rd_ann""")
def _(d: Domain) -> DataFrame:
    return d.annotated.select(*READ_KEYS, "status").orderBy(*READ_KEYS)
