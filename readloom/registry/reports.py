"""Queries on roll-ups, report tables and hierarchies of reads and proteins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.adapters import Domain
from readloom.operators import cubes, rollup
from readloom.operators.coverage import average_coverage
from readloom.plans import hierarchies, reports
from readloom.registry.core import query
from readloom.registry.reads import paired_sql
from readloom.registry.views import VIEWS

SAMPLES = ["S1", "S2", "S3", "S4", "S5"]
BRANDS = sorted(f"Brand#{k}" for k in range(1, 26))
_K = 'sample_id, "end", read_id'

VIEWS["cube"] = paired_sql("efpkg", True, rounding=False)
VIEWS["fcube"] = paired_sql("efpkg", False, rounding=False)
VIEWS["tree"] = """
SELECT taxid, path, path[len(path) - 1] AS parent FROM (
  SELECT taxid, list(anc ORDER BY distance DESC) AS path FROM anc
  WHERE ranked AND taxid IN (SELECT taxid FROM anc WHERE distance = 0 AND ranked) GROUP BY taxid)
"""
VIEWS["average_cube"] = """
SELECT * FROM cube
UNION ALL SELECT taxonomy, 'Average', sample_id, 'efpkg', sum(score) / (SELECT count(*) FROM functions),
  sum(count), sum(hit_count), sum(identity) FROM cube GROUP BY taxonomy, sample_id
"""


def profile_views(p: str, cube: str, scope: str, key: str, trigger: str,
                  values: tuple[str, ...] = ("score", "count", "hit_count", "identity")) -> None:
    """Views of one kind of profile: ``<p>_prof``, ``<p>_res``, ``<p>_nodes``, ``<p>_lines``."""
    s = f"{scope}, " if scope else ""
    total = ", ".join(f"sum({v}) AS {v}" for v in values)
    VIEWS[f"{p}_prof"] = f"""
SELECT {s}{key}, a.anc AS taxid, a.anc_rank AS rank, a.anc_name AS name, t.path, t.parent, {total}
FROM {cube} c JOIN anc a ON a.taxid = c.taxonomy AND a.ranked JOIN tree t ON t.taxid = a.anc
GROUP BY {s}{key}, a.anc, a.anc_rank, a.anc_name, t.path, t.parent
"""
    VIEWS[f"{p}_kids"] = f"""
SELECT {s}{key}, parent AS taxid, {total} FROM {p}_prof WHERE parent IS NOT NULL
GROUP BY {s}{key}, parent
"""
    VIEWS[f"{p}_sums"] = f"""
SELECT n.*, {', '.join(f'coalesce(k.{v}, 0) AS child_{v}' for v in values)} FROM {p}_prof n
JOIN (SELECT DISTINCT {s}taxid FROM {p}_kids) USING ({s}taxid)
LEFT JOIN {p}_kids k USING ({s}taxid, {key})
"""
    VIEWS[f"{p}_res"] = f"""
SELECT {s}{key}, '~' || taxid AS taxid, r.rank, CASE WHEN taxid = '1' THEN 'Unclassified'
    ELSE 'Unclassified ' || name END AS name, list_append(path, '~' || taxid) AS path,
  taxid AS parent, {', '.join(f'{v} - child_{v} AS {v}' for v in values)}
FROM {p}_sums n JOIN ranks q ON q.rank = n.rank JOIN ranks r ON r.rank_no = q.rank_no + 1
WHERE {trigger} - child_{trigger} > abs({trigger}) * 1e-9
"""
    VIEWS[f"{p}_nodes"] = f"SELECT * FROM {p}_prof UNION ALL BY NAME SELECT * FROM {p}_res"
    part = f"PARTITION BY {scope} " if scope else ""
    VIEWS[f"{p}_lines"] = f"""
SELECT {s}taxid, row_number() OVER ({part}ORDER BY path) AS line
FROM (SELECT DISTINCT {s}taxid, path FROM {p}_nodes)
"""


profile_views("det", "cube", "sample_id", "function", "count")
profile_views("sco", "cube", "sample_id", "function", "score", ("score",))
profile_views("byf", "average_cube", "function", "sample_id", "score", ("score",))


def pivot_sql(cell: str, column: str, values: list[str], suffix: str = "", text: str = "") -> str:
    """One conditional sum per pivoted value."""
    out = []
    for v in values:
        total = f"coalesce(sum({cell}) FILTER ({column} = '{v}'), 0)"
        total = f"printf('{text}', {total}::DOUBLE)" if text else f"round({total}::DOUBLE, 6)"
        out.append(f'{total} AS "{v}{suffix}"')
    return ", ".join(out)


_MEAN = "CASE WHEN hit_count > 0 THEN identity / hit_count ELSE 0.0 END"


def cube(d: Domain) -> DataFrame:
    return d.stages.table("taxon_cube", lambda: cubes.paired_end_scores(
        d.annotated, d.samples, "efpkg", d.params, d.taxa
    ))


def function_cube(d: Domain) -> DataFrame:
    return d.stages.table("function_cube", lambda: cubes.paired_end_scores(
        d.annotated, d.samples, "efpkg", d.params
    ))


# Roll-up -------------------------------------------------------------------------------------

@query("taxonomy_rollup", """
SELECT sample_id, function, taxid, rank, name, coalesce(parent, '') AS parent, round(score, 6) AS score,
  CAST(count AS BIGINT) AS count, CAST(hit_count AS BIGINT) AS hit_count, round(identity, 6) AS identity
FROM det_prof""")
def _(d: Domain) -> DataFrame:
    scores = cubes.paired_end_scores(d.annotated, d.samples, "efpkg", d.params, d.taxa)
    return rollup.roll_up(scores, d.taxa, ["sample_id", "function"], reports.VALUES).select(
        "sample_id", "function", "taxid", "rank", "name",
        F.coalesce("parent", F.lit("")).alias("parent"), *reports.VALUES,
    )


def _profile(d: Domain) -> DataFrame:
    return rollup.roll_up(cube(d), d.taxa, ["sample_id", "function"], reports.VALUES)


@query("rank_filter", """
SELECT sample_id, function, taxid, name, round(score, 6) AS score, CAST(count AS BIGINT) AS count
FROM det_prof WHERE rank = 'phylum'""")
def _(d: Domain) -> DataFrame:
    return reports.rank_of(_profile(d), "phylum").select(
        "sample_id", "function", "taxid", "name", "score", "count"
    )


@query("parent_child_join", """
SELECT sample_id, function, taxid, CAST(count AS BIGINT) AS count,
  CAST(child_count AS BIGINT) AS child_count, round(score, 6) AS score,
  round(child_score::DOUBLE, 6) AS child_score FROM det_sums""")
def _(d: Domain) -> DataFrame:
    return rollup.child_sums(_profile(d), ["sample_id"], ["function"], reports.VALUES).select(
        "sample_id", "function", "taxid", "count", "child_count", "score", "child_score"
    )


@query("unclassified_residual", f"""
SELECT 'count' AS trigger, sample_id, function, taxid, rank, name, round(score, 6) AS score,
  CAST(count AS BIGINT) AS count, round({_MEAN}, 6) AS avg_identity FROM det_res
UNION ALL SELECT 'score', sample_id, function, taxid, rank, name, round(score, 6), NULL, NULL
FROM sco_res""", fill={"avg_identity": 0.0, "count": 0})
def _(d: Domain) -> DataFrame:
    columns = ["trigger", "sample_id", "function", "taxid", "rank", "name", "score", "count",
               "avg_identity"]
    by_count = rollup.residual_nodes(
        _profile(d), ["sample_id"], ["function"], reports.VALUES, "count"
    ).withColumn("trigger", F.lit("count")).withColumn("avg_identity", rollup.mean_identity())
    plain = rollup.roll_up(cube(d), d.taxa, ["sample_id", "function"], ["score"])
    by_score = rollup.residual_nodes(
        plain, ["sample_id"], ["function"], ["score"], "score"
    ).withColumn("trigger", F.lit("score")).withColumn(
        "count", F.lit(None).cast("bigint")
    ).withColumn("avg_identity", F.lit(None).cast("double"))
    return by_count.select(*columns).unionByName(by_score.select(*columns))


@query("profile_preorder", """
SELECT sample_id, line, taxid, rank, name FROM det_lines
JOIN (SELECT DISTINCT sample_id, taxid, rank, name FROM det_nodes) USING (sample_id, taxid)""")
def _(d: Domain) -> DataFrame:
    nodes = rollup.with_residuals(
        _profile(d), ["sample_id"], ["function"], reports.VALUES, "count"
    )
    names = nodes.select("sample_id", "taxid", "rank", "name").distinct()
    return rollup.preorder_lines(nodes, ["sample_id"]).join(names, ["sample_id", "taxid"])


# Matrices ------------------------------------------------------------------------------------

@query("dense_grid", """
SELECT f.function, s.sample_id, round(coalesce(c.score, 0.0), 6) AS score
FROM functions f CROSS JOIN samples s LEFT JOIN fcube c USING (function, sample_id)""")
def _(d: Domain) -> DataFrame:
    return reports.dense_grid(d.function_catalogue, function_cube(d), d.sample_list).select(
        "function", "sample_id", "score"
    )


@query("category_sums", """
SELECT f.grp AS "group", sample_id, round(sum(score), 6) AS score
FROM fcube JOIN functions f USING (function) GROUP BY f.grp, sample_id""")
def _(d: Domain) -> DataFrame:
    return reports.category_sums(d.function_catalogue, function_cube(d))


@query("function_average", """
SELECT taxonomy, sample_id, round(score, 6) AS score, CAST(count AS BIGINT) AS count,
  CAST(hit_count AS BIGINT) AS hit_count, round(identity, 6) AS identity
FROM average_cube WHERE function = 'Average'""")
def _(d: Domain) -> DataFrame:
    return reports.function_average(d.function_catalogue, cube(d))


@query("report_function_matrix", f"""
SELECT f.function, f.name AS definition, {pivot_sql('score', 'sample_id', SAMPLES)}
FROM functions f LEFT JOIN fcube c USING (function) GROUP BY f.function, f.name""")
def _(d: Domain) -> DataFrame:
    return reports.function_matrix(d.function_catalogue, function_cube(d), d.sample_list)


@query("report_category_matrix", f"""
SELECT f.grp AS "group", {pivot_sql('score', 'sample_id', SAMPLES)}
FROM functions f LEFT JOIN fcube c USING (function) GROUP BY f.grp""")
def _(d: Domain) -> DataFrame:
    return reports.category_matrix(d.function_catalogue, function_cube(d), d.sample_list)


@query("report_taxon_function", f"""
SELECT sample_id, line, rank, name, {pivot_sql('score', 'function', BRANDS, '_score')},
  {pivot_sql(_MEAN, 'function', BRANDS, '_identity')},
  {pivot_sql('count', 'function', BRANDS, '_count').replace('round(', 'CAST(').replace('::DOUBLE, 6)', ' AS BIGINT)')}
FROM det_nodes JOIN det_lines USING (sample_id, taxid)
GROUP BY sample_id, line, rank, name""")
def _(d: Domain) -> DataFrame:
    return reports.taxon_function_table(cube(d), d.taxa, d.function_list)


@query("report_taxon_function_score", f"""
SELECT sample_id, line, rank, name, {pivot_sql('score', 'function', BRANDS)}
FROM sco_nodes JOIN sco_lines USING (sample_id, taxid) GROUP BY sample_id, line, rank, name""")
def _(d: Domain) -> DataFrame:
    return reports.taxon_function_score_table(cube(d), d.taxa, d.function_list)


@query("report_taxon_sample", f"""
SELECT function, line, rank, name, {pivot_sql('score', 'sample_id', SAMPLES)}
FROM byf_nodes JOIN byf_lines USING (function, taxid) GROUP BY function, line, rank, name""")
def _(d: Domain) -> DataFrame:
    return reports.taxon_sample_table(cube(d), d.function_catalogue, d.taxa, d.sample_list)


@query("report_markdown_matrix", f"""
SELECT function, {pivot_sql('score', 'sample_id', SAMPLES, text='%.3f')},
  coalesce(any_value(f.name), '') AS definition
FROM fcube LEFT JOIN functions f USING (function) GROUP BY function""")
def _(d: Domain) -> DataFrame:
    return reports.text_matrix(d.function_catalogue, function_cube(d), d.sample_list)


@query("report_stats_functions", f"""
SELECT function, coalesce(any_value(f.grp), '') AS category, {pivot_sql('score', 'sample_id', SAMPLES)}
FROM fcube LEFT JOIN functions f USING (function) GROUP BY function""")
def _(d: Domain) -> DataFrame:
    return reports.statistics_table(d.function_catalogue, function_cube(d), d.sample_list)


@query("report_stats_metadata", "SELECT sample_id, sample_name, replicate FROM samples")
def _(d: Domain) -> DataFrame:
    return reports.sample_metadata(d.samples)


def _levels_sql() -> str:
    cell = "coalesce(labels[{}], 'unclassified') AS level{}"
    return ", ".join(cell.format(i, i) for i in range(1, 8))


@query("report_stats_taxonomy", f"""
SELECT function, {_levels_sql()}, {', '.join(f'"{s}"' for s in SAMPLES)}
FROM (SELECT function, taxid, {pivot_sql('score', 'sample_id', SAMPLES)} FROM byf_nodes
    WHERE function <> 'Average' AND (function, taxid) NOT IN (
      SELECT (function, parent) FROM byf_nodes WHERE parent IS NOT NULL)
    GROUP BY function, taxid)
JOIN (SELECT taxid, list(label ORDER BY pos) AS labels FROM (
    SELECT n.taxid, pos, CASE WHEN step = '~1' THEN 'unclassified'
      WHEN step[1] = '~' THEN 'Unclassified ' || t.name ELSE t.name END AS label
    FROM (SELECT taxid, unnest(path) AS step, unnest(range(len(path))) AS pos
      FROM (SELECT DISTINCT taxid, path FROM byf_nodes)) n
    JOIN taxonomy t ON t.taxid = ltrim(step, '~') WHERE step <> '1') GROUP BY taxid)
  USING (taxid)""")
def _(d: Domain) -> DataFrame:
    return reports.statistics_taxonomy_table(cube(d), d.taxa, d.sample_list)


# Read and protein reports --------------------------------------------------------------------

@query("report_read_listing", f"""
SELECT a.sample_id, a."end", a.read_id, a.status, coalesce(f.functions, '') AS functions,
  coalesce(a.taxonomy, 'No taxonomy') AS taxonomy, h.hit_no AS hit_number, h.subject_id,
  round(h.identity, 6) AS identity, h.q_start, h.q_end, h.bitscore,
  array_to_string(h.functions, '|') AS hit_functions
FROM rd_ann a LEFT JOIN (SELECT {_K}, string_agg(function, ',' ORDER BY function) AS functions
  FROM rd_fn GROUP BY {_K}) f USING ({_K})
LEFT JOIN rd_hits h USING ({_K})""")
def _(d: Domain) -> DataFrame:
    return reports.read_listing(d.annotated)


@query("report_protein_list", f"""
SELECT a.sample_id, a.read_id AS protein_id, f.functions, f.descriptions, round(h.identity, 6) AS identity,
  a.taxonomy, t.name AS taxon_name
FROM pr_ann a JOIN (SELECT {_K}, string_agg(function, ',' ORDER BY function) AS functions,
    string_agg(coalesce(n.name, ''), '|' ORDER BY coalesce(n.name, '')) AS descriptions
  FROM pr_fn LEFT JOIN functions n USING (function) GROUP BY {_K}) f USING ({_K})
JOIN (SELECT {_K}, avg(identity) AS identity FROM pr_hits GROUP BY {_K}) h USING ({_K})
LEFT JOIN taxonomy t ON t.taxid = a.taxonomy WHERE a.status = 'function'""")
def _(d: Domain) -> DataFrame:
    return reports.protein_list(d.annotated_proteins, d.function_catalogue, d.taxa)


@query("report_protein_hits", f"""
SELECT a.sample_id, a.read_id, t.name AS taxon_name, h.subject_id, round(h.identity, 6) AS identity,
  h.length, h.q_start, h.q_end, h.s_start, h.s_end, h.bitscore, array_to_string(h.functions, '|') AS functions
FROM pr_ann a JOIN pr_hits h USING ({_K}) LEFT JOIN taxonomy t ON t.taxid = a.taxonomy
WHERE a.status <> 'nofunction'""", fill={"taxon_name": ""})
def _(d: Domain) -> DataFrame:
    return reports.mapped_protein_hits(d.annotated_proteins, d.taxa).select(
        "sample_id", "read_id", "taxon_name", "subject_id", "identity", "length", "q_start",
        "q_end", "s_start", "s_end", "bitscore", F.array_join("functions", "|").alias("functions"),
    )


@query("report_protein_lengths", f"""
SELECT a.sample_id, a.read_id, f.functions, round(length(x.sequence) / h.s_len::DOUBLE, 6) AS length_ratio,
  a.taxonomy, t.name AS taxon_name
FROM pr_ann a JOIN protein_texts x USING (sample_id, read_id)
JOIN (SELECT {_K}, string_agg(function, ';' ORDER BY function) AS functions FROM pr_fn GROUP BY {_K}) f
  USING ({_K})
JOIN (SELECT * FROM pr_hits WHERE hit_no = 1) h USING ({_K})
LEFT JOIN taxonomy t ON t.taxid = a.taxonomy WHERE a.status = 'function'""")
def _(d: Domain) -> DataFrame:
    return reports.protein_lengths(d.annotated_proteins, d.protein_texts, d.taxa)


@query("avg_input_coverage", """
SELECT s.sample_id, round(coalesce(avg(coverage), 1.0), 6) AS average
FROM samples s LEFT JOIN coverage USING (sample_id) GROUP BY s.sample_id""")
def _(d: Domain) -> DataFrame:
    known = average_coverage(d.coverage)
    return d.samples.select("sample_id").join(known, "sample_id", "left").select(
        "sample_id", F.coalesce("average", F.lit(1.0)).alias("average")
    )


@query("report_sample_summary", """
SELECT sample_id, sample_name, replicate, fwd_reads, fwd_bases, rev_reads, rev_bases,
  round(1e6 / fwd_reads, 6) AS per_million, round(genome_size / fwd_bases, 6) AS per_genome,
  round(genome_size, 6) AS genome_size, round(i.insert_size, 6) AS insert_size, m.mapped_pe1, m.mapped_pe2
FROM samples s JOIN (SELECT sample_id, insert_size FROM insert_sizes) i USING (sample_id)
JOIN (SELECT sample_id, count(*) FILTER ("end" = 'pe1') AS mapped_pe1,
  count(*) FILTER ("end" = 'pe2') AS mapped_pe2 FROM rd_ann GROUP BY sample_id) m USING (sample_id)""")
def _(d: Domain) -> DataFrame:
    sizes = cubes.insert_sizes(d.annotated, d.samples, d.params)
    return reports.sample_summary(d.samples, d.annotated, sizes)


# Hierarchies ---------------------------------------------------------------------------------

_FN = f"""(SELECT f.*, n.grp FROM rd_ann a JOIN rd_fn f USING ({_K}) JOIN functions n USING (function)
  WHERE a.status = 'function')"""
_HF = f"""(SELECT h.sample_id, h."end", h.identity, n.function, n.grp FROM rd_ann a
  JOIN (SELECT *, unnest(functions) AS function FROM rd_hits) h USING ({_K})
  JOIN functions n USING (function) WHERE a.status = 'function')"""


@query("hierarchy_functions", f"""
SELECT sample_id, "end", sample_id || '_' || "end" || coalesce('/' || grp, '') || coalesce('/' || function, '') AS path,
  reads, round(score, 6) AS score,
  round(CASE WHEN grp IS NULL THEN 0.0 ELSE coalesce(avg_identity, 0.0) END, 6) AS avg_identity
FROM (SELECT sample_id, "end", grp, function, count(DISTINCT read_id) AS reads, sum(score) AS score
  FROM {_FN} GROUP BY GROUPING SETS ((sample_id, "end"), (sample_id, "end", grp), (sample_id, "end", grp, function))) f
LEFT JOIN (SELECT sample_id AS s, "end" AS e, grp AS g, function AS fn, avg(identity) AS avg_identity
  FROM {_HF} GROUP BY GROUPING SETS ((sample_id, "end", grp), (sample_id, "end", grp, function))) h
  ON s = sample_id AND e = "end" AND g = grp AND fn IS NOT DISTINCT FROM function""")
def _(d: Domain) -> DataFrame:
    return hierarchies.function_hierarchy(d.annotated, d.function_catalogue)


_NODE = f"""sample_id, array_to_string(path, '/') AS path, rank, name, function, round(score, 6) AS score,
  CAST(count AS BIGINT) AS count, round({_MEAN}, 6) AS avg_identity"""


@query("hierarchy_taxonomy", f"""
SELECT true AS residual, {_NODE} FROM det_nodes UNION ALL SELECT false, {_NODE} FROM det_prof""")
def _(d: Domain) -> DataFrame:
    def nodes(residual: bool) -> DataFrame:
        table = hierarchies.taxonomy_hierarchy(
            cube(d), d.taxa, "function", ["sample_id"], residual
        )
        return table.withColumn("residual", F.lit(residual))
    return nodes(True).unionByName(nodes(False))
