"""Queries on contigs, genes and the reports of an assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.adapters import Domain
from readloom.operators import assembly, rollup
from readloom.plans import hierarchies, reports
from readloom.registry.core import query
from readloom.registry.reports import SAMPLES, _MEAN, pivot_sql, profile_views
from readloom.registry.views import VIEWS

VIEWS["contig_rpkm"] = """
SELECT c.*, read_count * 1e9 / length / reads AS rpkm, read_count * 1e9 / length / reads_both AS rpkm_both,
  read_count * 1e6 / reads AS rpm
FROM contig_coverage c JOIN libraries USING (sample_id)
"""
VIEWS["good_gene_hits"] = """
SELECT g.gene_id, g.function AS contig_function, g.contig_id, a.taxonomy, h.hit_no, h.identity, h.s_len,
  h.subject_id, h.functions, length(g.protein_sequence) AS protein_length
FROM genes g JOIN gn_ann a ON a.read_id = g.gene_id AND a.status = 'function'
JOIN gn_hits h ON h.read_id = g.gene_id
"""
VIEWS["shares"] = """
SELECT h.*, s.sample_id, s.coverage, h.protein_length * 100 / h.s_len::DOUBLE AS completeness,
  s.read_count * h.protein_length * 3 / s.length::DOUBLE AS count,
  s.rpkm * h.protein_length * 3 / s.length AS rpkm
FROM good_gene_hits h JOIN contig_rpkm s ON s.function = h.contig_function AND s.contig_id = h.contig_id
"""
VIEWS["gene_function_cube"] = """
SELECT taxonomy, function, sum(rpkm) AS rpkm, sum(count) AS count, count(*) AS hit_count, sum(identity) AS identity
FROM (SELECT *, unnest(functions) AS function FROM shares WHERE sample_id = 'All samples')
GROUP BY taxonomy, function
"""
VIEWS["gene_sample_rows"] = """
SELECT * FROM (SELECT s.*, row_number() OVER (PARTITION BY s.function, s.gene_id, s.sample_id ORDER BY hit_no) AS n
  FROM (SELECT * EXCLUDE (functions), unnest(functions) AS function FROM shares) s
  JOIN gn_fn f ON f.read_id = s.gene_id AND f.function = s.function) WHERE n = 1
"""
VIEWS["gene_sample_cube"] = """
SELECT function, taxonomy, sample_id, sum(rpkm) AS rpkm, sum(count) AS count, count(*) AS hit_count,
  sum(identity) AS identity FROM gene_sample_rows GROUP BY function, taxonomy, sample_id
"""
_GENE_VALUES = ("rpkm", "count", "hit_count", "identity")
profile_views("gfn", "gene_function_cube", "", "function", "rpkm", _GENE_VALUES)
profile_views("gsm", "gene_sample_cube", "function", "sample_id", "rpkm", _GENE_VALUES)


def shares(d: Domain) -> DataFrame:
    return assembly.gene_share(
        d.annotated_genes, d.genes, d.contigs, d.contig_samples, d.samples
    )


@query("contig_coverage", """
SELECT function, contig_id, sample_id, length, read_count, round(coverage, 6) AS coverage
FROM contig_coverage""")
def _(d: Domain) -> DataFrame:
    return assembly.contig_coverage(d.contigs, d.contig_samples).withColumn(
        "length", F.col("length").cast("bigint")
    )


@query("contig_rpkm", """
SELECT function, contig_id, sample_id, length, read_count, round(coverage, 6) AS coverage,
  round(rpkm, 6) AS rpkm, round(rpm, 6) AS rpm FROM contig_rpkm""")
def _(d: Domain) -> DataFrame:
    return assembly.contig_rpkm(d.contigs, d.contig_samples, d.samples).withColumn(
        "length", F.col("length").cast("bigint")
    )


@query("all_samples_row", """
SELECT function, contig_id, sample_id, read_count, segment_length FROM contig_series
WHERE (function, contig_id) IN (SELECT (function, contig_id) FROM contig_samples)""")
def _(d: Domain) -> DataFrame:
    return assembly.add_total_series(d.contig_samples)


@query("assembly_avg_coverage", """
SELECT sample_id, round(sum(coverage) / (SELECT count(*) FROM contigs), 6) AS avg_coverage
FROM contig_coverage GROUP BY sample_id""")
def _(d: Domain) -> DataFrame:
    return assembly.average_coverage(d.contigs, d.contig_samples)


@query("gene_share", """
SELECT gene_id, sample_id, hit_no - 1 AS hit_no, round(count, 6) AS count, round(rpkm, 6) AS rpkm,
  round(coverage, 6) AS coverage, round(completeness, 6) AS completeness FROM shares""")
def _(d: Domain) -> DataFrame:
    return shares(d).select(
        "gene_id", "sample_id", F.col("hit_no").cast("bigint").alias("hit_no"), "count", "rpkm",
        "coverage", "completeness",
    )


@query("gene_scores_by_taxon", """
SELECT 'function' AS kind, function, taxonomy, 'All samples' AS sample_id, round(rpkm, 6) AS rpkm,
  round(count, 6) AS count, hit_count, round(identity, 6) AS identity FROM gene_function_cube
UNION ALL SELECT 'sample', function, taxonomy, sample_id, round(rpkm, 6), round(count, 6), hit_count,
  round(identity, 6) FROM gene_sample_cube""")
def _(d: Domain) -> DataFrame:
    rows = shares(d)
    by_function = assembly.gene_function_scores(rows).withColumn(
        "sample_id", F.lit(assembly.ALL_SAMPLES)
    ).withColumn("kind", F.lit("function"))
    by_sample = assembly.gene_sample_scores(rows).withColumn("kind", F.lit("sample"))
    return by_function.unionByName(by_sample)


@query("assembly_rollup", f"""
SELECT 'taxon' AS kind, taxid, name, function, round(rpkm, 6) AS rpkm, round(count, 6) AS count,
  CAST(hit_count AS BIGINT) AS hit_count, round({_MEAN}, 6) AS avg_identity FROM gfn_prof
UNION ALL SELECT DISTINCT 'gene', arg_min(a.anc, a.distance) FILTER (a.ranked), h.gene_id, h.function,
  NULL, NULL, NULL, NULL
FROM (SELECT *, unnest(functions) AS function FROM good_gene_hits) h JOIN anc a ON a.taxid = h.taxonomy
GROUP BY h.gene_id, h.function, h.hit_no""", fill={
    "avg_identity": 0.0, "count": 0.0, "hit_count": 0, "rpkm": 0.0})
def _(d: Domain) -> DataFrame:
    rows = shares(d)
    values = ["rpkm", "count", "hit_count", "identity"]
    profile = rollup.roll_up(assembly.gene_function_scores(rows), d.taxa, ["function"], values)
    numbers = profile.select(
        F.lit("taxon").alias("kind"), "taxid", "name", "function", "rpkm", "count", "hit_count",
        rollup.mean_identity().alias("avg_identity"),
    )
    own = d.taxa.select(
        F.col("taxid").alias("taxonomy"),
        F.try_element_at("ranked_path", F.lit(-1))["taxid"].alias("taxid"),
    )
    genes = (
        rows.where(F.col("sample_id") == assembly.ALL_SAMPLES)
        .select("taxonomy", "gene_id", F.explode("hit_functions").alias("function")).distinct()
        .join(own, "taxonomy")
        .select(
            F.lit("gene").alias("kind"), "taxid", F.col("gene_id").alias("name"), "function",
            *[F.lit(None).cast(t).alias(c) for c, t in (
                ("rpkm", "double"), ("count", "double"), ("hit_count", "bigint"),
                ("avg_identity", "double"))],
        )
    )
    return numbers.unionByName(genes)


@query("assembled_reads", f"""
SELECT r.function, {pivot_sql('n', 'sample_id', SAMPLES).replace('round(', 'CAST(').replace('::DOUBLE, 6)', ' AS BIGINT)')},
  CAST(sum(n) AS BIGINT) AS all_reads, coalesce(any_value(a.assembled), 0) AS assembled_reads,
  CAST(sum(n) - coalesce(any_value(a.assembled), 0) AS BIGINT) AS unassembled_reads,
  coalesce(any_value(f.name), '') AS definition
FROM (SELECT function, sample_id, 2 * count(*) AS n FROM assembly_reads GROUP BY ALL) r
LEFT JOIN (SELECT function, CAST(sum(read_count) AS BIGINT) AS assembled FROM contig_samples GROUP BY function) a
  USING (function) LEFT JOIN functions f USING (function) GROUP BY r.function""")
def _(d: Domain) -> DataFrame:
    return reports.assembled_reads_table(
        d.assembly_reads, d.contig_samples, d.function_catalogue, d.sample_list, paired=True
    )


def _triplets(reads: str, rpkm: str = "rpkm_sample") -> str:
    return ", ".join([
        pivot_sql(reads, "sample_id", SAMPLES, "_reads"),
        pivot_sql(rpkm, "sample_id", SAMPLES, "_rpkm"),
        pivot_sql("coverage", "sample_id", SAMPLES, "_coverage"),
    ])


def _contig_triplets() -> str:
    text = _triplets("read_count", "rpkm")
    for s in SAMPLES:
        text = text.replace(
            f"round(coalesce(sum(read_count) FILTER (sample_id = '{s}'), 0)::DOUBLE, 6)",
            f"CAST(coalesce(sum(read_count) FILTER (sample_id = '{s}'), 0) AS BIGINT)")
    return text


@query("report_contigs", f"""
SELECT c.function, c.contig_id, c.length, c.read_count, round(c.rpkm_both, 6) AS rpkm,
  round(c.coverage, 6) AS coverage, coalesce(g.genes, 0) AS genes, t.* EXCLUDE (function, contig_id),
  f.name AS definition
FROM contig_rpkm c
LEFT JOIN (SELECT function, contig_id, count(*) AS genes FROM genes GROUP BY ALL) g USING (function, contig_id)
LEFT JOIN (SELECT function, contig_id, {_contig_triplets()} FROM contig_rpkm GROUP BY function, contig_id) t
  USING (function, contig_id)
LEFT JOIN functions f USING (function) WHERE c.sample_id = 'All samples'""")
def _(d: Domain) -> DataFrame:
    return reports.contig_table(
        d.contigs, d.genes, d.contig_samples, d.samples, d.function_catalogue, d.sample_list
    ).withColumn("length", F.col("length").cast("bigint"))


@query("report_genes", f"""
SELECT g.gene_id, g.function, g.contig_id, g.gene_start, g.gene_end,
  g.gene_end - g.gene_start + 1 AS gene_length, g.strand,
  round(c.read_count * (g.gene_end - g.gene_start + 1) / c.length::DOUBLE, 6) AS read_count,
  round(c.rpkm_both, 6) AS rpkm, round(c.coverage, 6) AS coverage,
  coalesce(a.status, 'unaccounted') AS status, h.gene_functions,
  round(h.gene_identity, 6) AS gene_identity,
  round(length(g.protein_sequence) * 100 * h.n / h.total::DOUBLE, 6) AS completeness,
  h.subject_id, h.subject_taxid, h.organism, h.lineage,
  CASE WHEN a.status = 'function' THEN a.taxonomy END AS lca_taxid, t.name AS lca_organism,
  l.lineage AS lca_lineage, s.* EXCLUDE (gene_id), f.name AS definition
FROM genes g JOIN contig_rpkm c ON c.function = g.function AND c.contig_id = g.contig_id
  AND c.sample_id = 'All samples'
LEFT JOIN gn_ann a ON a.read_id = g.gene_id
LEFT JOIN taxonomy t ON t.taxid = a.taxonomy LEFT JOIN lineage l ON l.taxid = a.taxonomy
LEFT JOIN functions f ON f.function = g.function
LEFT JOIN (SELECT h.gene_id, avg(h.identity) AS gene_identity, sum(h.s_len) AS total, count(*) AS n,
    string_agg(h.subject_id, ',' ORDER BY hit_no) AS subject_id,
    string_agg(coalesce(p.taxid, '0'), ',' ORDER BY hit_no) AS subject_taxid,
    string_agg(t.name, ',' ORDER BY hit_no) AS organism,
    string_agg(l.lineage, '|' ORDER BY hit_no) AS lineage,
    array_to_string(list_sort(list_distinct(flatten(list(h.functions)))), ',') AS gene_functions
  FROM good_gene_hits h LEFT JOIN proteins p ON p.protein_id = h.subject_id
  JOIN taxonomy t ON t.taxid = coalesce(p.taxid, '0') JOIN lineage l ON l.taxid = t.taxid
  GROUP BY h.gene_id) h ON h.gene_id = g.gene_id
LEFT JOIN (SELECT gene_id, {_triplets('share', 'rpkm')} FROM (
    SELECT g.gene_id, c.*, c.read_count * length(g.protein_sequence) * 3 / c.length::DOUBLE AS share
    FROM genes g JOIN contig_rpkm c ON c.function = g.function AND c.contig_id = g.contig_id
      AND c.sample_id <> 'All samples') GROUP BY gene_id) s ON s.gene_id = g.gene_id""", fill={
    "completeness": 0.0, "gene_identity": 0.0,
    **{c: "N/A" for c in ("gene_functions", "subject_id", "subject_taxid", "organism", "lineage",
                          "lca_taxid", "lca_organism", "lca_lineage")}})
def _(d: Domain) -> DataFrame:
    return reports.gene_table(
        d.annotated_genes, d.genes, d.contigs, d.contig_samples, d.samples, d.protein_catalogue,
        d.function_catalogue, d.taxa, d.sample_list, d.params,
    )


@query("report_assembly_text", """
SELECT g.function, g.contig_id, c.length, g.gene_id, f.functions, c.sample_id, c.read_count,
  printf('%.2f', c.coverage) AS coverage, printf('%.2f', c.rpkm) AS rpkm
FROM genes g JOIN gn_ann a ON a.read_id = g.gene_id AND a.status = 'function'
JOIN (SELECT read_id, string_agg(function, ',' ORDER BY function) AS functions FROM gn_fn GROUP BY read_id) f
  ON f.read_id = g.gene_id
JOIN contig_rpkm c ON c.function = g.function AND c.contig_id = g.contig_id AND c.sample_id <> 'All samples'""")
def _(d: Domain) -> DataFrame:
    return reports.assembly_listing(
        d.annotated_genes, d.genes, d.contigs, d.contig_samples, d.samples
    ).withColumn("length", F.col("length").cast("bigint"))


@query("hierarchy_assembly", f"""
SELECT function, array_to_string(path, '/') AS path, 'taxon' AS kind, name, sample_id, round(rpkm, 6) AS rpkm,
  round(count, 6) AS count, round({_MEAN}, 6) AS avg_identity, 0.0 AS completeness, 0.0 AS coverage,
  0 AS protein_length FROM gsm_prof
UNION ALL SELECT r.function, p.place || '/' || r.gene_id, 'gene', r.gene_id, r.sample_id, round(r.rpkm, 6),
  round(r.count, 6), round(r.identity, 6), round(r.completeness, 6), round(r.coverage, 6), r.protein_length
FROM gene_sample_rows r JOIN (SELECT taxid, string_agg(anc, '/' ORDER BY distance DESC) AS place
  FROM anc WHERE ranked GROUP BY taxid) p ON p.taxid = r.taxonomy""")
def _(d: Domain) -> DataFrame:
    rows = shares(d)
    return hierarchies.assembly_hierarchy(
        assembly.gene_sample_rows(rows), assembly.gene_sample_scores(rows), d.taxa, "sample_id",
        ["function"],
    )
