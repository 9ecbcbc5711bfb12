"""Queries that read and write files: text tables are rendered from the domain, then scanned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.adapters import READ_KEYS, Domain
from readloom.operators import sequences
from readloom.plans import jobs, reports
from readloom.registry.core import query
from readloom.registry.reads import _SINGLE, flat_annotation, flat_sql, paired_sql
from readloom.registry.reports import SAMPLES, function_cube, pivot_sql
from readloom.registry.views import VIEWS
from readloom.session import written
from readloom.sinks import text as sinks
from readloom.sources import fasta, tables
from readloom.sources.fastq import read_fastq

_K = 'sample_id, "end", read_id'
# Small ranges, so that several tasks share each rendered file.
_SPLIT = 1 << 18


def _tab(*columns) -> Column:
    return F.concat_ws("\t", *columns).alias("line")


def _library() -> Column:
    return F.concat(F.col("sample_id"), F.lit("_"), F.col("end"), F.lit("_hits")).alias("table")


# Tables --------------------------------------------------------------------------------------

def reference_table(d: Domain) -> str:
    """First-search table; its query ids are whole read headers."""
    def write(path: str) -> None:
        header = F.concat(F.col("read_id"), F.lit("/"), F.substring("end", 3, 1))
        rows = d.reference_hits.withColumn("query_id", header).withColumn("table", _library())
        rows.select("table", *[n for n, _ in sinks.HIT_COLUMNS]).write.partitionBy("table").csv(
            path, sep="\t"
        )
    return d.stages.files("reference_hits", write)


@query("scan_hits_tsv", """
SELECT sample_id, "end", read_id, read_id || '/' || substr("end", 3) AS query_id, subject_id,
  round(identity, 6) AS identity, length, mismatch, s_len, q_start, q_end, s_start, s_end,
  round(evalue, 6) AS evalue, bitscore FROM ref_hits""")
def _(d: Domain) -> DataFrame:
    return tables.read_reference_hits(d.spark, reference_table(d)).drop("ord", "table")


def hit_list_files(d: Domain) -> str:
    def write(path: str) -> None:
        kept = d.candidates.select("sample_id", "end", "read_id", F.explode("hits").alias("h"))
        rows = kept.select(
            _library(), F.col("read_id").alias("query_id"),
            *[F.col(f"h.{n}") for n, _ in sinks.HIT_COLUMNS if n != "query_id"],
            F.array_join("h.functions", "|").alias("functions"),
        )
        rows.write.partitionBy("table").csv(path, sep="\t", emptyValue="")
    return d.stages.files("hit_list", write)


@query("scan_hit_list_tsv", f"""
SELECT sample_id, "end", read_id, count(*) AS hits,
  string_agg(subject_id || '=' || array_to_string(functions, '|'), ',' ORDER BY subject_id, q_start) AS listed
FROM rd_cand GROUP BY {_K}""")
def _(d: Domain) -> DataFrame:
    grouped = tables.regroup_hit_list(tables.read_hit_list(d.spark, hit_list_files(d)))
    ordered = F.array_sort(F.transform("hits", lambda h: F.struct(
        h["subject_id"].alias("s"), h["q_start"].alias("q"), h["functions"].alias("f"))))
    return grouped.select(
        *READ_KEYS, F.size("hits").cast("bigint").alias("hits"),
        F.array_join(F.transform(ordered, lambda h: F.concat(
            h["s"], F.lit("="), F.array_join(h["f"], "|"))), ",").alias("listed"),
    )


@query("scan_functions", """
SELECT f.function, f.name, f.grp AS "group", f.function_cutoff, c.rank, c.cutoff FROM functions f
LEFT JOIN cutoffs c ON c.function = f.function AND f.function_cutoff IS NOT NULL""", fill={"cutoff": 0.0, "function_cutoff": 0.0, "rank": ""})
def _(d: Domain) -> DataFrame:
    def write(path: str) -> None:
        cutoff = [F.try_element_at("cutoffs", F.lit(r)).cast("string") for r in
                  ("species", "genus", "family", "order", "class", "phylum", "superkingdom")]
        line = _tab("function", "name", "group", F.col("function_cutoff").cast("string"), *cutoff)
        rows = d.functions.select(line).unionByName(
            d.functions.select(F.concat(F.lit("# "), "function").alias("line"))
        )
        rows.write.text(path)
    read = tables.read_functions(d.spark, d.stages.files("functions", write))
    return read.select(
        "function", "name", "group", "function_cutoff",
        F.explode_outer("cutoffs").alias("rank", "cutoff"),
    )


@query("scan_proteins", """
SELECT protein_id, taxid, array_to_string(functions, '|') AS functions, source FROM proteins""")
def _(d: Domain) -> DataFrame:
    def write(path: str) -> None:
        line = _tab("protein_id", "taxid", F.lit("extra"), "source", F.array_join("functions", "|"))
        short = _tab("protein_id", "taxid")
        d.proteins.select(line).unionByName(d.proteins.select(short)).write.text(path)
    return tables.read_proteins(d.spark, d.stages.files("proteins", write)).withColumn(
        "functions", F.array_join("functions", "|")
    )


@query("scan_taxonomy", "SELECT taxid, name, rank, parent FROM taxonomy")
def _(d: Domain) -> DataFrame:
    def write(path: str) -> None:
        d.taxonomy_rows.select(_tab("taxid", "name", "rank", "parent")).write.text(path)
    return tables.read_taxonomy(d.spark, d.stages.files("taxonomy", write))


@query("scan_coverage", """
SELECT sample_id || ':' || contig_id AS contig_id, round(coverage, 6) AS coverage FROM coverage""")
def _(d: Domain) -> DataFrame:
    def write(path: str) -> None:
        name = F.concat_ws(":", "sample_id", "contig_id")
        rows = d.coverage.select(_tab(name, F.col("coverage").cast("string")))
        rows.unionByName(
            d.coverage.select(F.concat(F.lit("#"), "contig_id").alias("line"))
        ).write.text(path, compression="gzip")
    return tables.read_coverage(d.spark, d.stages.files("coverage", write))


@query("scan_sam", """
SELECT read_id, contig_id, aligned_length FROM alignments""")
def _(d: Domain) -> DataFrame:
    def write(path: str) -> None:
        sequence = F.expr("repeat('A', aligned_length)")
        star = F.lit("*")
        rows = d.alignments.select(_tab(
            "read_id", F.lit("0"), "contig_id", F.lit("1"), F.lit("42"), star, star, F.lit("0"),
            F.lit("0"), sequence, star,
        ))
        head = d.contigs.select(F.concat(F.lit("@SQ\tSN:"), "contig_id").alias("line"))
        rows.unionByName(head).write.text(path)
    return tables.read_alignments(d.spark, d.stages.files("alignments", write))


@query("scan_sample_sheet", """
SELECT sample_id, sample_id || '_1.fq' AS fwd_path,
  CASE WHEN sample_id = 'S4' THEN '' ELSE sample_id || '_2.fq' END AS rev_path,
  sample_id <> 'S4' AS is_paired_end, replicate FROM samples""")
def _(d: Domain) -> DataFrame:
    def write(path: str) -> None:
        reverse = F.when(F.col("sample_id") == "S4", "").otherwise(
            F.concat("sample_id", F.lit("_2.fq"))
        )
        sheet = d.samples.orderBy("sample_id").coalesce(1)
        sheet.select(_tab("sample_id", F.concat("sample_id", F.lit("_1.fq")), reverse)).write.text(path)
    return tables.read_sample_sheet(d.spark, d.stages.files("sheet", write))


@query("scan_genome_size", """
SELECT 'sample_id=' || sample_id AS sample_id, genome_size FROM samples""")
def _(d: Domain) -> DataFrame:
    def write(path: str) -> None:
        line = F.concat(F.lit("average_genome_size:\t"), F.col("genome_size").cast("string"))
        rows = d.samples.select("sample_id", line.alias("line")).unionByName(
            d.samples.select("sample_id", F.lit("total_bases:\t1").alias("line"))
        )
        rows.write.partitionBy("sample_id").text(path)
    return tables.read_genome_sizes(d.spark, d.stages.files("genome_sizes", write) + "/*")


# Sequences -----------------------------------------------------------------------------------

def fastq_files(d: Domain, end: str) -> str:
    """Each end as one set of files: the first plain, the second compressed."""
    def write(path: str) -> None:
        rows = d.read_texts.where(F.col("end") == end)
        sinks.write_fastq(rows, path, compression="none" if end == "pe1" else "gzip")
    return d.stages.files(f"fastq_{end}", write)


def scanned_reads(d: Domain) -> DataFrame:
    """Both ends scanned, with the read ids of their headers."""
    both = None
    for end in ("pe1", "pe2"):
        rows = read_fastq(d.spark, fastq_files(d, end), _SPLIT).drop("file").withColumn(
            "end", F.lit(end)
        )
        both = rows if both is None else both.unionByName(rows)
    return sequences.with_read_ids(both)


@query("scan_fastq", """
SELECT read_id, read_end, header, sequence, line3, quality FROM read_texts WHERE "end" = 'pe1'""")
def _(d: Domain) -> DataFrame:
    records = read_fastq(d.spark, fastq_files(d, "pe1"), _SPLIT)
    return sequences.with_read_ids(records).select(
        "read_id", "read_end", "header", "sequence", "line3", "quality"
    )


@query("candidate_sequences", f"""
SELECT DISTINCT t."end", t.read_id, t.header, t.sequence, t.quality FROM read_texts t
JOIN rd_cand c ON c."end" = t."end" AND c.read_id = t.read_id""")
def _(d: Domain) -> DataFrame:
    return sequences.candidate_records(
        scanned_reads(d), d.candidates, ["end", "read_id"]
    ).select("end", "read_id", "header", "sequence", "quality")


VIEWS["records"] = f"""
SELECT a.sample_id, a."end", a.read_id, a.status, o.header AS own_header, o.sequence AS own_sequence,
  o.quality AS own_quality, m.header AS mate_header, m.sequence AS mate_sequence,
  m.quality AS mate_quality
FROM rd_ann a
LEFT JOIN read_texts o ON o.read_id = a.read_id AND o."end" = a."end"
LEFT JOIN read_texts m ON m.read_id = a.read_id AND m."end" <> a."end"
"""


def with_records(d: Domain) -> DataFrame:
    return sequences.with_mates(d.annotated, scanned_reads(d), ["read_id"])


def _mates_out(table: DataFrame) -> DataFrame:
    return table.select(
        *READ_KEYS, F.col("own.header").alias("own_header"),
        F.col("own.sequence").alias("own_sequence"),
        F.col("mate.header").alias("mate_header"), F.col("mate.sequence").alias("mate_sequence"),
    )


@query("mates_join", f"""
SELECT {_K}, own_header, own_sequence, mate_header, mate_sequence FROM records""", fill={
    "mate_header": "", "mate_sequence": "", "own_header": "", "own_sequence": ""})
def _(d: Domain) -> DataFrame:
    return _mates_out(with_records(d))


@query("scan_fastq_pair", f"""
SELECT {_K}, own_header, own_sequence, own_quality, mate_header, mate_sequence, mate_quality,
  (own_header IS NOT NULL)::INTEGER + (mate_header IS NOT NULL)::INTEGER AS records FROM records""", fill={
    f"{who}_{part}": "" for who in ("own", "mate") for part in ("header", "sequence", "quality")})
def _(d: Domain) -> DataFrame:
    """Every candidate read with the records found for it and its mate: both, one or none."""
    there = lambda who: F.col(f"{who}.header").isNotNull().cast("int")
    return with_records(d).select(
        *READ_KEYS, *[F.col(f"{who}.{part}").alias(f"{who}_{part}")
                      for who in ("own", "mate") for part in ("header", "sequence", "quality")],
        (there("own") + there("mate")).alias("records"))


@query("scan_fasta", """
SELECT substr(header, 2) AS header, sequence FROM read_texts WHERE "end" = 'pe1'""")
def _(d: Domain) -> DataFrame:
    def write(path: str) -> None:
        # Sequences are folded at 70 letters, as FASTA files usually are.
        folded = F.regexp_replace("sequence", "(.{70})", "$1\n")
        rows = d.read_texts.where(F.col("end") == "pe1").select(
            F.expr("substring(header, 2)").alias("header"), folded.alias("sequence")
        )
        sinks.write_fasta(rows, path)
    return fasta.read_fasta(d.spark, d.stages.files("reads_fasta", write)).select(
        "header", "sequence"
    )


def protein_files(d: Domain) -> str:
    return d.stages.files(
        "proteins_fasta", lambda path: sinks.write_fasta(d.protein_texts, path, compression="gzip")
    )


@query("scan_protein_fasta", "SELECT read_id, header, sequence FROM protein_texts")
def _(d: Domain) -> DataFrame:
    return fasta.read_proteins_fasta(d.spark, protein_files(d)).select(
        "read_id", "header", "sequence"
    )


@query("scan_contigs", """
SELECT contig_id, length(sequence) AS length, sequence FROM contigs
UNION ALL SELECT contig_id || ' flag=1', length(sequence), sequence FROM contigs""")
def _(d: Domain) -> DataFrame:
    def write(path: str) -> None:
        header = F.concat("contig_id", F.lit(" flag=1"))
        sinks.write_fasta(d.contigs.withColumn("header", header), path)
    path = d.stages.files("contigs_fasta", write)
    first, whole = (fasta.read_contigs(d.spark, path, w) for w in (False, True))
    return first.unionByName(whole).select(
        "contig_id", F.length("sequence").cast("bigint").alias("length"), "sequence"
    )


@query("scan_genes", """
SELECT gene_id, gene_start, gene_end, strand, protein_sequence FROM genes""")
def _(d: Domain) -> DataFrame:
    def write(path: str) -> None:
        header = F.concat_ws(
            " # ", "gene_id", F.col("gene_start").cast("string"),
            F.col("gene_end").cast("string"), "strand", F.lit("ID=1_1;partial=00"),
        )
        rows = d.genes.withColumn("header", header).withColumn("sequence", F.col("protein_sequence"))
        sinks.write_fasta(rows, path)
    return fasta.read_genes(d.spark, d.stages.files("genes_fasta", write))


# Sinks ---------------------------------------------------------------------------------------

@query("sink_hit_list", f"""
SELECT read_id AS query_id, subject_id, round(identity, 6) AS identity, length, mismatch, s_len, q_start,
  q_end, s_start, s_end, bitscore, array_to_string(functions, '|') AS functions FROM rd_cand""")
def _(d: Domain) -> DataFrame:
    path = d.stages.fresh_path("hit_list_out")
    kept = d.candidates.select(F.col("read_id").alias("query_id"), F.explode("hits").alias("h"))
    names = [n for n, _ in sinks.HIT_COLUMNS if n != "query_id"]
    sinks.write_hit_list(
        kept.select("query_id", *[f"h.{n}" for n in names], "h.functions"), path
    )
    read = tables.read_hit_list(d.spark, path)
    return read.select(
        "query_id", *[n for n in names if n != "evalue"],
        F.array_join("functions", "|").alias("functions"),
    )


@query("sink_hit_regions", f"""
SELECT '@' || c.read_id || '|' || c.r_start || '|' || c.r_end AS header,
  substr(t.sequence, least(c.r_start, c.r_end), abs(c.r_end - c.r_start) + 1) AS sequence,
  substr(t.quality, least(c.r_start, c.r_end), abs(c.r_end - c.r_start) + 1) AS quality
FROM rd_cand c JOIN read_texts t ON t.read_id = c.read_id AND t."end" = c."end" """)
def _(d: Domain) -> DataFrame:
    joined = sequences.with_mates(d.candidates, scanned_reads(d), ["read_id"])
    regions = sequences.hit_regions(joined)
    path = d.stages.fresh_path("regions_out")
    sinks.write_fastq(regions.withColumn("header", F.concat(F.lit("@"), "header")), path)
    return read_fastq(d.spark, path).select("header", "sequence", "quality")


@query("sink_good_reads", """
SELECT own_header AS header, own_sequence AS sequence, own_quality AS quality FROM records
WHERE status = 'function' AND own_header IS NOT NULL""")
def _(d: Domain) -> DataFrame:
    path = d.stages.fresh_path("good_out")
    rows = sequences.good_records(with_records(d)).orderBy("read_id")
    sinks.write_fastq(rows, path, compression="gzip")
    return read_fastq(d.spark, path).select("header", "sequence", "quality")


@query("sink_mates", """
SELECT only_good, mate_header AS header, mate_sequence AS sequence
FROM records CROSS JOIN (SELECT unnest([true, false]) AS only_good)
WHERE mate_header IS NOT NULL AND (NOT only_good OR status = 'function')""")
def _(d: Domain) -> DataFrame:
    joined = written(with_records(d).where(F.col("mate.header").isNotNull()).select(
        *READ_KEYS, "status", "mate"))
    both = None
    for only_good in (True, False):
        path = d.stages.fresh_path("mates_out")
        sinks.write_fastq(sequences.mate_records(joined, only_good), path, compression="gzip")
        rows = read_fastq(d.spark, path).select(
            F.lit(only_good).alias("only_good"), "header", "sequence"
        )
        both = rows if both is None else both.unionByName(rows)
    return both


VIEWS["exported"] = f"""
SELECT function, read_id, first.sample_id AS sample_id, e AS file_end,
  CASE WHEN e = first."end" THEN first.own ELSE first.mate END AS header
FROM (SELECT function, read_id, min(struct_pack(sample_id := sample_id, "end" := "end",
    own := own_header, mate := mate_header)) AS first
  FROM (SELECT r.*, f.function FROM records r JOIN rd_fn f USING ({_K})
    UNION ALL BY NAME SELECT DISTINCT r.*, 'Coassembly' AS function FROM records r JOIN rd_fn f USING ({_K}))
  WHERE status = 'function' AND own_header IS NOT NULL GROUP BY function, read_id)
CROSS JOIN (SELECT unnest(['pe1', 'pe2']) AS e)
"""


@query("sink_assembly_reads", """
SELECT function, file_end, header FROM exported WHERE header IS NOT NULL""")
def _(d: Domain) -> DataFrame:
    joined = written(with_records(d).where(F.col("own").isNotNull()).select(
        *READ_KEYS, "status", "functions", "own", "mate"))
    rows = sequences.assembly_export(joined, coassembly=False).unionByName(
        sequences.assembly_export(joined, coassembly=True)
    )
    path = d.stages.fresh_path("assembly_out")
    sinks.write_fastq(rows, path, partition_by=["function", "file_end"])
    read = read_fastq(d.spark, path)
    return read.select(
        sinks.partition_value(F.col("file"), "function").alias("function"),
        sinks.partition_value(F.col("file"), "file_end").alias("file_end"), "header",
    )


@query("sink_annotated", flat_sql("rd"))
def _(d: Domain) -> DataFrame:
    path = d.stages.fresh_path("annotated_out")
    sinks.write_annotated(d.annotated, path)
    return flat_annotation(tables.read_annotated(d.spark, path), READ_KEYS)


@query("load_annotated", flat_sql("pr"))
def _(d: Domain) -> DataFrame:
    path = d.stages.files("proteins_json", lambda p: sinks.write_annotated(d.annotated_proteins, p))
    return flat_annotation(tables.read_annotated(d.spark, path), READ_KEYS)


@query("sink_gene_sequences", """
SELECT h.function, g.gene_id || '|' || g.gene_start || '|' || g.gene_end || '|' || g.strand || '|' || l.lineage AS header,
  CASE WHEN g.strand = '-1' THEN reverse(translate(s, 'ACGTN', 'TGCAN')) ELSE s END AS sequence,
  g.protein_sequence AS protein
FROM (SELECT *, substr(c.sequence, gene_start, gene_end - gene_start + 1) AS s FROM genes g JOIN contigs c USING (function, contig_id)) g
JOIN gn_ann a ON a.read_id = g.gene_id JOIN lineage l ON l.taxid = a.taxonomy
JOIN (SELECT DISTINCT gene_id, unnest(functions) AS function FROM good_gene_hits) h ON h.gene_id = g.gene_id
WHERE a.status = 'function'""")
def _(d: Domain) -> DataFrame:
    rows = reports.gene_sequences(d.annotated_genes, d.genes, d.contigs, d.taxa)

    def round_trip(name: str, column: str) -> DataFrame:
        path = d.stages.fresh_path(name)
        sinks.write_fasta(
            rows.withColumn("sequence", F.col(column)), path, partition_by=["function"]
        )
        function = sinks.partition_value(F.col("file"), "function")
        return fasta.read_fasta(d.spark, path).select(
            function.alias("function"), "header", F.col("sequence").alias(column)
        )

    return round_trip("genes_fna", "sequence").join(
        round_trip("genes_faa", "protein"), ["function", "header"]
    )


@query("sink_matrix", f"""
SELECT f.function, f.name AS definition, {pivot_sql('score', 'sample_id', SAMPLES)}
FROM functions f LEFT JOIN fcube c USING (function) GROUP BY f.function, f.name""")
def _(d: Domain) -> DataFrame:
    path = d.stages.fresh_path("matrix_out")
    table = reports.function_matrix(d.function_catalogue, function_cube(d), d.sample_list)
    sinks.write_matrix(table, path)
    return d.spark.read.schema(table.schema).csv(path, sep="\t", header=True)


# Jobs ----------------------------------------------------------------------------------------

def _reference(d: Domain) -> jobs.Reference:
    return jobs.Reference(d.protein_catalogue, d.function_catalogue, d.taxa)


def _paired_job_sql(metric: str, values: str) -> str:
    return f"""
SELECT NULL AS taxonomy, * FROM ({paired_sql(metric, False, values=values)})
UNION ALL BY NAME SELECT * FROM ({paired_sql(metric, True, values=values)})"""


def _single_job_sql(metric: str, p: str) -> str:
    part = f"""round({_SINGLE[metric]}::DOUBLE, 6) AS score, count(*) AS count, count(bitscore) AS hit_count,
  round(coalesce(sum(identity), 0.0), 6) AS identity, '{metric}' AS metric
FROM {p}_fbest JOIN {p}_ann USING ({_K}) JOIN samples USING (sample_id)
WHERE status = 'function' AND "end" = 'pe1' GROUP BY """
    return f"""SELECT NULL AS taxonomy, function, sample_id, {part} function, sample_id
UNION ALL SELECT taxonomy, function, sample_id, {part} taxonomy, function, sample_id"""


@query("job_single_end", _single_job_sql("erpkg", "rd"), fill={"taxonomy": ""})
def _(d: Domain) -> DataFrame:
    first = F.col("end") == "pe1"
    candidates = jobs.first_search(
        d.reference_hits.where(first), _reference(d), d.params, READ_KEYS
    )
    background = d.place_in_regions(d.background_rows.where(first), candidates, READ_KEYS)
    profile = jobs.profile_reads(
        candidates, background, d.single_samples, _reference(d), d.params, READ_KEYS
    )
    return jobs.long_form(profile)


@query("job_paired_end", _paired_job_sql("efpkg", "good_frag_values"), fill={"taxonomy": ""})
def _(d: Domain) -> DataFrame:
    candidates = jobs.first_search(d.reference_hits, _reference(d), d.params, READ_KEYS)
    background = d.place_in_regions(d.background_rows, candidates, READ_KEYS)
    profile = jobs.profile_reads(
        candidates, background, d.samples, _reference(d), d.params, READ_KEYS
    )
    return jobs.long_form(profile)


@query("job_protein", _single_job_sql("proteincount", "pr"), fill={"taxonomy": ""})
def _(d: Domain) -> DataFrame:
    searched = lambda kind: d.protein_hits.where(F.col("searched") == kind)
    candidates = jobs.first_search(searched("ref"), _reference(d), d.params, READ_KEYS)
    background = d.place_in_regions(searched("bg"), candidates, READ_KEYS)
    profile = jobs.profile_proteins(
        candidates, background, d.coverage, d.protein_samples, _reference(d), d.params, READ_KEYS
    )
    return jobs.long_form(profile)


@query("job_assembly_annotation", flat_sql("gn", "read_id AS gene_id"))
def _(d: Domain) -> DataFrame:
    searched = lambda kind: d.gene_hits.where(F.col("searched") == kind)
    candidates = jobs.first_search(
        searched("ref"), _reference(d), d.params, ["gene_id"], fixed_identity=True
    )
    background = d.place_in_regions(searched("bg"), candidates, ["gene_id"])
    annotated, _ = jobs.annotate_assembly(
        candidates, background, d.contigs, d.alignments, d.assembly_reads, _reference(d), d.params
    )
    return flat_annotation(annotated, ["gene_id"])


@query("job_rereport", _paired_job_sql("fpkm", "frag_values"), fill={"taxonomy": ""})
def _(d: Domain) -> DataFrame:
    return jobs.long_form(jobs.report(d.annotated, d.samples, _reference(d), d.params, "fpkm"))
