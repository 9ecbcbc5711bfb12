"""Queries on hits, identifiers, scores, filters and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.adapters import READ_KEYS, Domain
from readloom.functions import ids, scores, sequences
from readloom.operators import assembly, catalogue, coverage, hits
from readloom.operators.classify import (
    candidate_regions, find_candidates, non_overlapping_hits,
)
from readloom.operators.hits import deduplicate, filter_by_length
from readloom.params import GOOD
from readloom.registry.core import query

HIT = [*READ_KEYS, "subject_id", "ord", "q_start", "q_end"]
_HIT = 'sample_id, "end", read_id, subject_id, ord, q_start, q_end'


# Scalar projections --------------------------------------------------------------------------

@query("parse_read_id", "SELECT doc_id, \"end\", read_id, read_end FROM read_texts")
def _(d: Domain) -> DataFrame:
    parsed = ids.parse_read_id(F.col("header"))
    return d.read_texts.withColumn("p", parsed).select(
        "doc_id", "end", F.col("p.read_id").alias("read_id"), F.col("p.end").alias("read_end")
    )


@query("mate_read_id", """
SELECT header, CASE WHEN contains(id, ' ') THEN id
  WHEN id[-2:] IN ('/1', '.1') THEN id[:-2] || '2' WHEN id[-2:] IN ('/2', '.2') THEN id[:-2] || '1'
  ELSE id END AS mate, CASE "end" WHEN 'pe1' THEN 'pe2' ELSE 'pe1' END AS mate_of_end
FROM (SELECT header, substr(header, 2) AS id, "end" FROM read_texts)""")
def _(d: Domain) -> DataFrame:
    read_id = F.regexp_replace("header", "^@", "")
    return d.read_texts.select(
        "header", ids.mate_read_id(read_id).alias("mate"),
        ids.mate_end(F.col("end")).alias("mate_of_end"),
    )


@query("hit_region_key", """
SELECT read_id || '|' || "end" || '|' || q_start || '|' || q_end AS key,
  read_id || '|' || "end" AS parsed_id, q_start AS r_start, q_end AS r_end FROM hits""")
def _(d: Domain) -> DataFrame:
    name = F.concat_ws("|", "read_id", "end")
    key = ids.region_key(name, F.col("q_start"), F.col("q_end"))
    return d.hits.select(key.alias("key")).withColumn(
        "p", ids.parse_region_key(F.col("key"))
    ).select("key", F.col("p.read_id").alias("parsed_id"), "p.r_start", "p.r_end")


@query("region_slice", """
SELECT doc_id, "end", substr(sequence, least(a, b), abs(b - a) + 1) AS slice
FROM (SELECT *, CASE WHEN doc_id % 2 = 0 THEN 1 + doc_id % 7 ELSE length(sequence) END AS a,
  CASE WHEN doc_id % 2 = 0 THEN length(sequence) ELSE 1 + doc_id % 7 END AS b FROM read_texts)""")
def _(d: Domain) -> DataFrame:
    head = (F.col("doc_id") % 7 + 1).cast("int")
    tail = F.length("sequence")
    even = F.col("doc_id") % 2 == 0
    piece = sequences.region_slice(
        F.col("sequence"), F.when(even, head).otherwise(tail), F.when(even, tail).otherwise(head)
    )
    return d.read_texts.select("doc_id", "end", piece.alias("slice"))


@query("gene_id_parse", """
SELECT gene_id, function, contig_id, CAST(part_key AS VARCHAR) AS gene_number FROM genes""")
def _(d: Domain) -> DataFrame:
    return assembly.place_genes(d.genes.select("gene_id"))


@query("contig_of_protein", """
SELECT DISTINCT read_id, substr(split_part(read_id, '_', 1), 2) AS contig_id FROM protein_texts""")
def _(d: Domain) -> DataFrame:
    return d.protein_texts.select(
        "read_id", ids.contig_of_protein(F.col("read_id")).alias("contig_id")
    ).distinct()


@query("reverse_complement", """
SELECT function, contig_id, reverse(translate(sequence, 'ACGTN', 'TGCAN')) AS complement
FROM contigs""")
def _(d: Domain) -> DataFrame:
    return d.contigs.select(
        "function", "contig_id",
        sequences.reverse_complement(F.col("sequence")).alias("complement"),
    )


@query("score_rpk_fpk", f"SELECT {_HIT}, round(1000.0::DOUBLE / 3 / s_len, 6) AS rpk FROM hits")
def _(d: Domain) -> DataFrame:
    return d.hits.select(*HIT, scores.per_kilobase(F.col("s_len")).alias("rpk"))


@query("score_erpk", f"""
SELECT {_HIT}, round(CASE WHEN 3 * s_len - 90 + 10 * mismatch + 1 > 1
  THEN 1000.0::DOUBLE / (3 * s_len - 90 + 10 * mismatch + 1) ELSE 1000.0 END, 6) AS erpk
FROM hits""")
def _(d: Domain) -> DataFrame:
    read_length = F.col("mismatch") * 10
    erpk = scores.effective_per_kilobase(F.col("s_len"), read_length, d.params.length_cutoff)
    return d.hits.select(*HIT, erpk.alias("erpk"))


@query("score_efpk", f"""
SELECT {_HIT}, round(CASE WHEN e > 0 THEN 1000.0::DOUBLE / e ELSE 1000.0 END, 6) AS efpk
FROM (SELECT *, CASE WHEN ord = 1 THEN 3 * s_len - 90 + 300 + 1
  WHEN 100 * ord > 300 + s_len THEN 2 * (3 * s_len - 90 + 150 + 1)
  ELSE 3 * s_len - 90 + 100 * ord + 1 END AS e FROM hits)""")
def _(d: Domain) -> DataFrame:
    insert_size = F.when(F.col("ord") != 1, F.col("ord") * 100)
    efpk = scores.effective_fragments_per_kilobase(
        F.col("s_len"), F.lit(150), d.params.length_cutoff, insert_size
    )
    return d.hits.select(*HIT, efpk.alias("efpk"))


@query("score_rpkm_hit", f"""
SELECT {_HIT}, round(CASE WHEN s_len - 15 > 0
  THEN f * 1e9 / ((s_len - 15) * 3 * reads) ELSE f * 1e9 / (3 * reads) END, 6) AS rpkm
FROM (SELECT h.*, 1.0::DOUBLE / (1 + mismatch % 2) AS f, fwd_reads AS reads
  FROM hits h JOIN samples USING (sample_id))""")
def _(d: Domain) -> DataFrame:
    reads = d.samples.select("sample_id", "fwd_reads")
    fraction = F.lit(1.0) / (F.col("mismatch") % 2 + 1)
    value = scores.hit_rpkm(
        F.col("s_len"), fraction, F.col("fwd_reads"), d.params.length_cutoff
    )
    return d.hits.join(reads, "sample_id").select(*HIT, value.alias("rpkm"))


@query("score_relative_abundance", """
SELECT sample_id, read_id, round(abundance, 6) AS abundance FROM protein_abundance""")
def _(d: Domain) -> DataFrame:
    queries = d.protein_hits.where(F.col("searched") == "ref").select(*READ_KEYS).distinct()
    return coverage.protein_abundance(queries, d.coverage).select(
        "sample_id", "read_id", "abundance"
    )


@query("function_split", """
SELECT h.subject_id, count(*) AS hits, array_to_string(coalesce(p.functions, ['']), '|') AS functions,
  len(coalesce(p.functions, [''])) AS n_functions
FROM hits h LEFT JOIN proteins p ON p.protein_id = h.subject_id GROUP BY h.subject_id, p.functions""")
def _(d: Domain) -> DataFrame:
    joined = d.proteins.select(
        F.col("protein_id").alias("subject_id"), F.concat_ws("|", "functions").alias("listed")
    )
    found = d.hits.groupBy("subject_id").agg(F.count("*").alias("hits"))
    split = found.join(joined, "subject_id", "left").withColumn(
        "parts", ids.split_functions(F.col("listed"))
    )
    return split.select(
        "subject_id", "hits", F.concat_ws("|", "parts").alias("functions"),
        F.size("parts").cast("bigint").alias("n_functions"),
    )


@query("lookup_function_meta", """
SELECT b.function, coalesce(f.name, '') AS name, coalesce(f.grp, '') AS group_name,
  coalesce(g.members, '') AS members
FROM (SELECT DISTINCT unnest(coalesce(p.functions, [''])) AS function
  FROM hits h LEFT JOIN proteins p ON p.protein_id = h.subject_id) b
LEFT JOIN functions f USING (function)
LEFT JOIN (SELECT grp, string_agg(function, ',' ORDER BY function) AS members
  FROM functions GROUP BY grp) g ON g.grp = f.grp""")
def _(d: Domain) -> DataFrame:
    seen = (
        catalogue.annotate(
            d.hits.select("subject_id").distinct(), d.protein_catalogue, d.params
        ).select(F.explode("functions").alias("function")).distinct()
    )
    listed = d.function_catalogue
    members = listed.groupBy("group").agg(
        F.concat_ws(",", F.array_sort(F.collect_list("function"))).alias("members")
    )
    found = seen.join(listed, "function", "left").join(members, "group", "left")
    return found.select(
        "function", F.coalesce("name", F.lit("")).alias("name"),
        F.coalesce("group", F.lit("")).alias("group_name"),
        F.coalesce("members", F.lit("")).alias("members"),
    )


# Filters -------------------------------------------------------------------------------------

@query("hit_length_filter", f"SELECT {_HIT}, length FROM ref_hits WHERE length >= 15")
def _(d: Domain) -> DataFrame:
    return filter_by_length(d.reference_hits, d.params.length_cutoff).select(*HIT, "length")


@query("hit_identity_filter", f"""
SELECT {_HIT}, round(identity, 6) AS identity, coalesce(identity_cutoff, 50.0) AS identity_cutoff
FROM hits LEFT JOIN protein_cutoffs ON protein_id = subject_id
WHERE identity >= coalesce(identity_cutoff, 50.0)""")
def _(d: Domain) -> DataFrame:
    annotated = catalogue.annotate(d.hits, d.protein_catalogue, d.params)
    return catalogue.filter_by_identity(annotated).select(*HIT, "identity", "identity_cutoff")


@query("identity_threshold_lookup", """
SELECT function, rank, cutoff FROM cutoffs
UNION ALL SELECT function, NULL, coalesce(function_cutoff, 50.0) FROM functions
UNION ALL SELECT NULL, rank, 50.0 FROM ranks UNION ALL SELECT NULL, NULL, 50.0""", fill={"function": "", "rank": ""})
def _(d: Domain) -> DataFrame:
    return catalogue.identity_thresholds(d.functions, d.params)


@query("bitscore_band_filter", f"""
SELECT {_HIT}, bitscore, best AS best_bitscore FROM bg_hits
JOIN (SELECT sample_id, "end", read_id, max(bitscore) AS best FROM bg_hits GROUP BY ALL)
  USING (sample_id, "end", read_id)
WHERE bitscore > best * (1.0 - 0.03)""")
def _(d: Domain) -> DataFrame:
    band = hits.within_band(d.background_rows, READ_KEYS, d.params.bitscore_range)
    return band.select(*HIT, "bitscore", "best_bitscore")


@query("status_filter", """
SELECT sample_id, "end", read_id, taxonomy FROM rd_ann WHERE status = 'function'""")
def _(d: Domain) -> DataFrame:
    return d.annotated.where(F.col("status") == GOOD).select(*READ_KEYS, "taxonomy")


@query("sample_end_select", """
SELECT read_id, status, taxonomy FROM rd_ann WHERE sample_id = 'S2' AND "end" = 'pe2'""", fill={"taxonomy": ""})
def _(d: Domain) -> DataFrame:
    chosen = (F.col("sample_id") == "S2") & (F.col("end") == "pe2")
    return d.annotated.where(chosen).select("read_id", "status", "taxonomy")


@query("contig_length_filter", """
SELECT function, contig_id, length(sequence) AS length FROM contigs WHERE length(sequence) >= 300""")
def _(d: Domain) -> DataFrame:
    return assembly.long_contigs(d.contigs, d.params.contig_min_length).select(
        "function", "contig_id", F.length("sequence").cast("bigint").alias("length")
    )


@query("contig_coverage_filter", """
SELECT function, contig_id, round(coverage, 6) AS coverage FROM contig_coverage
WHERE sample_id = 'All samples' AND coverage >= 3.0""")
def _(d: Domain) -> DataFrame:
    total = assembly.total_coverage(d.contigs, d.contig_samples)
    return total.where(F.col("coverage") >= d.params.contig_min_coverage).select(
        "function", "contig_id", "coverage"
    )


@query("gene_hit_filter", """
SELECT read_id AS gene_id, subject_id, ord, q_start, q_end, round(identity, 6) AS identity, length
FROM gene_ref WHERE identity >= 50.0 AND length >= 15""")
def _(d: Domain) -> DataFrame:
    rows = d.gene_hits.where(F.col("searched") == "ref")
    return hits.filter_by_fixed_identity(
        rows, d.params.identity_cutoff, d.params.length_cutoff
    ).select("gene_id", "subject_id", "ord", "q_start", "q_end", "identity", "length")


# Joins ---------------------------------------------------------------------------------------

@query("annotate_hits", f"""
SELECT {_HIT}, array_to_string(coalesce(p.functions, ['']), '|') AS functions
FROM hits LEFT JOIN proteins p ON p.protein_id = subject_id""")
def _(d: Domain) -> DataFrame:
    return catalogue.annotate(d.hits, d.protein_catalogue, d.params).select(
        *HIT, F.concat_ws("|", "functions").alias("functions")
    )


@query("hit_taxon", f"""
SELECT {_HIT}, coalesce(p.taxid, '0') AS taxid
FROM hits LEFT JOIN proteins p ON p.protein_id = subject_id""")
def _(d: Domain) -> DataFrame:
    return catalogue.annotate(d.hits, d.protein_catalogue, d.params).select(
        *HIT, F.col("subject_taxid").alias("taxid")
    )


@query("existing_vs_background", f"""
SELECT sample_id, "end", read_id, region_no, known_subject AS subject_id, count(*) AS background_hits,
  count(*) FILTER (subject_id = known_subject) AS same_subject, max(bitscore) AS best
FROM rd_bg GROUP BY sample_id, "end", read_id, region_no, known_subject""")
def _(d: Domain) -> DataFrame:
    key = ids.parse_region_key(F.col("query_id"))
    found = d.background_queries.select(
        "sample_id", "end", key.alias("key"), F.col("subject_id").alias("found"), "bitscore"
    ).select("sample_id", "end", "key.*", "found", "bitscore")
    per_subject = found.groupBy("sample_id", "end", "read_id", "r_start", "r_end", "found").agg(
        F.count("*").alias("n"), F.max("bitscore").alias("best")
    )
    regions = candidate_regions(d.candidates, READ_KEYS).select(
        *READ_KEYS, "r_start", "r_end", "region_no", "subject_id"
    )
    same = F.when(F.col("found") == F.col("subject_id"), F.col("n")).otherwise(0)
    return (
        regions.join(per_subject, [*READ_KEYS, "r_start", "r_end"])
        .groupBy(*READ_KEYS, "region_no", "subject_id")
        .agg(F.sum("n").alias("background_hits"), F.sum(same).alias("same_subject"),
             F.max("best").alias("best"))
    )


@query("unaccounted_reads", """
SELECT sample_id, "end", read_id FROM (SELECT DISTINCT sample_id, "end", read_id FROM rd_cand) c
WHERE NOT EXISTS (SELECT 1 FROM rd_bg b WHERE b.sample_id = c.sample_id AND b."end" = c."end"
  AND b.read_id = c.read_id AND b.length >= 15)""")
def _(d: Domain) -> DataFrame:
    seen = filter_by_length(d.background_hits, d.params.length_cutoff).select(*READ_KEYS)
    return d.candidates.select(*READ_KEYS).join(seen.distinct(), READ_KEYS, "left_anti")


@query("hit_overlap_join", """
WITH iv AS (SELECT sample_id, "end", read_id, CASE WHEN q_start <= q_end THEN 1 ELSE -1 END AS strand,
  least(q_start, q_end) AS low, greatest(q_start, q_end) AS high, count(*) AS hits
  FROM ref_hits GROUP BY ALL)
SELECT a.*, CAST(sum(b.hits) - 1 AS BIGINT) AS overlapped FROM iv a JOIN iv b
  ON a.sample_id = b.sample_id AND a."end" = b."end" AND a.read_id = b.read_id
  AND a.strand = b.strand AND b.high >= a.low + 10 AND b.low <= a.high - 10
GROUP BY ALL""".replace("WITH iv", "SELECT * FROM (WITH iv") + ")")
def _(d: Domain) -> DataFrame:
    return hits.overlap_counts(d.reference_hits, READ_KEYS, d.params.overlap_cutoff)


@query("protein_coverage", """
SELECT sample_id, read_id, round(coverage, 6) AS coverage FROM protein_abundance""")
def _(d: Domain) -> DataFrame:
    queries = d.protein_hits.where(F.col("searched") == "ref").select(*READ_KEYS).distinct()
    return coverage.protein_coverage(queries, d.coverage).select(
        "sample_id", "read_id", "coverage"
    )


@query("alignment_contig_sample", """
SELECT function, contig_id, sample_id, read_count, segment_length FROM contig_samples""")
def _(d: Domain) -> DataFrame:
    return assembly.align_contigs(d.alignments, d.contigs, d.assembly_reads).select(
        "function", "contig_id", "sample_id", "read_count", "segment_length"
    )


# Aggregations over hits ----------------------------------------------------------------------

@query("hit_dedup", f"""
SELECT {_HIT}, round(identity, 6) AS identity, length, mismatch, s_len, s_start, s_end, bitscore
FROM (SELECT *, row_number() OVER (PARTITION BY sample_id, "end", read_id, subject_id, q_start, q_end
  ORDER BY ord, identity, length, mismatch, s_len, s_start, s_end, evalue, bitscore) AS n FROM hits)
WHERE n = 1""")
def _(d: Domain) -> DataFrame:
    return deduplicate(d.hits, READ_KEYS).select(
        *HIT, "identity", "length", "mismatch", "s_len", "s_start", "s_end", "bitscore"
    )


@query("overlap_resolve", """
SELECT sample_id, "end", read_id, h.subject_id, h.q_start, h.q_end, h.bitscore, pos
FROM (SELECT sample_id, "end", read_id, unnest(kept) AS h, unnest(range(len(kept))) AS pos
  FROM rd_fold)""")
def _(d: Domain) -> DataFrame:
    accepted = filter_by_length(d.reference_hits, d.params.length_cutoff)
    kept = non_overlapping_hits(
        deduplicate(accepted, READ_KEYS), READ_KEYS, d.params.overlap_cutoff
    )
    rows = kept.select(*READ_KEYS, F.posexplode("hits").alias("pos", "h"))
    return rows.select(*READ_KEYS, "h.subject_id", "h.q_start", "h.q_end", "h.bitscore",
                       F.col("pos").cast("bigint").alias("pos"))


@query("top_hit", f"""
SELECT sample_id, "end", read_id, subject_id, ord, q_start, q_end, bitscore
FROM (SELECT *, row_number() OVER (PARTITION BY sample_id, "end", read_id
  ORDER BY bitscore DESC, ord, subject_id, q_start, q_end) AS n FROM bg_hits WHERE bitscore > 0)
WHERE n = 1""")
def _(d: Domain) -> DataFrame:
    return hits.top_hit(d.background_rows, READ_KEYS).select(*HIT, "bitscore")


@query("top_band_size", """
SELECT sample_id, "end", read_id, count(*) AS top_size FROM bg_hits
JOIN (SELECT sample_id, "end", read_id, max(bitscore) AS best FROM bg_hits GROUP BY ALL)
  USING (sample_id, "end", read_id)
WHERE bitscore >= best * 0.97 GROUP BY ALL""")
def _(d: Domain) -> DataFrame:
    return hits.band_size(d.background_rows, READ_KEYS, 0.97)


@query("hits_per_query_limit", f"""
SELECT {_HIT}, bitscore, n AS hit_rank FROM (SELECT *, row_number() OVER (
  PARTITION BY sample_id, "end", read_id
  ORDER BY bitscore DESC, ord, subject_id, q_start, q_end) AS n FROM hits) WHERE n <= 3""")
def _(d: Domain) -> DataFrame:
    return hits.limit_per_query(d.hits, READ_KEYS, 3).select(
        *HIT, "bitscore", F.col("hit_rank").cast("bigint").alias("hit_rank")
    )


@query("candidate_reads", f"""
SELECT sample_id, "end", read_id, region_no, subject_id, q_start, q_end, round(identity, 6) AS identity,
  bitscore, array_to_string(functions, '|') AS functions FROM rd_cand""")
def _(d: Domain) -> DataFrame:
    found = find_candidates(d.reference_hits, d.protein_catalogue, d.params, READ_KEYS)
    return candidate_regions(found, READ_KEYS).select(
        *READ_KEYS, F.col("region_no").cast("bigint").alias("region_no"), "subject_id",
        "q_start", "q_end", "identity", "bitscore",
        F.concat_ws("|", "functions").alias("functions"),
    )


@query("function_list_union", """
SELECT DISTINCT function FROM (
  SELECT function FROM gn_fn UNION ALL SELECT unnest(functions) FROM gn_hits
  JOIN gn_ann USING (sample_id, "end", read_id) WHERE status = 'function')""")
def _(d: Domain) -> DataFrame:
    good = d.annotated_genes.where(F.col("status") == GOOD)
    own = good.select(F.explode(F.map_keys("functions")).alias("function"))
    hit = good.select(F.explode("hits").alias("h")).select(
        F.explode("h.functions").alias("function")
    )
    return own.unionByName(hit).distinct()
