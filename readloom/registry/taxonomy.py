"""Queries on the taxonomy and on lowest common ancestors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.adapters import READ_KEYS, Domain
from readloom.operators import taxonomy
from readloom.operators.catalogue import annotate, supported_step
from readloom.registry.core import query
from readloom.registry.views import lca_sql


@query("taxon_lookup", """
SELECT h.subject_id, count(*) AS hits, coalesce(p.taxid, '0') AS taxid, t.name, t.rank, t.parent,
  t.taxid IS NOT NULL AS known
FROM hits h LEFT JOIN proteins p ON p.protein_id = h.subject_id
LEFT JOIN taxonomy t ON t.taxid = coalesce(p.taxid, '0') GROUP BY ALL""")
def _(d: Domain) -> DataFrame:
    found = d.hits.groupBy("subject_id").agg(F.count("*").alias("hits"))
    taxids = annotate(found, d.protein_catalogue, d.params).select(
        "subject_id", "hits", F.col("subject_taxid").alias("taxid")
    )
    return taxids.join(d.taxa.select("taxid", "name", "rank", "parent"), "taxid", "left").select(
        "subject_id", "hits", "taxid", "name", "rank", "parent",
        F.col("name").isNotNull().alias("known"),
    )


@query("lineage_closure", """
SELECT taxid, anc AS ancestor, anc_rank AS ancestor_rank, distance FROM anc""")
def _(d: Domain) -> DataFrame:
    return taxonomy.lineage_closure(taxonomy.ancestor_paths(d.taxonomy))


@query("ranked_parent", """
SELECT taxid, parent AS ranked_parent, parent_rank AS ranked_parent_rank FROM ranked_parent
UNION ALL SELECT CAST(1000000 + s_suppkey AS VARCHAR), '0', 'norank' FROM supplier""")
def _(d: Domain) -> DataFrame:
    strangers = d.source("supplier").select(
        (F.col("s_suppkey") + 1000000).cast("string").alias("taxid")
    )
    asked = d.taxonomy.select("taxid").unionByName(strangers)
    known = d.taxa.select("taxid", "ranked_parent", "ranked_parent_rank")
    return asked.join(known, "taxid", "left").select(
        "taxid", F.coalesce("ranked_parent", F.lit("0")).alias("ranked_parent"),
        F.coalesce("ranked_parent_rank", F.lit("norank")).alias("ranked_parent_rank"),
    )


@query("lineage_string", "SELECT taxid, lineage FROM lineage")
def _(d: Domain) -> DataFrame:
    return d.taxa.select("taxid", "lineage")


# Every query's subjects as a bag of taxa; unknown subjects, ids the taxonomy lacks and the empty
# id are all among them.
_MEMBERS = """(SELECT h.sample_id, h."end", h.read_id,
  CASE WHEN part_key % 97 = 0 THEN '' WHEN part_key % 89 = 0 THEN 'x' || part_key
    ELSE coalesce(p.taxid, '0') END AS taxid
  FROM hits h LEFT JOIN proteins p ON p.protein_id = h.subject_id)"""


def _members(d: Domain) -> DataFrame:
    taxid = (
        F.when(F.col("part_key") % 97 == 0, "")
        .when(F.col("part_key") % 89 == 0, F.concat(F.lit("x"), F.col("part_key").cast("string")))
        .otherwise(F.col("subject_taxid"))
    )
    return annotate(d.hits, d.protein_catalogue, d.params).select(
        *READ_KEYS, taxid.alias("taxid")
    )


@query("lca", f"""
SELECT sample_id, "end", read_id, lca FROM ({lca_sql(_MEMBERS, 'sample_id, "end", read_id')})""")
def _(d: Domain) -> DataFrame:
    return taxonomy.lowest_common_ancestor(_members(d), READ_KEYS, d.taxa)


@query("lca_ranked", f"""
SELECT g.sample_id, g."end", g.read_id, CASE WHEN g.n = 1 AND g.one <> '' THEN g.one
  ELSE coalesce(l.lca, '0') END AS lca
FROM (SELECT sample_id, "end", read_id, count(DISTINCT taxid) AS n, min(taxid) AS one
  FROM {_MEMBERS} GROUP BY ALL) g
LEFT JOIN (
  SELECT sample_id, "end", read_id, arg_max(one, rank_no) FILTER (rank_no < coalesce(split, 99)) AS lca
  FROM (SELECT *, min(CASE WHEN n > 1 THEN rank_no END)
      OVER (PARTITION BY sample_id, "end", read_id) AS split
    FROM (SELECT m.sample_id, m."end", m.read_id, r.rank_no, count(DISTINCT a.anc) AS n,
        min(a.anc) AS one
      FROM {_MEMBERS} m JOIN anc a ON a.taxid = m.taxid AND m.taxid <> '0'
      JOIN ranks r ON r.rank = a.anc_rank AND r.rank_no > 0 GROUP BY ALL))
  GROUP BY ALL) l USING (sample_id, "end", read_id)""")
def _(d: Domain) -> DataFrame:
    return taxonomy.lowest_common_ranked_ancestor(_members(d), READ_KEYS, d.taxa)


@query("sample_lca", f"""
SELECT sample_id, lca, t.name FROM ({lca_sql(
    "(SELECT sample_id, taxonomy AS taxid FROM pr_ann WHERE taxonomy IS NOT NULL)", "sample_id")})
JOIN taxonomy t ON t.taxid = lca""")
def _(d: Domain) -> DataFrame:
    members = d.annotated_proteins.where(F.col("taxonomy").isNotNull()).select(
        "sample_id", F.col("taxonomy").alias("taxid")
    )
    lca = taxonomy.lowest_common_ancestor(members, ["sample_id"], d.taxa)
    return lca.join(d.taxa.select(F.col("taxid").alias("lca"), "name"), "lca")


@query("hit_taxon_backoff", """
SELECT sample_id, "end", read_id, subject_id, ord, q_start, q_end,
  CASE WHEN pr.protein_id IS NULL THEN CASE WHEN h.identity >= 50.0 THEN '0' END
    ELSE arg_min(st.anc, st.distance) FILTER (h.identity >= st.min_identity) END AS supported
FROM hits h LEFT JOIN proteins pr ON pr.protein_id = h.subject_id
LEFT JOIN protein_steps st ON st.protein_id = h.subject_id
GROUP BY h.sample_id, h."end", h.read_id, h.subject_id, h.ord, h.q_start, h.q_end, pr.protein_id,
  h.identity, h.length, h.mismatch, h.s_start, h.s_end, h.searched, h.bitscore""", fill={"supported": ""})
def _(d: Domain) -> DataFrame:
    annotated = annotate(d.hits, d.protein_catalogue, d.params)
    return annotated.select(
        *READ_KEYS, "subject_id", "ord", "q_start", "q_end",
        supported_step()["taxid"].alias("supported"),
    )
