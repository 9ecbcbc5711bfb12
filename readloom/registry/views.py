"""SQL views of the oracle: the adapters' rules and the classification in plain relational SQL.

The oracle reaches its answers another way than the Spark jobs: windows, unnested lists and one
row per (hit, function) instead of folded arrays and pre-aggregated levels.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}

VIEWS["taxonomy"] = """
SELECT '1' AS taxid, 'root' AS name, 'norank' AS rank, '1' AS parent
UNION ALL SELECT '0', 'Unknown', 'norank', '1'
UNION ALL SELECT '131567', 'cellular organisms', 'no rank', '1'
UNION ALL SELECT CAST(10 + r_regionkey AS VARCHAR), r_name, 'superkingdom',
  CASE WHEN r_regionkey = 4 THEN '1' ELSE '131567' END FROM region
UNION ALL SELECT CAST(100 + n_nationkey AS VARCHAR), n_name, 'phylum',
  CAST(10 + n_regionkey AS VARCHAR) FROM nation
UNION ALL SELECT CAST(500 + n_nationkey AS VARCHAR), 'Clade (' || n_nationkey || ')', 'no rank',
  CAST(100 + n_nationkey AS VARCHAR) FROM nation
UNION ALL SELECT CAST(1000 + s_suppkey AS VARCHAR), s_name,
  CASE WHEN s_suppkey % 3 = 0 THEN 'genus' ELSE 'species' END,
  CAST(CASE WHEN s_suppkey % 2 = 0 THEN 500 ELSE 100 END + s_nationkey AS VARCHAR) FROM supplier
"""

VIEWS["ranks"] = """
SELECT unnest(['norank','superkingdom','phylum','class','order','family','genus','species'])
  AS rank, unnest(range(8)) AS rank_no
"""

# Every taxon with its ancestors, itself at distance 0.
VIEWS["closure"] = """
SELECT taxid, taxid AS anc, parent AS nxt, 0 AS distance FROM taxonomy
UNION ALL
SELECT c.taxid, t.taxid, t.parent, c.distance + 1
FROM closure c JOIN taxonomy t ON t.taxid = c.nxt WHERE c.anc <> '1'
"""

VIEWS["anc"] = """
SELECT c.taxid, c.anc, c.distance, t.rank AS anc_rank, t.name AS anc_name,
  t.rank IN (SELECT rank FROM ranks) AS ranked
FROM closure c JOIN taxonomy t ON t.taxid = c.anc
"""

# Lineage used by an LCA: without the root, except right below it.
VIEWS["lca_path"] = """
SELECT taxid, CASE WHEN taxid = '1' THEN ['1', '1'] WHEN len(p) = 2 THEN p ELSE p[2:] END AS lin
FROM (SELECT taxid, list(anc ORDER BY distance DESC) AS p FROM closure GROUP BY taxid)
"""

VIEWS["ranked_parent"] = """
SELECT t.taxid,
  CASE WHEN t.taxid = '1' THEN '1' ELSE coalesce(a.anc, '0') END AS parent,
  CASE WHEN t.taxid = '1' THEN 'norank' ELSE coalesce(a.anc_rank, 'norank') END AS parent_rank
FROM taxonomy t LEFT JOIN (
  SELECT taxid, arg_min(anc, distance) AS anc, arg_min(anc_rank, distance) AS anc_rank
  FROM anc WHERE ranked AND distance > 0 GROUP BY taxid) a ON a.taxid = t.taxid
"""

VIEWS["lineage"] = """
SELECT t.taxid, CASE WHEN t.taxid = '1' THEN '' ELSE
  replace(replace(replace(coalesce(a.names || '_', '') || t.name, ' ', '_'), '(', '_'), ')', '_')
  END AS lineage
FROM taxonomy t LEFT JOIN (
  SELECT taxid, string_agg(anc_name, '_' ORDER BY distance DESC) AS names
  FROM anc WHERE ranked AND distance > 0 AND anc <> '1' GROUP BY taxid) a ON a.taxid = t.taxid
"""

VIEWS["proteins"] = """
SELECT 'P' || p_partkey AS protein_id,
  CASE WHEN p_partkey % 41 = 0 THEN '0'
    ELSE CAST(1000 + p_partkey % (SELECT count(*) FROM supplier) AS VARCHAR) END AS taxid,
  CASE WHEN p_partkey % 7 = 0 AND 'Brand#' || (1 + p_size % 25) <> p_brand
    THEN [p_brand, 'Brand#' || (1 + p_size % 25)] ELSE [p_brand] END AS functions,
  p_type AS source
FROM part WHERE p_partkey % 13 <> 0
"""

VIEWS["functions"] = """
SELECT function, 'Function ' || k AS name, 'G' || (k % 4) AS grp,
  CASE WHEN k % 5 <> 0 THEN 50.0::DOUBLE + 5 * (k % 4) END AS function_cutoff
FROM (SELECT DISTINCT p_brand AS function, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS k
  FROM part)
"""

VIEWS["cutoffs"] = """
SELECT f.function, r.rank, CASE WHEN f.function_cutoff IS NULL THEN 50.0
  WHEN r.rank = 'norank' THEN f.function_cutoff ELSE 45.0 + 5 * r.rank_no END::DOUBLE AS cutoff
FROM functions f CROSS JOIN ranks r
"""

# Identity each protein's hit needs, in total and at each rank.
VIEWS["protein_cutoffs"] = """
SELECT p.protein_id, max(coalesce(f.function_cutoff, 50.0)) AS identity_cutoff
FROM (SELECT protein_id, unnest(functions) AS function FROM proteins) p
LEFT JOIN functions f ON f.function = p.function GROUP BY p.protein_id
"""

VIEWS["protein_steps"] = """
SELECT p.protein_id, a.anc, a.distance, least(100.0, min(c.cutoff)) AS min_identity
FROM (SELECT protein_id, taxid, unnest(functions) AS function FROM proteins) p
JOIN anc a ON a.taxid = p.taxid AND a.ranked AND a.anc <> '1'
JOIN cutoffs c ON c.function = p.function AND c.rank = a.anc_rank
GROUP BY p.protein_id, a.anc, a.distance
"""

VIEWS["hits"] = """
SELECT 'S' || substr(o_orderpriority, 1, 1) AS sample_id,
  CASE WHEN l_linestatus = 'F' THEN 'pe1' ELSE 'pe2' END AS "end",
  'R' || l_orderkey AS read_id, 'P' || l_partkey AS subject_id,
  50.0::DOUBLE + ((37 * l_partkey + 11 * l_suppkey) % 500)::DOUBLE / 10.0 AS identity,
  10 + CAST(l_quantity AS INTEGER) AS length, CAST(l_suppkey % 10 AS INTEGER) AS mismatch,
  60 + 10 * p_size AS s_len,
  CAST(CASE WHEN l_suppkey % 2 = 0 THEN 1 + l_partkey % 80
    ELSE l_partkey % 80 + 3 * (10 + CAST(l_quantity AS INTEGER)) END AS INTEGER) AS q_start,
  CAST(CASE WHEN l_suppkey % 2 = 0 THEN l_partkey % 80 + 3 * (10 + CAST(l_quantity AS INTEGER))
    ELSE 1 + l_partkey % 80 END AS INTEGER) AS q_end,
  CAST(1 + l_suppkey % 50 AS INTEGER) AS s_start,
  CAST(l_suppkey % 50 + 10 + CAST(l_quantity AS INTEGER) AS INTEGER) AS s_end,
  1e-5::DOUBLE AS evalue,
  40.0::DOUBLE + (13 * l_partkey + 7 * l_linenumber) % 50 AS bitscore,
  CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS ord,
  CASE WHEN l_returnflag = 'A' THEN 'ref' ELSE 'bg' END AS searched,
  l_orderkey AS order_key, l_partkey AS part_key
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
"""

VIEWS["samples"] = """
SELECT sample_id, 'Sample ' || substr(sample_id, 2) AS sample_name,
  CAST(CAST(substr(sample_id, 2) AS INTEGER) - 1 AS VARCHAR) AS replicate,
  count(DISTINCT CASE WHEN "end" = 'pe1' THEN read_id END) AS fwd_reads,
  count(DISTINCT CASE WHEN "end" = 'pe2' THEN read_id END) AS rev_reads,
  150 * count(DISTINCT CASE WHEN "end" = 'pe1' THEN read_id END) AS fwd_bases,
  150 * count(DISTINCT CASE WHEN "end" = 'pe2' THEN read_id END) AS rev_bases,
  3.0e6::DOUBLE AS genome_size,
  CASE WHEN sample_id = 'S5' THEN 0.0 ELSE 300.0 END::DOUBLE AS insert_size
FROM hits GROUP BY sample_id
"""

_FIELDS = ("ord, subject_id, q_start, q_end, identity, length, mismatch, s_len, s_start, s_end, "
           "evalue, bitscore")
_KEY = 'sample_id, "end", read_id'


def _overlap(n: str, k: str, c: int = 10) -> str:
    return (
        f"CASE WHEN {n}.q_start < {n}.q_end THEN {k}.q_start <= {k}.q_end "
        f"AND {k}.q_end >= {n}.q_start + {c} AND {k}.q_start <= {n}.q_end - {c} "
        f"WHEN {n}.q_start > {n}.q_end THEN {k}.q_start >= {k}.q_end "
        f"AND {k}.q_start >= {n}.q_end + {c} AND {k}.q_end <= {n}.q_start - {c} "
        f"ELSE true END"
    )


def _first_of_kind(source: str, keys: str) -> str:
    return f"""
SELECT * EXCLUDE (dup) FROM (SELECT *, row_number() OVER (
  PARTITION BY {keys}, subject_id, q_start, q_end
  ORDER BY ord, identity, length, mismatch, s_len, s_start, s_end, evalue, bitscore) AS dup
  FROM {source}) WHERE dup = 1
"""


def classification(
    prefix: str, reference: str, background: str, fixed_identity: bool = False,
    keep_good: bool = False, move_hits: bool = True, score: str = "1.0::DOUBLE",
) -> dict[str, str]:
    """Views ``<prefix>_cand`` to ``<prefix>_hits`` for one kind of query.

    ``reference`` and ``background`` name views shaped like ``hits``.
    """
    v: dict[str, str] = {}
    p = prefix
    accept = "length >= 15" + (" AND identity >= 50.0" if fixed_identity else "")
    v[f"{p}_ref"] = _first_of_kind(f"(SELECT * FROM {reference} WHERE {accept})", _KEY)
    v[f"{p}_fold"] = f"""
SELECT {_KEY}, list_reduce(
  list(struct_pack({', '.join(f'{x} := {x}' for x in _FIELDS.split(', '))})
    ORDER BY ord, subject_id, q_start, q_end).list_transform(lambda h: [h]),
  lambda acc, n: CASE WHEN len(list_filter(acc,
      lambda k: ({_overlap('n[1]', 'k')}) AND n[1].bitscore <= k.bitscore)) = 0
    THEN list_concat(list_filter(acc, lambda k: NOT ({_overlap('n[1]', 'k')})), n)
    ELSE acc END) AS kept
FROM {p}_ref GROUP BY {_KEY}
"""
    weak = "" if fixed_identity else "WHERE identity >= coalesce(pc.identity_cutoff, 50.0)"
    v[f"{p}_cand"] = f"""
SELECT {_KEY}, row_number() OVER (PARTITION BY {_KEY} ORDER BY pos) - 1 AS region_no,
  q_start AS r_start, q_end AS r_end, {_FIELDS}, functions, 
  count(*) OVER (PARTITION BY {_KEY}) AS n_regions
FROM (SELECT {_KEY}, pos, h.*, coalesce(pr.functions, ['']) AS functions
  FROM (SELECT {_KEY}, unnest(kept) AS h, unnest(range(len(kept))) AS pos FROM {p}_fold)
  LEFT JOIN proteins pr ON pr.protein_id = h.subject_id
  LEFT JOIN protein_cutoffs pc ON pc.protein_id = h.subject_id {weak.replace('identity >=', 'h.identity >=')})
"""
    v[f"{p}_bg"] = f"""
SELECT b.*, c.region_no, c.r_start, c.r_end, c.subject_id AS known_subject
FROM {background} b JOIN {p}_cand c USING (sample_id, "end", read_id)
WHERE c.region_no = (b.part_key + b.ord) % c.n_regions
"""
    v[f"{p}_bgd"] = f"""
SELECT b.*, coalesce(pr.functions, ['']) AS functions,
  b.identity >= coalesce(pc.identity_cutoff, 50.0) AS ok
FROM ({_first_of_kind(f"(SELECT * FROM {p}_bg WHERE length >= 15)", _KEY + ', region_no')}) b
LEFT JOIN proteins pr ON pr.protein_id = b.subject_id
LEFT JOIN protein_cutoffs pc ON pc.protein_id = b.subject_id
"""
    rk = _KEY + ", region_no"
    v[f"{p}_best"] = f"""
SELECT {rk}, max(CASE WHEN ok THEN bitscore END) AS best FROM {p}_bgd GROUP BY {rk}
"""
    v[f"{p}_band"] = f"""
SELECT {rk}, 0 AS src, {_FIELDS}, functions FROM {p}_bgd JOIN {p}_best USING ({rk})
WHERE ok AND bitscore > best * (1.0 - 0.03)
"""
    v[f"{p}_sel"] = f"""
SELECT * FROM {p}_band
UNION ALL
SELECT {rk}, 1, {_FIELDS}, functions FROM {p}_cand c JOIN {p}_best USING ({rk})
WHERE best > 0 AND c.bitscore >= best AND NOT EXISTS (SELECT 1 FROM {p}_band s
  WHERE s.sample_id = c.sample_id AND s."end" = c."end" AND s.read_id = c.read_id
    AND s.region_no = c.region_no AND s.subject_id = c.subject_id)
"""
    order = "src, ord, subject_id, q_start, q_end"
    v[f"{p}_selfn"] = f"""
SELECT *, unnest(functions) AS function, unnest(range(len(functions))) AS fpos FROM {p}_sel
"""
    v[f"{p}_votes"] = f"""
SELECT {rk}, function, count(*) AS votes FROM {p}_selfn
JOIN (SELECT {rk}, count(*) AS n FROM {p}_sel GROUP BY {rk}) USING ({rk})
GROUP BY {rk}, function, n HAVING 2 * count(*) > n
"""
    v[f"{p}_region"] = f"""
SELECT {rk}, r_start, r_end,
  CASE WHEN b.read_id IS NULL THEN 'unaccounted'
    WHEN v.n > 0 AND NOT v.unknown THEN 'function' ELSE 'nofunction' END AS status
FROM {p}_cand LEFT JOIN {p}_best b USING ({rk})
LEFT JOIN (SELECT {rk}, count(*) AS n, bool_or(function = '') AS unknown
  FROM {p}_votes GROUP BY {rk}) v USING ({rk})
"""
    v[f"{p}_picks"] = f"""
SELECT * EXCLUDE (pick), row_number() OVER (PARTITION BY {rk} ORDER BY first_seen) AS pick_no
FROM (SELECT s.*, row_number() OVER (PARTITION BY {rk}, function
      ORDER BY bitscore DESC, {order}) AS pick,
    min(struct_pack(a := src, b := ord, c := subject_id, d := q_start, e := q_end, f := fpos))
      OVER (PARTITION BY {rk}, function) AS first_seen
  FROM {p}_selfn s JOIN {p}_votes USING ({rk}, function)
  JOIN (SELECT {rk} FROM {p}_region WHERE status = 'function') USING ({rk})) WHERE pick = 1
"""
    v[f"{p}_taxa"] = f"""
SELECT {rk}, list(DISTINCT tax) FILTER (tax IS NOT NULL) AS ids FROM (
  SELECT {rk}, {order}, arg_min(anc, distance) AS tax FROM (
    SELECT DISTINCT {', '.join('s.' + x for x in (rk + ', ' + order).split(', '))},
      CASE WHEN pr.protein_id IS NULL THEN CASE WHEN s.identity >= 50.0 THEN '0' END
        WHEN s.identity >= st.min_identity THEN st.anc END AS anc,
      coalesce(st.distance, 0) AS distance
    FROM {p}_selfn s JOIN {p}_votes USING ({rk}, function)
    JOIN (SELECT {rk} FROM {p}_region WHERE status = 'function') USING ({rk})
    LEFT JOIN proteins pr ON pr.protein_id = s.subject_id
    LEFT JOIN protein_steps st ON st.protein_id = s.subject_id)
  WHERE anc IS NOT NULL GROUP BY {rk}, {order}) GROUP BY {rk}
"""
    v[f"{p}_lca"] = lca_sql(f"(SELECT {rk}, unnest(ids) AS taxid FROM {p}_taxa)", rk)
    if keep_good:
        status = "CASE WHEN bool_or(r.status = 'function') THEN 'function' ELSE "
        tail = " END"
    else:
        status, tail = "", ""
    v[f"{p}_ann"] = f"""
SELECT {_KEY}, {status}coalesce(arg_max(r.status, region_no) FILTER (r.status <> 'unaccounted'),
    'unaccounted'){tail} AS status,
  CASE WHEN bool_or(r.status = 'function') THEN coalesce(arg_max(coalesce(l.lca, '0'), region_no)
    FILTER (r.status = 'function'), '0') END AS taxonomy
FROM {p}_region r LEFT JOIN {p}_lca l USING ({rk}) GROUP BY {_KEY}
"""
    v[f"{p}_fn"] = f"""
SELECT {_KEY}, function, sum({score}) AS score FROM {p}_picks GROUP BY {_KEY}, function
"""
    coords = "r.r_start, r.r_end" if move_hits else "x.q_start, x.q_end"
    v[f"{p}_hits"] = f"""
SELECT * EXCLUDE (twin), row_number() OVER (PARTITION BY {_KEY} ORDER BY good, region_no, pick_no)
  AS hit_no
FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY}, subject_id, q_start, q_end
    ORDER BY good, region_no, pick_no) AS twin
  FROM (
    SELECT {rk}, 0 AS good, 0 AS pick_no, c.subject_id, c.identity, c.length, c.mismatch, c.s_len,
      c.q_start, c.q_end, c.s_start, c.s_end, c.evalue, c.bitscore, c.functions
    FROM {p}_cand c JOIN {p}_region r USING ({rk}) WHERE r.status <> 'function'
    UNION ALL
    SELECT {rk}, 1, x.pick_no, x.subject_id, x.identity, x.length, x.mismatch, x.s_len,
      {coords}, x.s_start, x.s_end, x.evalue, x.bitscore, x.functions
    FROM {p}_picks x JOIN {p}_region r USING ({rk})))
WHERE twin = 1
"""
    # Best hit of each function a read has, first on ties.
    v[f"{p}_fbest"] = f"""
SELECT {_KEY}, function, score, identity, s_len, bitscore
FROM (SELECT f.*, h.identity, h.s_len, h.bitscore, row_number() OVER (
    PARTITION BY {_KEY}, f.function ORDER BY h.bitscore DESC NULLS LAST, h.hit_no) AS best
  FROM {p}_fn f LEFT JOIN (SELECT *, unnest(functions) AS function FROM {p}_hits) h
    USING ({_KEY}, function)) WHERE best = 1
"""
    return v


def lca_sql(members: str, keys: str) -> str:
    """LCA per group, level by level; ``members`` has the keys and a taxid."""
    on = f"USING ({keys})"
    return f"""
SELECT g.*, CASE WHEN n = 1 THEN CASE WHEN one = '' THEN '0' ELSE one END
  WHEN l.lca IS NULL THEN '0' ELSE l.lca END AS lca
FROM (SELECT {keys}, count(DISTINCT taxid) AS n, min(taxid) AS one FROM {members} GROUP BY {keys}) g
LEFT JOIN (
  SELECT {keys}, arg_max(id, lvl) FILTER (lvl < coalesce(split, 10000)) AS lca
  FROM (SELECT *, min(CASE WHEN NOT same THEN lvl END) OVER (PARTITION BY {keys}) AS split
    FROM (SELECT {keys}, lvl, min(id) AS id,
        count(DISTINCT id) = 1 AND count(*) = any_value(members) AS same
      FROM (SELECT {keys}, members, unnest(lin) AS id, unnest(range(len(lin))) AS lvl
        FROM (SELECT DISTINCT {keys}, m.taxid, p.lin,
            count(DISTINCT m.taxid) OVER (PARTITION BY {keys}) AS members
          FROM {members} m JOIN lca_path p ON p.taxid = m.taxid WHERE m.taxid <> '0'))
      GROUP BY {keys}, lvl))
  GROUP BY {keys}) l {on}
"""


_ERPK = ("CASE WHEN 3 * s_len - 90 + 150 + 1 > 1 THEN 1000.0::DOUBLE / (3 * s_len - 90 + 150 + 1) "
         "ELSE 1000.0 END::DOUBLE")

VIEWS["ref_hits"] = "SELECT * FROM hits WHERE searched = 'ref'"
VIEWS["bg_hits"] = "SELECT * FROM hits WHERE searched = 'bg'"
VIEWS.update(classification("rd", "ref_hits", "bg_hits", score=_ERPK))

# Text, proteins and assembly ---------------------------------------------------------------

VIEWS["read_texts"] = """
SELECT doc_id, "end", '@' || CASE
    WHEN doc_id % 5 = 0 THEN name || '/' || n
    WHEN doc_id % 5 = 1 THEN name || ' ' || n || ':N:0:AAG'
    WHEN doc_id % 5 = 2 THEN name || '.' || n || ' ' || n || ' length=9'
    WHEN doc_id % 5 = 3 AND doc_id % 2 = 1 THEN name || '.7.' || n
    WHEN doc_id % 5 = 3 THEN 'WP_0' || doc_id || '.1'
    ELSE name || ' b c d' END AS header,
  sequence, '+' AS line3, repeat('I', length(sequence)) AS quality,
  CASE WHEN doc_id % 5 = 3 AND doc_id % 2 = 1 THEN name || '.7'
    WHEN doc_id % 5 = 3 THEN 'WP_0' || doc_id || '.1' ELSE name END AS read_id,
  CASE WHEN doc_id % 5 < 3 OR (doc_id % 5 = 3 AND doc_id % 2 = 1) THEN n ELSE '' END AS read_end
FROM (SELECT doc_id, 'R' || doc_id AS name, e AS "end", substr(e, 3) AS n,
    CASE WHEN e = 'pe1' THEN letters ELSE reverse(letters) END AS sequence
  FROM (SELECT doc_id, upper(regexp_replace(text, '[^A-Za-z]', 'N', 'g')) AS letters
    FROM documents) CROSS JOIN (SELECT unnest(['pe1', 'pe2']) AS e))
"""

VIEWS["sizes"] = """
SELECT (SELECT 5 * count(*) FROM supplier) AS contig_count,
  (SELECT count(*) FROM part) AS part_count
"""

VIEWS["protein_hits"] = """
SELECT sample_id, 'pe1' AS "end", 'xC' || (order_key % contig_count) || '_' || order_key AS read_id,
  subject_id, identity, length, mismatch, s_len, CAST(1 + part_key % 40 AS INTEGER) AS q_start,
  CAST(part_key % 40 + length AS INTEGER) AS q_end, s_start, s_end, evalue, bitscore, ord,
  searched, order_key, part_key FROM hits CROSS JOIN sizes
"""
VIEWS["protein_ref"] = "SELECT * FROM protein_hits WHERE searched = 'ref'"
VIEWS["protein_back"] = "SELECT * FROM protein_hits WHERE searched = 'bg'"

VIEWS["coverage"] = """
SELECT 'S' || substr(o_orderpriority, 1, 1) AS sample_id,
  'C' || (l_orderkey % contig_count) AS contig_id, avg(l_quantity) / 10.0 AS coverage
FROM lineitem JOIN orders ON l_orderkey = o_orderkey CROSS JOIN sizes
WHERE (l_orderkey % contig_count) % 7 <> 0 GROUP BY ALL
"""

VIEWS["protein_abundance"] = """
SELECT p.sample_id, p."end", p.read_id, coalesce(c.coverage, 1.0) AS coverage,
  coalesce(c.coverage, 1.0) / coalesce(a.average, 1.0) AS abundance
FROM (SELECT DISTINCT sample_id, "end", read_id FROM protein_ref) p
LEFT JOIN coverage c ON c.sample_id = p.sample_id
  AND c.contig_id = substr(split_part(p.read_id, '_', 1), 2)
LEFT JOIN (SELECT sample_id, avg(coverage) AS average FROM coverage GROUP BY sample_id) a
  ON a.sample_id = p.sample_id
"""
VIEWS["protein_texts"] = """
SELECT 'S' || substr(o_orderpriority, 1, 1) AS sample_id,
  'xC' || (o_orderkey % contig_count) || '_' || o_orderkey || ' predicted protein' AS header,
  'xC' || (o_orderkey % contig_count) || '_' || o_orderkey AS read_id,
  substr(repeat('MKVLA', 80), 1, CAST(100 + o_orderkey % 300 AS INTEGER)) AS sequence
FROM orders CROSS JOIN sizes
"""

VIEWS["contigs"] = """
SELECT 'Brand#' || (1 + k % 25) AS function, 'C' || k AS contig_id,
  substr(repeat('ACGTN', 131), CAST(1 + k % 5 AS INTEGER), CAST(250 + (37 * k) % 400 AS INTEGER))
    AS sequence
FROM (SELECT DISTINCT p_partkey % contig_count AS k FROM part CROSS JOIN sizes)
"""

VIEWS["assembled_lines"] = """
SELECT 'Brand#' || (1 + (l_orderkey % contig_count) % 25) AS function,
  'C' || (l_orderkey % contig_count) AS contig_id, 'L' || l_orderkey || '_' || l_linenumber AS read_id,
  'S' || substr(o_orderpriority, 1, 1) AS sample_id,
  50 + CAST(l_quantity AS INTEGER) AS aligned_length, l_returnflag
FROM lineitem JOIN orders ON l_orderkey = o_orderkey CROSS JOIN sizes
"""
VIEWS["assembly_reads"] = """
SELECT function, read_id, min(sample_id) AS sample_id FROM assembled_lines GROUP BY ALL
"""
VIEWS["alignments"] = """
SELECT function, contig_id, read_id, aligned_length FROM assembled_lines WHERE l_returnflag <> 'R'
"""
VIEWS["contig_samples"] = """
SELECT a.function, a.contig_id, r.sample_id, count(*) AS read_count,
  CAST(sum(a.aligned_length) AS BIGINT) AS segment_length
FROM alignments a JOIN contigs c ON c.function = a.function AND c.contig_id = a.contig_id
JOIN assembly_reads r ON r.function = a.function AND r.read_id = a.read_id GROUP BY ALL
"""
VIEWS["contig_series"] = """
SELECT function, contig_id, sample_id, read_count, segment_length FROM contig_samples
UNION ALL SELECT c.function, c.contig_id, 'All samples', CAST(coalesce(sum(read_count), 0) AS BIGINT),
  CAST(coalesce(sum(segment_length), 0) AS BIGINT)
FROM contigs c LEFT JOIN contig_samples s USING (function, contig_id)
GROUP BY c.function, c.contig_id
"""
VIEWS["contig_coverage"] = """
SELECT function, contig_id, sample_id, length(sequence) AS length, read_count,
  segment_length / length(sequence)::DOUBLE AS coverage
FROM contig_series JOIN contigs USING (function, contig_id)
"""
VIEWS["libraries"] = """
SELECT sample_id, fwd_reads AS reads, fwd_reads AS reads_both FROM samples
UNION ALL SELECT 'All samples', sum(fwd_reads), sum(fwd_reads + rev_reads) FROM samples
"""
VIEWS["genes"] = """
SELECT 'Brand#' || (1 + k % 25) || '|C' || k || '_' || p AS gene_id,
  'Brand#' || (1 + k % 25) AS function, 'C' || k AS contig_id,
  CAST(s AS INTEGER) AS gene_start,
  CAST(least(250 + (37 * k) % 400, s + 3 * n - 1) AS INTEGER) AS gene_end,
  CASE WHEN p % 2 = 0 THEN '1' ELSE '-1' END AS strand,
  substr(repeat('MKVLA', 113), 1, n) AS protein_sequence, p AS part_key
FROM (SELECT p_partkey AS p, p_partkey % contig_count AS k, 1 + 7 * p_partkey % 60 AS s,
  60 + 10 * p_size AS n FROM part CROSS JOIN sizes)
"""
VIEWS["gene_hits"] = """
SELECT '' AS sample_id, '' AS "end", 'Brand#' || (1 + k % 25) || '|C' || k || '_' || p AS read_id,
  subject_id, identity, length, mismatch, s_len, CAST(1 + part_key % 40 AS INTEGER) AS q_start,
  CAST(part_key % 40 + length AS INTEGER) AS q_end, s_start, s_end, evalue, bitscore, ord,
  searched, order_key, part_key
FROM (SELECT *, (order_key % part_count) % contig_count AS k, order_key % part_count AS p
  FROM hits CROSS JOIN sizes)
"""
VIEWS["gene_ref"] = "SELECT * FROM gene_hits WHERE searched = 'ref'"
VIEWS["gene_back"] = "SELECT * FROM gene_hits WHERE searched = 'bg'"
VIEWS["gene_abundance"] = """
SELECT DISTINCT '' AS sample_id, '' AS "end", read_id, c.coverage / (SELECT avg(coverage)
  FROM contig_coverage WHERE sample_id = 'All samples') AS abundance
FROM gene_ref JOIN genes g ON g.gene_id = read_id
JOIN contig_coverage c ON c.function = g.function AND c.contig_id = g.contig_id
  AND c.sample_id = 'All samples'
"""
VIEWS.update(classification("pr", "protein_ref", "protein_back", move_hits=False, score="abundance"))
VIEWS["pr_fn"] = VIEWS["pr_fn"].replace(
    "FROM pr_picks", 'FROM pr_picks JOIN protein_abundance USING (sample_id, "end", read_id)')
VIEWS.update(classification("gn", "gene_ref", "gene_back", fixed_identity=True, keep_good=True,
                            move_hits=False, score="abundance"))
VIEWS["gn_fn"] = VIEWS["gn_fn"].replace(
    "FROM gn_picks", 'FROM gn_picks JOIN gene_abundance USING (sample_id, "end", read_id)')

_WORD = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def with_views(body: str) -> str:
    """Prepend the views a query needs, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in _WORD.findall(text):
            if word in VIEWS and word not in needed and word not in open_names:
                open_names.append(word)
                visit(VIEWS[word])
                needed.append(word)

    open_names: list[str] = []
    visit(body)
    if not needed:
        return body
    parts = [f"{name} AS ({VIEWS[name].strip()})" for name in needed]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + body.strip()
