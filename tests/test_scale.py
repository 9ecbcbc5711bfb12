"""Plans and memory where tables are large: catalogues that cannot be broadcast, hot keys, huge queries."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from readloom import session
from readloom.adapters import READ_KEYS, Domain
from readloom.operators import catalogue, hits, skew, taxonomy
from readloom.registry.core import domain, runnable


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def children(plan: str, node: str) -> list[str]:
    """Subtrees below the only node of this name in a plan's tree."""
    lines = plan.splitlines()
    [at] = [k for k, line in enumerate(lines) if node in line]
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    below = []
    for line in lines[at + 1:]:
        if depth(line) <= depth(lines[at]):
            break
        below.append(line)
    first = min(map(depth, below))
    cuts = [k for k, line in enumerate(below) if depth(line) == first] + [len(below)]
    return ["\n".join(below[a:b]) for a, b in zip(cuts, cuts[1:])]


# Overlap fold --------------------------------------------------------------------------------

def batches_of(n: int, size: int, queries: int):
    """Hits sorted by query and order, one batch after the other; the same for every ``size``."""
    at = 0
    while at < n:
        k = np.arange(at, min(at + size, n))
        start = (k * 7919) % 900 + 1
        yield pa.RecordBatch.from_arrays([
            pa.array([f"q{i:03d}" for i in (k * queries // n).tolist()]), pa.array(k),
            pa.array((k % 97).astype(str)), pa.array(start), pa.array(start + 20 + (k * 31) % 60),
            pa.array(((k * 104729) % 1009).astype(float))],
            ["query_id", "ord", "subject_id", "q_start", "q_end", "bitscore"])
        at += size


def test_fold_is_the_same_for_every_cut_into_batches():
    runs = []
    for size in (1, 7, 1000, 6000):
        rows = [r for b in hits.fold_batches(1, 10)(batches_of(6000, size, 40)) for r in b.to_pylist()]
        assert [r["query_id"] for r in rows] == [f"q{i:03d}" for i in range(40)]
        runs.append(rows)
    assert all(r == runs[0] for r in runs)


def test_fold_of_one_huge_query_holds_its_kept_hits_only():
    held = []

    def watched():
        for batch in batches_of(1_000_000, 10_000, 1):
            held.append(pa.total_allocated_bytes())
            yield batch

    before = pa.total_allocated_bytes()
    [row] = [r for b in hits.fold_batches(1, 10)(watched()) for r in b.to_pylist()]
    assert row["query_id"] == "q000" and 0 < len(row["hits"]) < 100
    # Two batches of less than 1 MB and the kept hits.
    assert max(held) - before < 8 << 20


# LCA -----------------------------------------------------------------------------------------

def test_lca_aggregates_are_hash_aggregates_of_numbers(spark, folder):
    d = domain(spark, folder)
    members = d.hits.select(*READ_KEYS, F.col("part_key").cast("string").alias("taxid"))
    for find in (taxonomy.lowest_common_ancestor, taxonomy.lowest_common_ranked_ancestor):
        plan = plan_of(find(members, READ_KEYS, d.taxa))
        assert "SortAggregate" not in plan
        # No lineage travels: neither trail nor path is in a shuffle.
        for exchange in re.findall(r"Exchange hashpartitioning.*", plan):
            assert "trail" not in exchange and "path" not in exchange


# Catalogues that are not broadcast ----------------------------------------------------------

@pytest.fixture
def no_broadcast(spark, monkeypatch):
    for module in (session, catalogue):
        monkeypatch.setattr(module, "is_small", lambda *_: False)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucketed_catalogue_is_not_moved(spark, folder, no_broadcast):
    d = Domain(spark, folder)
    proteins = d.protein_catalogue
    plan = plan_of(catalogue.annotate(d.reference_hits, proteins, d.params))
    assert "Bucketed: true" in plan
    [left, right] = children(plan, "SortMergeJoin [subject_id")
    assert "Exchange hashpartitioning(subject_id" in left
    assert "Exchange" not in right and "Bucketed: true" in right


def test_hot_subjects_keep_their_rows_in_place(spark, folder, no_broadcast):
    d = Domain(spark, folder)
    proteins = d.protein_catalogue
    [known] = proteins.select("protein_id").limit(1).collect()
    rows = spark.range(3000).select(
        F.when(F.col("id") < 2000, known["protein_id"]).when(F.col("id") < 2500, "absent")
        .otherwise(F.concat(F.lit("P"), F.col("id").cast("string"))).alias("subject_id"), "id")
    entries = proteins.select(F.col("protein_id").alias("subject_id"), "taxid")
    got = skew.join_dimension(rows, entries, "subject_id", hot_minimum=100)
    want = rows.join(entries, "subject_id", "left")
    key = lambda r: (r["id"], r["subject_id"], r["taxid"])
    assert sorted(map(key, got.collect()), key=str) == sorted(map(key, want.collect()), key=str)


def test_rows_joined_to_a_large_dimension_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(1000).select("id", (F.col("id") % 7).alias("subject_id")).mapInArrow(
        counted, "id long, subject_id long")
    entries = spark.range(7).select(F.col("id").alias("subject_id"), F.lit("x").alias("taxid"))
    assert skew.join_dimension(rows, entries, "subject_id", hot_minimum=100).count() == 1000
    assert seen.value == 1000


def test_classification_is_the_same_without_broadcasts(spark, folder, monkeypatch):
    key = lambda r: tuple(r[k] for k in READ_KEYS)
    columns = [*READ_KEYS, "status", "functions", "taxonomy"]
    want = {key(r): r for r in domain(spark, folder).classified_reads().select(*columns).collect()}
    for module in (session, catalogue):
        monkeypatch.setattr(module, "is_small", lambda *_: False)
    monkeypatch.setattr(skew, "HOT_MINIMUM", 20)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {key(r): r for r in Domain(spark, folder).classified_reads().select(*columns).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == want


def test_hits_of_a_query_move_together_once(spark, folder, no_broadcast):
    plan = plan_of(Domain(spark, folder).classified_reads())
    moves = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    # By subject and by query; neither copies nor shares of a region move on their own.
    assert any(m.startswith("subject_id") for m in moves)
    assert not any("r_start" in m for m in moves)


def test_hot_subjects_and_queries_change_no_gene(spark, folder, no_broadcast, monkeypatch):
    rows = lambda d: sorted(map(str, d.classified_genes().collect()))
    want = rows(domain(spark, folder))
    monkeypatch.setattr(skew, "HOT_MINIMUM", 8)
    assert rows(Domain(spark, folder)) == want


def test_hot_buckets_are_those_of_hot_keys(spark):
    rows = spark.range(4000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("k"))
    [hot], limit = skew.hot_buckets(rows, ["k"], hot_minimum=500)
    assert limit == 500
    assert rows.where(skew.in_buckets(["k"], [hot]) & (F.col("k") == 7)).count() == 1000


def test_copies_meet_the_dimension_once(spark):
    """Three copies of each row, rows without a key among them; the first of them is kept."""
    rows = spark.range(600).select(
        F.when(F.col("id") % 10 != 0, F.col("id") % 5).alias("k"), (F.col("id") % 200).alias("v"),
        "id")
    entries = spark.range(4).select(F.col("id").alias("k"), F.concat(F.lit("x"), "id").alias("name"))
    first = lambda df: df.groupBy("k", "v").agg(F.min("id").alias("id"))
    want = sorted(map(str, first(rows).join(entries, "k", "left").select("k", "v", "id", "name").collect()))
    for minimum in (10, 10_000):
        got = skew.join_dimension(rows, entries, "k", hot_minimum=minimum, reduce=first)
        assert sorted(map(str, got.select("k", "v", "id", "name").collect())) == want


def test_deduplication_hashes_without_a_sort(spark, folder):
    d = domain(spark, folder)
    plan = plan_of(hits.deduplicate(d.hits, READ_KEYS))
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and "HashAggregate" in plan
    assert "Sort [" not in plan


def test_taxon_reports_start_from_one_written_profile(spark, folder):
    d = domain(spark, folder)
    table = runnable("report_taxon_sample")(spark, folder)
    assert len(re.findall(r"Exchange hashpartitioning", plan_of(table))) < 20


# Rows that are dealt out by order -------------------------------------------------------------

def test_rows_of_an_order_meet_its_candidates_where_they_are(spark, folder, no_broadcast):
    moves = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan_of(Domain(spark, folder).background_hits))
    assert any("orderkey" in m for m in moves)
    assert not any("read_id" in m for m in moves)


def test_regions_by_order_are_those_by_name(spark, folder):
    """An order in two samples and ends, one without candidates, negative and missing names, copies."""
    schema = "sample_id string, end string, read_id string, part_key long, ord long, order_key long"
    rows = spark.createDataFrame(
        [(s, e, None if k is None else f"R{k}", p, o, k)
         for k in (1, 2, -3, None) for s in ("S1", "S2", None) for e in ("pe1", "pe2")
         for p, o in ((5, 8), (6, 9), (6, 9), (7, 11), (None, 12))], schema)
    found = spark.createDataFrame(
        [("S1", "pe1", "R1", [(1, 9), (20, 30)]), ("S1", "pe2", "R1", [(3, 4)]), ("S2", "pe1", "R1", [(7, 8)]),
         (None, "pe1", "R1", [(1, 2)]), ("S2", "pe2", "R-3", [(5, 6), (5, 7), (5, 8)]), ("S1", "pe1", None, [(2, 2)])],
        "sample_id string, end string, read_id string, hits array<struct<q_start int, q_end int>>")
    d = Domain(spark, folder)
    by_name = d.place_in_regions(rows, found, READ_KEYS)
    by_order = d.place_in_regions(rows, found, READ_KEYS, F.substring("read_id", 2, 30).cast("bigint"))
    assert by_order.columns == by_name.columns
    want = sorted(map(str, by_name.collect()))
    assert len(want) == 4 * 5 and sorted(map(str, by_order.collect())) == want


def test_samples_count_the_orders_of_their_hits(spark, tmp_path):
    """Repeated lines, parts and orders, orders in two samples, and missing keys, ends and priorities."""
    lines = [(k, p, 1, 7, 10.0, "A", s) for k in (1, 2, 2, 3, 4, None, 9) for p, s in
             ((1, "F"), (1, "F"), (2, "O"), (5, "F"), (None, "F"))] + [(3, 2, 1, 7, 10.0, None, None), (5, 1, 1, 7, 1.0, "R", None)]
    spark.createDataFrame(
        lines, "l_orderkey long, l_partkey long, l_linenumber int, l_suppkey long, l_quantity double,"
        " l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(
        [(1, "1-URGENT"), (1, "1-URGENT"), (2, "1-URGENT"), (2, "2-HIGH"), (3, None), (3, "5-LOW"), (4, "4-X"), (5, "2-HIGH"),
         (None, "3-X")], "o_orderkey long, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 3), (2, 4), (2, 4), (None, 5)], "p_partkey long, p_size int").write.parquet(
        f"{tmp_path}/part.parquet")
    d = Domain(spark, str(tmp_path))
    of = lambda e: F.count_if(F.col("end") == e)
    want = d.hits.select("sample_id", "end", "order_key").distinct().groupBy("sample_id").agg(of("pe1"), of("pe2"))
    got = d.samples.select("sample_id", "fwd_reads", "rev_reads")
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert rows(got) == rows(want) and len(rows(got)) == 5


def test_lists_are_collected_from_sorted_rows_within_a_block_only(spark):
    table = spark.range(10).groupBy(F.col("id") % 3).agg(F.collect_list("id"))
    with pytest.raises(KeyError), session.sorted_groups(spark):
        assert "ObjectHashAggregate" not in plan_of(table.select("*"))
        raise KeyError
    assert "ObjectHashAggregate" in plan_of(table.select("*"))
