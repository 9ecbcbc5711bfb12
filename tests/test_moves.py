"""What moves, sorts and is computed how often where tables are large."""

from __future__ import annotations

import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from readloom.adapters import READ_KEYS, Domain
from readloom import session
from readloom.operators import assembly, catalogue, classify, hits, sequences
from readloom.params import RunParams
from readloom.registry import files
from readloom.registry import runs as run_queries
from readloom.registry.core import runnable


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df) -> list[str]:
    return sorted(map(str, df.collect()))


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    for module in (session, catalogue, sequences):
        monkeypatch.setattr(module, "is_small", lambda *_: False)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# Classification and fold ---------------------------------------------------------------------

def test_queries_are_sorted_by_a_number_before_their_names(spark, folder, no_broadcast):
    d = Domain(spark, folder)
    plan = plan_of(d.classified_reads())
    assert re.search(r"Exchange hashpartitioning\(_lead", plan)
    assert not re.search(r"Sort \[sample_id#\d+ ASC NULLS FIRST, end#\d+ ASC NULLS FIRST, read_id", plan)
    # One window of a region tells its best bit-score and its known hit.
    assert len(re.findall(r"Window \[", plan)) == 1


def test_fold_sorts_by_a_number_before_names(spark):
    table = spark.createDataFrame(
        [("q", 1, "s", 1, 9, 5.0)],
        "query_id string, ord long, subject_id string, q_start int, q_end int, bitscore double")
    sorts = re.findall(r"Sort \[(\w+)", plan_of(hits.fold_overlaps(table, ["query_id"], 10)))
    assert sorts == ["_lead"]


def test_fold_of_missing_names_and_lone_hits():
    """Missing names are names; a query goes on in the next batch; batches of lone hits are handed on whole."""
    found = [(None, 1, 30, 5.0), (None, 2, 31, 9.0), ("a", 1, 30, 1.0), ("b", 1, 30, 2.0), ("b", 40, 80, 2.0),
             ("b", 45, 85, 1.0), ("c", 5, 5, 3.0)]

    def batches(size):
        for at in range(0, len(found), size):
            part = found[at:at + size]
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in part], pa.string()), pa.array(range(at, at + len(part))), pa.array(["s"] * len(part)),
                *[pa.array([r[k] for r in part]) for k in (1, 2, 3)]],
                ["query_id", "ord", "subject_id", "q_start", "q_end", "bitscore"])

    want = {None: [1], "a": [2], "b": [3, 4], "c": [6]}
    for size in range(1, len(found) + 1):
        rows = [r for b in hits.fold_batches(1, 10)(batches(size)) for r in b.to_pylist()]
        assert {r["query_id"]: [h["ord"] for h in r["hits"]] for r in rows} == want


def test_known_subject_counts_its_own_hits_only(spark):
    """The known hit is added where its subject's best is out of reach, in one share or in many."""
    schema = ("gene_id string, r_start int, r_end int, src int, region_no int, subject_id string, q_start int, q_end int,"
              " ord long, identity double, length int, mismatch int, s_len int, s_start int, s_end int, evalue double,"
              " bitscore double, functions array<string>, accepted boolean, tour long")
    hit = lambda q, src, s, score, o, ok=True: (
        q, 1, 9, src, 0 if src else None, s, 1, 9, o, 90.0, 20, 0, 100, 1, 20, 0.0, score, ["f"], ok, 3)
    table = spark.createDataFrame([
        hit("far", 1, "x", 100.0, 0), hit("far", 0, "x", 50.0, 1), hit("far", 0, "y", 100.0, 2),
        hit("near", 1, "x", 100.0, 3), hit("near", 0, "x", 99.0, 4), hit("near", 0, "y", 100.0, 5),
        hit("refused", 1, "x", 100.0, 6), hit("refused", 0, "x", 100.0, 7, False), hit("refused", 0, "y", 90.0, 8),
        hit("nameless", 1, None, 100.0, 9), hit("nameless", 0, None, 100.0, 10), hit("nameless", 0, "y", 100.0, 11),
    ], schema)
    for share in (F.lit(0), F.pmod(F.xxhash64("subject_id"), F.lit(32))):
        placed = classify._led(table.withColumn("share", share), ["gene_id"])
        levels = classify._score_levels(placed, RunParams(), ["gene_id"])
        levels = classify._led(levels, ["gene_id"])
        decided = classify._decide_regions(levels, RunParams(), ["gene_id"], lambda _: F.lit(1.0), False)
        firsts = {r["gene_id"]: r["new_hits"][0]["subject_id"] for r in decided.collect()}
        # A known hit comes after found ones of its score, so it shows where it alone is best.
        assert firsts == {"far": "y", "near": "y", "refused": "x", "nameless": None}


def test_classify_genes_collects_from_sorted_rows(spark, folder, monkeypatch):
    seen = []
    whole = Domain.classified_genes
    setting = "spark.sql.execution.useObjectHashAggregateExec"
    monkeypatch.setattr(Domain, "classified_genes", lambda d: (seen.append(spark.conf.get(setting)), whole(d))[1])
    runnable("classify_genes")(spark, folder)
    assert seen == ["false"]


# Records and mates ---------------------------------------------------------------------------

RECORDS = "sample_id string, end string, read_id string, header string, sequence string, line3 string, quality string"


def records_of(spark):
    return spark.createDataFrame(
        [("S1", e, r, f"@{r}{e}{k}", "ACGT", "+", "IIII") for e in ("pe1", "pe2", None) for r in ("a", "b", None, "z")
         for k in (1, 2) if (r, e) != ("b", "pe2")], RECORDS)


def reads_of(spark):
    return spark.createDataFrame(
        [(s, e, r, "function") for s in ("S1", "S2") for e in ("pe1", "pe2") for r in ("a", "a", "b", "c", None)],
        "sample_id string, end string, read_id string, status string")


def test_candidates_move_once_to_their_records(spark, no_broadcast):
    joined = sequences.with_mates(reads_of(spark), records_of(spark), ["read_id"])
    assert len(re.findall(r"Exchange hashpartitioning\(read_id", plan_of(joined))) == 2


def test_mates_are_the_same_for_few_and_many_candidates(spark, monkeypatch):
    few = rows_of(sequences.with_mates(reads_of(spark), records_of(spark), ["read_id"]))
    monkeypatch.setattr(sequences, "is_small", lambda *_: False)
    many = rows_of(sequences.with_mates(reads_of(spark), records_of(spark), ["read_id"]))
    assert few == many and len(few) == 20 and sum("@ape11" in r for r in few) == 8


@pytest.mark.parametrize("name", ["sink_mates", "sink_assembly_reads"])
def test_sinks_join_their_records_once(spark, folder, name, monkeypatch):
    kept = []
    monkeypatch.setattr(files, "written", lambda df: (kept.append(df), session.written(df))[1], raising=False)
    runnable(name)(spark, folder)
    assert len(kept) == 1


# Assemblies ----------------------------------------------------------------------------------

def test_reads_of_an_assembly_are_told_by_order_and_number(spark, tmp_path):
    """Repeated lines, orders in two samples, lines without a number, a priority or a known order."""
    spark.createDataFrame(
        [(k, 1, n, 7, 10.0, "A", "F") for k in (1, 2, 26, 51, 9, None) for n in (1, 1, 2, None)],
        "l_orderkey long, l_partkey long, l_linenumber int, l_suppkey long, l_quantity double,"
        " l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(
        [(1, "5-LOW"), (1, "1-URGENT"), (2, None), (26, "2-HIGH"), (51, "3-X")],
        "o_orderkey long, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(5).select(F.col("id").alias("s_suppkey")).write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(3).select(F.col("id").alias("p_partkey")).write.parquet(f"{tmp_path}/part.parquet")
    d = Domain(spark, str(tmp_path))
    got = d.assembly_reads
    # Only lines without a number are grouped by name.
    assert len(re.findall(r"Exchange hashpartitioning\(function#\d+, read_id", plan_of(got))) == 1
    want = d._assembled_lines.groupBy("function", "read_id").agg(F.min("sample_id").alias("sample_id"))
    assert got.columns == want.columns and rows_of(got) == rows_of(want) and len(rows_of(got)) == 4 * 2 + 2


def test_alignments_move_to_their_reads_only(spark, no_broadcast):
    alignments = spark.createDataFrame(
        [("f", "c1", "r1", 10), ("f", "c1", "r2", 20), ("f", "c2", "r1", 5), ("f", None, "r1", 7), ("g", "c1", "r1", 1),
         ("f", "c1", None, 3)], "function string, contig_id string, read_id string, aligned_length int")
    contigs = spark.createDataFrame(
        [("f", "c1", "A"), ("f", "c1", "A"), ("g", "c9", "A"), ("f", None, "A")],
        "function string, contig_id string, sequence string")
    reads = spark.createDataFrame(
        [("f", "r1", "S1"), ("f", "r2", None), ("g", "r1", "S2"), ("f", None, "S1")],
        "function string, read_id string, sample_id string")
    got = assembly.align_contigs(alignments, contigs, reads)
    plan = plan_of(got)
    # Contigs are compared with the sums, above the aggregate.
    assert plan.index("LeftSemi") < plan.index("HashAggregate")
    assert sorted((tuple(r) for r in got.collect()), key=str) == [
        ("f", "c1", "S1", 1, 10), ("f", "c1", None, 1, 20)]


# Proteins ------------------------------------------------------------------------------------

def test_protein_hits_meet_their_regions_by_order(spark, folder, monkeypatch):
    asked = []
    place = Domain.place_in_regions
    monkeypatch.setattr(
        Domain, "place_in_regions",
        lambda d, rows, found, keys, order_key=None: (asked.append(order_key), place(d, rows, found, keys, order_key))[1])
    d = Domain(spark, folder)
    run_queries.protein_run_files(d)
    assert len(asked) == 1 and asked[0] is not None
    rows = d.protein_hits.where(F.col("searched") == "bg")
    by_name = place(d, rows, d.protein_candidates, READ_KEYS)
    by_order = place(d, rows, d.protein_candidates, READ_KEYS, asked[0])
    assert rows_of(by_name) == rows_of(by_order)
