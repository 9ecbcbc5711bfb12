"""Physical plans: what is shuffled, pruned and joined."""

from __future__ import annotations

import re

import pytest

from readloom import registry
from readloom.adapters import READ_KEYS
from readloom.operators.classify import find_candidates
from readloom.params import BAD, CANDIDATE, GOOD
from readloom.plans import reports
from readloom.registry.core import domain


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def d(spark, folder):
    return domain(spark, folder)


def shuffles(plan: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan))


def test_candidate_search_shuffles_twice(d):
    plan = plan_of(find_candidates(d.reference_hits, d.protein_catalogue, d.params, READ_KEYS))
    assert shuffles(plan) == 2


def test_classification_shuffles_three_times(d):
    # Placing the fixture's rows in regions is a join of the adapter, not of the operator.
    placed = d.background_hits
    adapter = shuffles(plan_of(placed))
    assert shuffles(plan_of(d.classified_reads())) - adapter == 3


def test_scans_are_pruned(d):
    plan = plan_of(registry.runnable("status_counts")(d.spark, d.folder))
    [schema] = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    assert schema == "status:string"
    plan = plan_of(registry.runnable("sample_end_select")(d.spark, d.folder))
    assert "PartitionFilters: [isnotnull(sample_id" in plan


def test_top_k_is_limited_before_the_shuffle(d):
    plan = plan_of(registry.runnable("hits_per_query_limit")(d.spark, d.folder))
    assert plan.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", [
    "candidate_reads", "classify_reads", "function_scores_paired", "taxonomy_rollup",
    "report_taxon_function_score", "report_genes", "hit_overlap_join", "dense_grid",
    "bitscore_band_filter", "mates_join",
])
def test_no_cross_product(d, name):
    plan = plan_of(registry.runnable(name)(d.spark, d.folder))
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan


def test_sample_summary_counts_reads_of_every_status(spark):
    samples = spark.createDataFrame(
        [("A", "Sample A", "0", True, 3, 2, 300, 200, 3e6, 300.0)],
        "sample_id string, sample_name string, replicate string, is_paired_end boolean, fwd_reads long, "
        "rev_reads long, fwd_bases long, rev_bases long, genome_size double, insert_size double")
    annotated = spark.createDataFrame(
        [("A", "pe1", GOOD), ("A", "pe1", BAD), ("A", "pe1", CANDIDATE), ("A", "pe2", BAD)],
        "sample_id string, end string, status string")
    [row] = reports.sample_summary(samples, annotated, samples.select("sample_id", "insert_size")).collect()
    assert (row["mapped_pe1"], row["mapped_pe2"]) == (3, 1)
