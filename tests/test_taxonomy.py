"""Taxonomy operators: a hand-made tree with known answers, and properties of LCA and roll-up."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from readloom.operators import rollup, taxonomy

# A small tree in NCBI style.
TREE = [
    ("1", "root", "no rank", "1"),
    ("131567", "cellular organisms", "no rank", "1"),
    ("2", "Bacteria", "superkingdom", "131567"),
    ("2157", "Archaea", "superkingdom", "131567"),
    ("1224", "Proteobacteria", "phylum", "2"),
    ("570", "Klebsiella (group) x", "genus", "1224"),
    ("571", "Klebsiella oxytoca", "species", "570"),
    ("573", "Klebsiella pneumoniae", "species", "570"),
    ("600", "strain", "no rank", "573"),
    ("10239", "Viruses", "superkingdom", "1"),
]


@pytest.fixture(scope="module")
def taxa(spark):
    rows = spark.createDataFrame(TREE, "taxid string, name string, rank string, parent string")
    return taxonomy.taxon_dimension(taxonomy.complete_taxonomy(rows)).cache()


def lca_of(spark, taxa, groups):
    rows = [(i, t) for i, group in enumerate(groups) for t in group]
    members = spark.createDataFrame(rows, "g int, taxid string")
    got = taxonomy.lowest_common_ancestor(members, ["g"], taxa)
    return {r["g"]: r["lca"] for r in got.collect()}


def test_lca_table(spark, taxa):
    cases = [
        (["1"], "1"), ([""], "0"), (["0"], "0"), (["571", "1"], "0"), (["571", "0"], "571"),
        (["2", "2157"], "131567"), (["571", "573"], "570"), (["131567", "2"], "0"),
        (["131567", "10239"], "1"), (["zzz"], "zzz"), (["zzz", "571"], "571"),
        (["571", "570"], "570"), (["600", "571", "0"], "570"), (["zzz", "yyy"], "0"),
        (["1", "0"], "1"),
    ]
    got = lca_of(spark, taxa, [members for members, _ in cases])
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]


def test_lca_ignores_order_and_repeats(spark, taxa):
    rng = random.Random(5)
    ids = [t[0] for t in TREE] + ["0"]
    groups = [[rng.choice(ids) for _ in range(rng.randrange(2, 6))] for _ in range(40)]
    shuffled = [rng.sample(g, len(g)) + [rng.choice(g)] for g in groups]
    assert lca_of(spark, taxa, groups) == lca_of(spark, taxa, shuffled)


def test_ranked_lca_and_parents(spark, taxa):
    members = spark.createDataFrame(
        [(1, "571"), (1, "573"), (2, "2"), (2, "2157"), (3, "600"), (4, "571"), (4, "1224")],
        "g int, taxid string",
    )
    got = taxonomy.lowest_common_ranked_ancestor(members, ["g"], taxa)
    assert {r["g"]: r["lca"] for r in got.collect()} == {1: "570", 2: "0", 3: "600", 4: "571"}
    parents = {r["taxid"]: (r["ranked_parent"], r["ranked_parent_rank"]) for r in taxa.collect()}
    assert parents["1"] == ("1", "norank")
    assert parents["571"] == ("570", "genus")
    assert parents["600"] == ("573", "species")
    assert parents["2"] == ("1", "norank")
    assert parents["0"] == ("1", "norank")


def test_lineage_text(taxa):
    text = {r["taxid"]: r["lineage"] for r in taxa.collect()}
    assert text["1"] == ""
    assert text["0"] == "Unknown"
    assert text["573"] == "Bacteria_Proteobacteria_Klebsiella__group__x_Klebsiella_pneumoniae"
    assert text["131567"] == "cellular_organisms"


def test_deep_chains_get_whole_paths(spark):
    chain = [("1", "root", "norank", "1")] + [
        (str(i), f"t{i}", "no rank", str(i - 1)) for i in range(2, 120)
    ]
    rows = spark.createDataFrame(chain, "taxid string, name string, rank string, parent string")
    sizes = taxonomy.ancestor_paths(rows).select("taxid", F.size("path").alias("n")).collect()
    assert {r["taxid"]: r["n"] for r in sizes} == {str(i): i for i in range(1, 120)}


def test_cycles_are_refused(spark):
    loop = [("5", "a", "genus", "6"), ("6", "b", "genus", "5")]
    rows = spark.createDataFrame(loop, "taxid string, name string, rank string, parent string")
    with pytest.raises(ValueError, match="cycle"):
        taxonomy.ancestor_paths(rows)


def profile(spark, taxa):
    rows = [("571", "f", 0.42, 1), ("573", "f", 0.42, 1), ("570", "f", 0.16, 1),
            ("600", "g", 1.0, 2), ("0", "f", 2.0, 1), ("zzz", "g", 3.0, 1)]
    scores = spark.createDataFrame(rows, "taxonomy string, function string, score double, count long")
    return rollup.roll_up(scores, taxa, ["function"], ["score", "count"])


def test_rollup_root_holds_every_leaf(spark, taxa):
    rows = {(r["taxid"], r["function"]): r for r in profile(spark, taxa).collect()}
    assert rows[("1", "f")]["score"] == pytest.approx(3.0)
    assert rows[("570", "f")]["score"] == pytest.approx(1.0)
    assert rows[("573", "g")]["score"] == 1.0
    assert rows[("0", "g")]["score"] == 3.0
    assert rows[("zzz", "g")]["parent"] == "0"


def test_residual_closes_the_gap(spark, taxa):
    nodes = rollup.with_residuals(
        profile(spark, taxa), [], ["function"], ["score", "count"], "count"
    ).collect()
    residual = {(r["name"], r["function"]): r for r in nodes if r["taxid"].startswith("~")}
    gap = residual[("Unclassified Klebsiella (group) x", "f")]
    assert gap["score"] == pytest.approx(0.16)
    assert gap["rank"] == "species"
    for parent in {r["parent"] for r in nodes if r["parent"]}:
        for function in ("f", "g"):
            node = [r for r in nodes if r["taxid"] == parent and r["function"] == function]
            children = [r for r in nodes if r["parent"] == parent and r["function"] == function]
            if node:
                assert sum(c["count"] for c in children) == node[0]["count"]


def test_lines_follow_the_tree(spark, taxa):
    nodes = rollup.with_residuals(
        profile(spark, taxa), [], ["function"], ["score", "count"], "count"
    )
    lines = {r["taxid"]: r["line"] for r in rollup.preorder_lines(nodes, []).collect()}
    paths = {r["taxid"]: r["path"] for r in nodes.select("taxid", "path").distinct().collect()}
    assert [t for t, _ in sorted(lines.items(), key=lambda x: x[1])] == sorted(
        paths, key=lambda t: paths[t]
    )
    assert sorted(lines.values()) == list(range(1, len(paths) + 1))


def test_residuals_of_large_counts_are_exact(spark):
    big = 3_000_000_000
    rows = [("1", "norank", "root", ["1"], big, None), ("2", "superkingdom", "B", ["1", "2"], big - 1, "1")]
    profile = spark.createDataFrame(
        rows, "taxid string, rank string, name string, path array<string>, count long, parent string")
    [row] = rollup.residual_nodes(profile, [], [], ["count"], "count").collect()
    assert (row["parent"], row["count"]) == ("1", 1)


def test_deep_trees_have_paths(spark):
    rows = [("1", "root", "norank", "1")] + [(str(k), f"t{k}", "norank", str(k - 1)) for k in range(2, 5001)]
    paths = taxonomy.ancestor_paths(spark.createDataFrame(rows, "taxid string, name string, rank string, parent string"))
    assert paths.where("taxid = '5000'").selectExpr("size(path) AS n").first()["n"] == 5000
