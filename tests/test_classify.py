"""Classification against a row-by-row reading of the rules, and the known scores."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.functions import scores
from readloom.operators import cubes
from readloom.operators.catalogue import protein_dimension
from readloom.operators.classify import classify_reads, find_candidates
from readloom.operators.taxonomy import complete_taxonomy, taxon_dimension
from readloom.params import RunParams, parse_rank_cutoffs
from readloom.schemas import HITS, KEPT_HIT
from test_taxonomy import TREE

KEYS = ["sample_id", "end", "read_id"]
PARAMS = RunParams()
FUNCTIONS = {"UreA": 50.0, "UreB": 60.0, "NirK": None}
CUTOFFS = {"superkingdom": 50.0, "phylum": 55.0, "class": 60.0, "order": 65.0, "family": 70.0,
           "genus": 75.0, "species": 80.0}
PROTEINS = {
    "p1": ("571", ["UreA"]), "p2": ("573", ["UreA"]), "p3": ("571", ["UreB"]),
    "p4": ("2157", ["UreA", "UreB"]), "p5": ("0", ["NirK"]), "p6": ("600", ["NirK", "UreA"]),
    "p7": ("missing", ["UreA"]),
}


def value(value_, spark):
    return spark.range(1).select(value_.alias("v")).first()["v"]


@pytest.mark.parametrize("s_len", [101, 231, 570])
def test_known_erpk(spark, s_len):
    got = value(scores.effective_per_kilobase(F.lit(s_len), F.lit(150.0), 15), spark)
    assert got == pytest.approx({101: 1000 / 364, 231: 1000 / 754, 570: 1000 / 1771}[s_len])


def test_known_fpk_and_floors(spark):
    assert value(scores.per_kilobase(F.lit(557)), spark) == pytest.approx(0.5984440454817475)
    assert value(scores.effective_per_kilobase(F.lit(1), F.lit(10.0), 15), spark) == 1000.0
    fragments = lambda s, r, i: value(
        scores.effective_fragments_per_kilobase(F.lit(s), F.lit(r), 15, i), spark
    )
    assert fragments(100, 150.0, F.lit(None).cast("double")) == pytest.approx(1000 / 511)
    assert fragments(100, 150.0, F.lit(300.0)) == pytest.approx(1000 / 511)
    assert fragments(100, 150.0, F.lit(401.0)) == pytest.approx(1000 / 722)


@pytest.fixture(scope="module")
def dims(spark):
    tree = spark.createDataFrame(TREE, "taxid string, name string, rank string, parent string")
    taxa = taxon_dimension(complete_taxonomy(tree)).cache()
    functions = spark.createDataFrame(
        [(f, f, "g", c, {"norank": c, **CUTOFFS} if c else {}) for f, c in FUNCTIONS.items()],
        "function string, name string, group string, function_cutoff double, "
        "cutoffs map<string,double>",
    )
    proteins = spark.createDataFrame(
        [(p, t, f, "src") for p, (t, f) in PROTEINS.items()],
        "protein_id string, taxid string, functions array<string>, source string",
    )
    return protein_dimension(proteins, functions, taxa, PARAMS).cache()


PARENT = {t[0]: t[3] for t in TREE} | {"0": "1"}
RANK = {t[0]: t[2] for t in TREE} | {"0": "norank", "1": "norank"}
RANKED = ["norank", *CUTOFFS]


def functions_of(subject):
    return PROTEINS[subject][1] if subject in PROTEINS else [""]


def cutoff(function, rank=None):
    own = FUNCTIONS.get(function)
    if own is None:
        return 50.0
    return own if rank in (None, "norank") else CUTOFFS[rank]


def supported(hit):
    taxon = PROTEINS[hit["subject_id"]][0] if hit["subject_id"] in PROTEINS else "0"
    taxon = taxon if taxon in PARENT else "0"
    while taxon != "1":
        if RANK[taxon] in RANKED and hit["identity"] >= min(
            [100.0] + [cutoff(f, RANK[taxon]) for f in functions_of(hit["subject_id"])]
        ):
            return taxon
        taxon = PARENT[taxon]
    return None


def lca(taxa):
    taxa = set(taxa)
    if not taxa:
        return "0"
    if len(taxa) == 1:
        return taxa.pop()
    lineages = []
    for taxon in taxa - {"0"}:
        path = [taxon]
        while path[0] != "1":
            path.insert(0, PARENT[path[0]])
        lineages.append(["1", "1"] if taxon == "1" else path if len(path) == 2 else path[1:])
    result = "0"
    for level in zip(*lineages):
        if len(set(level)) > 1:
            break
        result = level[0]
    return result


def brute_read(regions, background):
    """Rules of the classification, one region after the other."""
    status, taxon, totals = "unaccounted", None, {}
    for region in regions:
        rows = [b for b in background if b["region"] == region["region"] and b["length"] >= 15]
        if not rows:
            continue
        seen, hits = set(), []
        for b in rows:
            key = (b["subject_id"], b["q_start"], b["q_end"])
            if key not in seen:
                seen.add(key)
                hits.append(b)
        hits = [h for h in hits
                if h["identity"] >= max(cutoff(f) for f in functions_of(h["subject_id"]))]
        if not hits:
            status = "nofunction"
            continue
        best = max(h["bitscore"] for h in hits)
        chosen = [h for h in hits if h["bitscore"] > best * 0.97]
        if region["subject_id"] not in [h["subject_id"] for h in chosen] and (
                region["bitscore"] >= best):
            chosen.append(region)
        votes, leaders = {}, {}
        for h in chosen:
            for f in functions_of(h["subject_id"]):
                votes[f] = votes.get(f, 0) + 1
                if f not in leaders or h["bitscore"] > leaders[f]["bitscore"]:
                    leaders[f] = h
        picked = [f for f in votes if votes[f] / len(chosen) > 0.5]
        if not picked or "" in picked:
            status = "nofunction"
            continue
        status = "function"
        for f in picked:
            effective = 3 * leaders[f]["s_len"] - 90 + 150 + 1
            totals[f] = totals.get(f, 0.0) + 1000 / effective
        taxon = lca(t for t in (
            supported(h) for h in chosen if set(functions_of(h["subject_id"])) & set(picked)
        ) if t is not None)
    return status, taxon, totals


HIT = T.StructType([T.StructField(k, T.StringType()) for k in KEYS] + [
    f for f in HITS.fields if f.name != "query_id"] + [T.StructField("ord", T.LongType())])


def hit(rng, read, start, end, order, subject=None):
    return {
        "sample_id": "S", "end": "pe1", "read_id": read,
        "subject_id": subject or rng.choice([*PROTEINS, "stranger"]),
        "identity": rng.choice([45.0, 52.0, 57.0, 66.0, 78.0, 95.0]),
        "length": rng.choice([10, 20, 30, 40]), "mismatch": 0, "s_len": rng.choice([80, 101, 231]),
        "q_start": start, "q_end": end, "s_start": 1, "s_end": 30, "evalue": 1e-5,
        "bitscore": rng.choice([50.0, 50.5, 51.0, 58.5, 59.0]), "ord": order,
    }


@pytest.mark.parametrize("seed", range(3))
def test_classification_matches_the_rules(spark, dims, seed):
    rng = random.Random(seed)
    spots = [(1, 60), (100, 160), (260, 200)]
    candidates, background, want = [], [], {}
    for n in range(120):
        read = f"r{n}|x"
        regions = []
        for i, (start, end) in enumerate(spots[: rng.randrange(1, 4)]):
            region = hit(rng, read, start, end, i)
            region["region"] = (start, end)
            regions.append(region)
        rows = []
        for order in range(rng.randrange(0, 14)):
            start, end = rng.choice(spots[: len(regions)])
            b = hit(rng, read, rng.choice([1, 2]), rng.choice([50, 60]), order)
            b["region"] = (start, end)
            rows.append(b)
        candidates.append((
            "S", "pe1", read,
            [{**r, "functions": functions_of(r["subject_id"])} for r in regions],
        ))
        background += rows
        want[read] = brute_read(regions, rows)
    array = T.ArrayType(T.StructType([
        *[f for f in HIT.fields if f.name not in KEYS],
        T.StructField("functions", T.ArrayType(T.StringType())),
    ]))
    schema = T.StructType([T.StructField(k, T.StringType()) for k in KEYS]
                          + [T.StructField("hits", array)])
    names = [f.name for f in array.elementType.fields]
    cands = spark.createDataFrame(
        [(s, e, r, [tuple(h[x] for x in names) for h in hits]) for s, e, r, hits in candidates],
        schema,
    )
    found = spark.createDataFrame(
        [tuple(b[f.name] for f in HIT.fields) + b["region"] for b in background],
        T.StructType([*HIT.fields, T.StructField("r_start", T.IntegerType()),
                      T.StructField("r_end", T.IntegerType())]),
    ).repartition(6)
    lengths = spark.createDataFrame([("S", "pe1", 150.0)],
                                    "sample_id string, end string, read_length double")
    got = {r["read_id"]: r for r in classify_reads(
        cands, found, dims, lengths, PARAMS, KEYS).collect()}
    assert set(got) == set(want)
    for read, (status, taxon, totals) in want.items():
        assert got[read]["status"] == status, read
        assert got[read]["taxonomy"] == taxon, read
        assert got[read]["functions"] == pytest.approx(totals), read


def test_candidate_thresholds(spark, dims):
    rng = random.Random(1)
    rows = [hit(rng, "r", 1 + 80 * i, 60 + 80 * i, i, p) for i, p in enumerate(["p1", "p3", "p4"])]
    for row in rows:
        row.update(identity=55.0, length=20, bitscore=50.0)
    df = spark.createDataFrame([tuple(r[f.name] for f in HIT.fields) for r in rows], HIT)
    [read] = find_candidates(df, dims, PARAMS, KEYS).collect()
    assert [h["subject_id"] for h in read["hits"]] == ["p1"]


ANNOTATED = T.StructType([
    *[T.StructField(k, T.StringType()) for k in KEYS], T.StructField("status", T.StringType()),
    T.StructField("functions", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("taxonomy", T.StringType()), T.StructField("hits", T.ArrayType(KEPT_HIT)),
])


def kept(subject, functions, bitscore=50.0, identity=90.0, s_len=100, s_start=1, s_end=40):
    return (subject, identity, 40, 0, s_len, 1, 120, s_start, s_end, 1e-5, bitscore, functions)


def read(end, name, status, functions=(), hits=(), sample="S"):
    return (sample, end, name, status, {f: 1.0 for f in functions}, "571" if functions else None,
            list(hits))


def samples(spark, paired=True, insert_size=300.0, genome=3.0e6):
    return spark.createDataFrame(
        [("S", "Sample", paired, "0", 10, 10, 1500, 1500, genome, insert_size)],
        "sample_id string, sample_name string, is_paired_end boolean, replicate string, "
        "fwd_reads long, rev_reads long, fwd_bases long, rev_bases long, genome_size double, "
        "insert_size double",
    )


def test_fragment_rules(spark):
    a, b = kept("p1", ["UreA"]), kept("p3", ["UreB"], identity=80.0)
    rows = [
        read("pe1", "both", "function", ["UreA"], [a]),
        read("pe2", "both", "function", ["UreB"], [b]),
        read("pe1", "alone", "function", ["UreA"], [a]),
        read("pe1", "spoiled", "function", ["UreA"], [a]), read("pe2", "spoiled", "nofunction"),
        read("pe1", "second", "nofunction"), read("pe2", "second", "function", ["UreA"], [a]),
        read("pe2", "lone2", "function", ["UreA"], [a]),
    ]
    annotated = spark.createDataFrame(rows, ANNOTATED)
    found = {r["read_id"]: sorted(r["functions"]) for r in cubes.fragments(annotated).collect()}
    assert found == {"both": ["UreA", "UreB"], "alone": ["UreA"], "second": ["UreA"],
                     "lone2": ["UreA"]}
    cube = cubes.paired_end_scores(annotated, samples(spark), "fragmentcount", PARAMS)
    assert {r["function"]: (r["score"], r["count"]) for r in cube.collect()} == {
        "UreA": (4.0, 4), "UreB": (1.0, 1)}


def test_ties_keep_the_first_end(spark):
    rows = [
        read("pe1", "r", "function", ["UreA"], [kept("p1", ["UreA"], identity=70.0)]),
        read("pe2", "r", "function", ["UreA"], [kept("p2", ["UreA"], identity=99.0)]),
    ]
    annotated = spark.createDataFrame(rows, ANNOTATED)
    [row] = cubes.paired_end_scores(annotated, samples(spark), "fpk", PARAMS).collect()
    assert row["identity"] == 70.0


def test_function_without_hit_counts_in_one_cube_only(spark, dims):
    rows = [read("pe1", "r", "function", ["UreA"], [kept("p3", ["UreB"])])]
    annotated = spark.createDataFrame(rows, ANNOTATED)
    tree = spark.createDataFrame(TREE, "taxid string, name string, rank string, parent string")
    taxa = taxon_dimension(complete_taxonomy(tree))
    [row] = cubes.paired_end_scores(annotated, samples(spark), "fpk", PARAMS).collect()
    assert (row["count"], row["hit_count"], row["score"]) == (1, 0, 0.0)
    assert cubes.paired_end_scores(annotated, samples(spark), "fpk", PARAMS, taxa).count() == 0


def test_insert_size_from_shared_subjects(spark):
    rows = []
    for i, end in enumerate([60, 80]):
        rows.append(read("pe1", f"r{i}", "function", ["UreA"], [kept("p1", ["UreA"])]))
        rows.append(read("pe2", f"r{i}", "function", ["UreA"],
                         [kept("p1", ["UreA"], s_start=30, s_end=end)]))
    annotated = spark.createDataFrame(rows, ANNOTATED)
    size = lambda recorded, reads: cubes.insert_sizes(
        reads, samples(spark, insert_size=recorded), PARAMS).first()["insert_size"]
    assert size(0.0, annotated) == pytest.approx((3 * 59 + 3 * 79) / 2)
    assert size(0.0, annotated.where(F.col("read_id") == "r0")) == 0.0
    assert size(250.0, annotated) == 250.0


def test_single_end_cube(spark):
    rows = [
        read("pe1", "a", "function", ["UreA"], [kept("p1", ["UreA"], identity=80.0)]),
        read("pe1", "b", "function", ["UreA"], [kept("p3", ["UreB"])]),
        read("pe1", "c", "nofunction"),
        read("pe2", "d", "function", ["UreA"], [kept("p1", ["UreA"])]),
    ]
    annotated = spark.createDataFrame(rows, ANNOTATED)
    [row] = cubes.single_end_scores(annotated, samples(spark, paired=False), "erpkm").collect()
    assert (row["score"], row["count"], row["hit_count"]) == (200000.0, 2, 1)
    assert row["identity"] == 80.0


def test_parameters_per_collection():
    cutoffs = parse_rank_cutoffs("species,80,genus,75", 50.0)
    assert cutoffs == {"species": 80.0, "genus": 75.0, "norank": 50.0}
    own = RunParams().for_collection({"length_cutoff": 20, "rank_cutoffs": cutoffs})
    assert (own.length_cutoff, own.identity_cutoff) == (20, 50.0)


def test_metric_rules(spark):
    paired, single = samples(spark), samples(spark, paired=False)
    assert cubes.choose_metric(paired) == "efpkg"
    assert cubes.choose_metric(single) == "erpkg"
    assert cubes.choose_metric(samples(spark, genome=0.0)) == "fragmentcount"
    with pytest.raises(ValueError, match="does not apply"):
        cubes.metric_factor("erpk", True, by_taxon=False)
    with pytest.raises(ValueError, match="does not apply"):
        cubes.metric_factor("rpkm", False, by_taxon=False)
    assert cubes.metric_factor("rpkm", False, by_taxon=True) == "per_million"
    with pytest.raises(ValueError, match="apart"):
        cubes.library_is_paired(paired.unionByName(single))
