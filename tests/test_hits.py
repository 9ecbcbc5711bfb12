"""Hit operators against brute force on small and skewed fixtures."""

from __future__ import annotations

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.operators import skew
from readloom.operators.classify import non_overlapping_hits
from readloom.operators.hits import (
    band_size, deduplicate, limit_per_query, overlap_counts, top_hit, within_band,
)
from readloom.schemas import HITS

KEYS = ["query_id"]
SCHEMA = T.StructType([*HITS.fields, T.StructField("ord", T.LongType())])


def make_hits(n: int, seed: int, queries: int = 8, hot_share: float = 0.4):
    """Random hits on both strands; one query holds ``hot_share`` of them, with many ties."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        query = "hot" if rng.random() < hot_share else f"q{rng.randrange(queries)}"
        start, span = rng.randrange(1, 120), rng.randrange(30, 90)
        ends = (start, start + span) if rng.random() < 0.5 else (start + span, start)
        rows.append((query, f"p{rng.randrange(12)}", float(rng.randrange(50, 100)), span // 3, 0,
                     100, *ends, 1, span // 3, 1e-5, float(rng.randrange(40, 60)), i))
    return rows


def by_query(rows):
    grouped = {}
    for row in rows:
        grouped.setdefault(row[0], []).append(row)
    return grouped


def brute_dedup(rows):
    kept, seen = [], set()
    for row in rows:
        key = (row[0], row[1], row[6], row[7])
        if key not in seen:
            seen.add(key)
            kept.append(row)
    return kept


def brute_overlap(new, kept, cutoff):
    if new[6] < new[7]:
        return kept[6] <= kept[7] and kept[7] >= new[6] + cutoff and kept[6] <= new[7] - cutoff
    if new[6] > new[7]:
        return kept[6] >= kept[7] and kept[6] >= new[7] + cutoff and kept[7] <= new[6] - cutoff
    return True


def brute_fold(rows, cutoff):
    kept = []
    for row in rows:
        rivals = [k for k in kept if brute_overlap(row, k, cutoff)]
        if all(row[11] > k[11] for k in rivals):
            kept = [k for k in kept if k not in rivals] + [row]
    return kept


def test_deduplicate_keeps_the_first(spark):
    rows = make_hits(600, 1)
    got = deduplicate(spark.createDataFrame(rows, SCHEMA).repartition(7), KEYS).collect()
    assert sorted(r["ord"] for r in got) == [r[12] for r in brute_dedup(rows)]


def test_overlap_fold_matches_brute_force(spark):
    for seed in range(3):
        rows = make_hits(500, seed)
        df = spark.createDataFrame(rows, SCHEMA).repartition(5)
        for cutoff in (10, 25):
            got = {
                r["query_id"]: [h["ord"] for h in r["hits"]]
                for r in non_overlapping_hits(deduplicate(df, KEYS), KEYS, cutoff).collect()
            }
            want = {
                q: [r[12] for r in brute_fold(group, cutoff)]
                for q, group in by_query(brute_dedup(rows)).items()
            }
            assert got == want


def test_kept_hits_never_overlap(spark):
    rows = make_hits(800, 9)
    df = spark.createDataFrame(rows, SCHEMA)
    for row in non_overlapping_hits(deduplicate(df, KEYS), KEYS, 10).collect():
        hits = [(None,) * 6 + (h["q_start"], h["q_end"]) for h in row["hits"]]
        for i, a in enumerate(hits):
            assert not any(brute_overlap(a, b, 10) for b in hits[:i])


def test_single_position_hit_overlaps_everything(spark):
    base = ("q", "p", 90.0, 20, 0, 100)
    rows = [(*base, 1, 60, 1, 20, 1e-5, 50.0, 1), (*base, 200, 200, 1, 20, 1e-5, 60.0, 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    [row] = non_overlapping_hits(df, KEYS, 10).collect()
    assert [h["ord"] for h in row["hits"]] == [2]


def test_overlap_counts_match_pairs(spark):
    rows = make_hits(400, 4)
    got = overlap_counts(spark.createDataFrame(rows, SCHEMA), KEYS, 10).collect()
    assert sum(r["hits"] for r in got) == len(rows)
    for r in got:
        group = by_query(rows)[r["query_id"]]
        ends = (r["low"], r["high"]) if r["strand"] == 1 else (r["high"], r["low"])
        me = (None,) * 6 + ends
        assert r["overlapped"] == sum(brute_overlap(me, k, 10) for k in group) - 1


def test_overlap_counts_of_short_intervals(spark):
    """Intervals around and below twice the cutoff, down to one position."""
    rng = random.Random(11)
    base = ("q", "p", 90.0, 20, 0, 100)
    rows = []
    for k in range(500):
        low = rng.randrange(1, 60)
        high = low + rng.randrange(0, 30)
        start, end = (low, high) if rng.random() < 0.7 else (high, low)
        rows.append((*base, start, end, 1, 20, 1e-5, 50.0, k))
    got = overlap_counts(spark.createDataFrame(rows, SCHEMA), KEYS, 10).collect()
    intervals = [(1 if r[6] <= r[7] else -1, min(r[6], r[7]), max(r[6], r[7])) for r in rows]
    for r in got:
        others = sum(
            s == r["strand"] and high >= r["low"] + 10 and low <= r["high"] - 10
            for s, low, high in intervals)
        assert r["overlapped"] == others - (r["high"] - r["low"] >= 10)


def test_band_and_top_on_a_hot_query(spark, monkeypatch):
    # With a low bar for "hot" the salted path carries the hot query.
    monkeypatch.setattr(skew, "HOT_MINIMUM", 50)
    monkeypatch.setattr(skew, "HOT_SHARE", 0.2)
    rows = make_hits(900, 7)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    best = {q: max(r[11] for r in group) for q, group in by_query(rows).items()}
    band = within_band(df, KEYS, 0.03)
    assert sorted(r["ord"] for r in band.collect()) == [
        r[12] for r in rows if r[11] > best[r[0]] * 0.97
    ]
    sizes = {r["query_id"]: r["top_size"] for r in band_size(df, KEYS, 0.97).collect()}
    assert sizes == {
        q: sum(r[11] >= best[q] * 0.97 for r in group) for q, group in by_query(rows).items()
    }
    tops = {r["query_id"]: r["ord"] for r in top_hit(df, KEYS).collect()}
    assert tops == {
        q: next(r[12] for r in group if r[11] == best[q]) for q, group in by_query(rows).items()
    }


def test_no_positive_score_no_top_hit(spark):
    row = ("q", "p", 90.0, 20, 0, 100, 1, 60, 1, 20, 1e-5, 0.0, 1)
    assert top_hit(spark.createDataFrame([row], SCHEMA), KEYS).count() == 0


def test_limit_is_per_query(spark):
    rows = make_hits(300, 3)
    got = limit_per_query(spark.createDataFrame(rows, SCHEMA), KEYS, 5)
    counts = {r["query_id"]: r["count"] for r in got.groupBy("query_id").count().collect()}
    assert counts == {q: min(5, len(group)) for q, group in by_query(rows).items()}


def test_join_per_key_spreads_only_hot_rows(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_MINIMUM", 10)
    monkeypatch.setattr(skew, "HOT_SHARE", 0.3)
    rows = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id"
    )
    per_key = rows.groupBy("k").agg(F.count("*").alias("rows_of_key"), F.max("id").alias("m"))
    got = {(r["id"], r["m"]) for r in skew.join_per_key(rows, per_key, ["k"]).collect()}
    assert got == {(i, 999 if i % 3 == 0 else i) for i in range(1000)}
