"""Operators on aligned hits: filters, de-duplication, overlap resolution, best hits."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from readloom.operators.skew import join_per_key
from readloom.schemas import HIT_ORDER, HIT_PAYLOAD


def filter_by_length(hits: DataFrame, length_cutoff: int) -> DataFrame:
    return hits.where(F.col("length") >= length_cutoff)


def filter_by_fixed_identity(
    hits: DataFrame, identity_cutoff: float, length_cutoff: int
) -> DataFrame:
    """The pre-filter of the assembly path: fixed cutoffs, before overlaps are resolved."""
    return hits.where(
        (F.col("identity") >= identity_cutoff) & (F.col("length") >= length_cutoff)
    )


def deduplicate(hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First hit of each (subject, q_start, q_end) within a query; ``ord`` tells rows of a query apart.

    Each column of a hit is that of the least ``ord``: numbers of fixed width, so the aggregate hashes and
    combines on the map side without a sort, copies never travel, and the hash of the full key spreads one
    hot query over every task.
    """
    rest = [c for c in HIT_PAYLOAD if c != "ord"]
    return hits.groupBy(*keys, "subject_id", "q_start", "q_end").agg(
        F.min("ord").alias("ord"), *[F.min_by(c, "ord").alias(c) for c in rest])


def top_hit(hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Best hit per query, first on ties; a query without a positive bit-score has none."""
    columns = [c for c in hits.columns if c not in keys]
    others = [c for c in columns if c not in HIT_ORDER and c != "bitscore"]
    ranked = F.struct((-F.col("bitscore")).alias("rank"), *HIT_ORDER, *others)
    best = hits.where(F.col("bitscore") > 0).groupBy(*keys).agg(F.min(ranked).alias("top"))
    return best.select(
        *keys, *[F.col(f"top.{c}") for c in HIT_ORDER + others],
        (-F.col("top.rank")).alias("bitscore"),
    )


def within_band(hits: DataFrame, keys: Sequence[str], bitscore_range: float) -> DataFrame:
    """Hits strictly above ``best * (1 - range)`` of their query."""
    best = hits.groupBy(*keys).agg(
        F.max("bitscore").alias("best_bitscore"), F.count("*").alias("rows_of_key")
    )
    return join_per_key(hits, best, keys).where(
        F.col("bitscore") > F.col("best_bitscore") * (1.0 - bitscore_range)
    )


def band_size(hits: DataFrame, keys: Sequence[str], fraction: float) -> DataFrame:
    """Hits per query with at least ``fraction`` of the top bit-score.

    Hits are first counted per (query, bit-score); one more sum over those levels is enough.
    """
    levels = hits.groupBy(*keys, "bitscore").agg(F.count("*").alias("n"))
    best = levels.groupBy(*keys).agg(
        F.max("bitscore").alias("best_bitscore"), F.count("*").alias("rows_of_key")
    )
    return (
        join_per_key(levels, best, keys)
        .where(F.col("bitscore") >= F.col("best_bitscore") * fraction)
        .groupBy(*keys)
        .agg(F.sum("n").alias("top_size"))
    )


def limit_per_query(hits: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """At most ``n`` best hits per query, the top-k the aligner is asked for.

    Spark applies the limit on both sides of the shuffle, so a task sends n rows per query.
    """
    order = Window.partitionBy(*keys).orderBy(F.col("bitscore").desc(), *HIT_ORDER)
    return (
        hits.withColumn("hit_rank", F.row_number().over(order)).where(F.col("hit_rank") <= n)
    )


def _fold_run(
    starts: list[int], ends: list[int], scores: list[float], first: int, stop: int, cutoff: int
) -> list[int]:
    """Places of the hits first to stop - 1 that are kept, in the order they were taken.

    A hit that overlaps no kept hit is added. One that beats every kept hit it overlaps replaces them. Any
    other hit is left out. Two hits overlap if they share at least ``cutoff`` positions of the query on one
    strand; a new hit of one position overlaps every kept hit.
    """
    kept: list[int] = []
    for new in range(first, stop):
        start, end, score = starts[new], ends[new], scores[new]
        if start < end:
            rivals = [k for k in kept if starts[k] <= ends[k]
                      and ends[k] >= start + cutoff and starts[k] <= end - cutoff]
        elif start > end:
            rivals = [k for k in kept if starts[k] >= ends[k]
                      and starts[k] >= end + cutoff and ends[k] <= start - cutoff]
        else:
            rivals = kept
        if all(score > scores[k] for k in rivals):
            if rivals:
                gone = set(rivals)
                kept = [k for k in kept if k not in gone]
            kept.append(new)
    return kept


def fold_batches(n_keys: int, cutoff: int) -> Callable:
    """Batches sorted by query and input order to one row per query: its keys and its kept hits.

    Of a query that goes on in the next batch only the kept hits are held. To fold them again changes
    nothing, since none of them overlaps an earlier one.
    """
    def differs(column: pa.Array) -> np.ndarray:
        """Whether a value is another one than that before it."""
        if column.null_count:
            codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
            return codes[1:] != codes[:-1]
        return pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)

    def folded(rows: pa.RecordBatch, last_is_open: bool) -> tuple[pa.RecordBatch | None, pa.RecordBatch]:
        """Finished queries as rows, and the kept hits of the last query if it is open."""
        changed = np.zeros(max(rows.num_rows - 1, 0), bool)
        for k in range(n_keys):
            changed |= differs(rows.column(k))
        bounds = np.concatenate(([0], np.flatnonzero(changed) + 1, [rows.num_rows]))
        keep = np.ones(rows.num_rows, bool)
        # Hits are kept in their order. One that is alone stays.
        several = np.flatnonzero(np.diff(bounds) > 1).tolist()
        if several:
            starts, ends = (rows.column(n).to_pylist() for n in ("q_start", "q_end"))
            scores = rows.column("bitscore").to_numpy(zero_copy_only=False).tolist()
            for a, b in zip(bounds[several].tolist(), bounds[[i + 1 for i in several]].tolist()):
                keep[a:b] = False
                keep[_fold_run(starts, ends, scores, a, b, cutoff)] = True
        last = int(bounds[-2]) if last_is_open else rows.num_rows
        rest = rows.slice(last).filter(pa.array(keep[last:]))
        if not last:
            return None, rest
        done, first = rows.slice(0, last), bounds[bounds < last]
        hits = done if keep[:last].all() else done.filter(pa.array(keep[:last]))
        names = rows.schema.names
        arrays = [rows.column(k).take(pa.array(first)) for k in range(n_keys)]
        offsets = np.concatenate(([0], np.cumsum(np.add.reduceat(keep[:last].astype(np.int32), first))))
        values = pa.StructArray.from_arrays(hits.columns[n_keys:], names[n_keys:])
        arrays.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values))
        return pa.RecordBatch.from_arrays(arrays, [*names[:n_keys], "hits"]), rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if open_ is not None:
                joined = pa.Table.from_batches([open_, batch]).combine_chunks()
                batch = joined.to_batches()[0]
            done, open_ = folded(batch, True)
            if done is not None:
                yield done
        if open_ is not None:
            yield folded(open_, False)[0]
    return run


def fold_overlaps(hits: DataFrame, keys: Sequence[str], cutoff: int) -> DataFrame:
    """Hits of each query, in input order, to those that survive the greedy fold: keys and ``hits``.

    The columns are the keys, HIT_ORDER and the rest of a hit. A query is sorted by Spark, which spills, and
    read as a stream, so a task holds its kept hits and never all of them. Hits must be distinct.
    """
    rest = [f for f in hits.schema.fields if f.name not in keys]
    schema = T.StructType(
        [hits.schema[k] for k in keys] + [T.StructField("hits", T.ArrayType(T.StructType(rest)))])
    # Sorts compare the hash first, and names only where it is equal.
    lead = hits.withColumn("_lead", F.xxhash64(*keys)).repartition("_lead")
    return lead.sortWithinPartitions("_lead", *keys, *HIT_ORDER).drop("_lead").mapInArrow(
        fold_batches(len(keys), cutoff), schema)


def overlap_counts(hits: DataFrame, keys: Sequence[str], cutoff: int) -> DataFrame:
    """Per query interval: how many hits sit on it and how many others each of them overlaps.

    Hits collapse to intervals, and an interval overlaps every hit that starts early enough minus
    those that end too early, both read from a cumulative histogram of positions. Around an
    interval shorter than twice the cutoff a hit may do both, start too late and end too early;
    such hits lie within ``2 * cutoff`` positions and are counted back from there.
    """
    group = [*keys, "strand"]
    intervals = (
        hits.withColumn("strand", F.when(F.col("q_start") <= F.col("q_end"), 1).otherwise(-1))
        .withColumn("low", F.least("q_start", "q_end"))
        .withColumn("high", F.greatest("q_start", "q_end"))
        .groupBy(*group, "low", "high")
        .agg(F.count("*").alias("hits"))
    )
    last_start, first_end = F.col("high") - cutoff, F.col("low") + cutoff - 1
    marks = F.array(
        F.struct(F.col("low").alias("at"), F.col("hits").alias("starts"), F.lit(0).alias("ends")),
        F.struct(F.col("high").alias("at"), F.lit(0).alias("starts"), F.col("hits").alias("ends")),
        F.struct(last_start.alias("at"), F.lit(0).alias("starts"), F.lit(0).alias("ends")),
        F.struct(first_end.alias("at"), F.lit(0).alias("starts"), F.lit(0).alias("ends")),
    )
    histogram = (
        intervals.select(*group, F.inline(marks))
        .groupBy(*group, "at")
        .agg(F.sum("starts").alias("starts"), F.sum("ends").alias("ends"))
    )
    running = Window.partitionBy(*group).orderBy("at")
    cumulative = histogram.select(
        *group, "at",
        F.sum("starts").over(running).alias("started"),
        F.sum("ends").over(running).alias("ended"),
    )
    started = cumulative.select(*group, F.col("at").alias("last_start"), "started")
    ended = cumulative.select(*group, F.col("at").alias("first_end"), "ended")
    # A hit takes part in its own count unless it is shorter than the cutoff.
    itself = F.when(F.col("high") - F.col("low") >= cutoff, 1).otherwise(0)
    return (
        intervals.withColumn("last_start", last_start)
        .withColumn("first_end", first_end)
        .join(started, [*group, "last_start"])
        .join(ended, [*group, "first_end"])
        .join(_inside_the_gap(intervals, group, cutoff), [*group, "low", "high"], "left")
        .select(
            *group, "low", "high", "hits",
            (F.col("started") - F.col("ended") + F.coalesce("inside", F.lit(0)) - itself)
            .alias("overlapped"),
        )
    )


def _inside_the_gap(intervals: DataFrame, group: Sequence[str], cutoff: int) -> DataFrame:
    """Per short interval: hits that start after ``high - cutoff`` and end before ``low + cutoff``.

    Both kinds of interval are short, so buckets of ``2 * cutoff`` positions bring them together;
    intervals are distinct, so what meets in a bucket is bounded by the cutoff alone.
    """
    width = 2 * cutoff
    short = intervals.where(F.col("high") - F.col("low") <= 2 * cutoff - 2)

    def bucket(position: Column) -> Column:
        return F.floor(position / width).cast("long")

    first, last = F.col("high") - cutoff + 1, F.col("low") + cutoff - 1
    probes = short.select(
        *group, "low", "high", F.explode(F.sequence(bucket(first), bucket(last))).alias("bucket"))
    others = short.select(
        *group, bucket(F.col("low")).alias("bucket"), F.col("low").alias("other_low"),
        F.col("high").alias("other_high"), F.col("hits").alias("other_hits"))
    return (
        probes.join(others, [*group, "bucket"])
        .where((F.col("other_low") >= first) & (F.col("other_high") <= last))
        .groupBy(*group, "low", "high")
        .agg(F.sum("other_hits").alias("inside"))
    )
