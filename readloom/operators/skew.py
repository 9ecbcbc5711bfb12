"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.session import written

# A key is hot above this share of all rows, so there are at most 10,000 hot keys to broadcast.
HOT_SHARE = 1e-4
# Keys below this count are never worth spreading.
HOT_MINIMUM = 100_000
# Tasks that share the rows of one hot key.
HOT_COPIES = 64
# Hash buckets whose rows are counted to see whether a key may be hot.
KEY_BUCKETS = 4096


def join_per_key(rows: DataFrame, per_key: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join rows to one row per key, spreading the rows of hot keys over many tasks.

    ``per_key`` carries ``rows_of_key``. Only the rows of hot keys are salted and only their
    entries are copied; every other key joins as usual.
    """
    all_rows = per_key.agg(F.sum("rows_of_key")).scalar()
    limit = F.greatest(all_rows * HOT_SHARE, F.lit(float(HOT_MINIMUM)))
    hot = per_key.where(F.col("rows_of_key") > limit).select(*keys, F.lit(True).alias("hot"))
    spread = F.pmod(F.xxhash64(*rows.columns), F.lit(HOT_COPIES)).cast("int")
    salted = rows.join(F.broadcast(hot), list(keys), "left").withColumn(
        "salt", F.when(F.col("hot"), spread).otherwise(0)
    )
    copies = (
        per_key.join(F.broadcast(hot), list(keys), "left")
        .withColumn(
            "salt",
            F.explode(
                F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(HOT_COPIES - 1)))
                .otherwise(F.array(F.lit(0)))
            ),
        )
        .drop("hot", "rows_of_key")
    )
    return salted.drop("hot").join(copies, [*keys, "salt"]).drop("salt")


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).cast("int")


def hot_buckets(rows: DataFrame, keys: Sequence[str], hot_minimum: int | None = None) -> tuple[list[int], float]:
    """Hash buckets of the keys that may hold a hot key, and the rows a hot key has more than.

    Each task sends a count a bucket, the driver sees one number a bucket.
    """
    counts = rows.groupBy(_bucket(keys).alias("bucket")).agg(F.count("*").alias("n")).collect()
    total = sum(row["n"] for row in counts)
    limit = max(total * HOT_SHARE, float(hot_minimum or HOT_MINIMUM))
    return [row["bucket"] for row in counts if row["n"] > total / KEY_BUCKETS + limit / 2], limit


def in_buckets(keys: Sequence[str], buckets: list[int]) -> Column:
    return _bucket(keys).isin(buckets)


def _hot_keys(rows: DataFrame, key: str, hot_minimum: int | None) -> DataFrame | None:
    """``key``, ``hot`` of the hot keys, if there are any; only keys of hot buckets are counted."""
    buckets, limit = hot_buckets(rows, [key], hot_minimum)
    if not buckets:
        return None
    counts = rows.where(in_buckets([key], buckets)).groupBy(key).agg(F.count("*").alias("n"))
    hot = written(counts.where(F.col("n") > limit).select(key, F.lit(True).alias("hot")))
    return None if hot.isEmpty() else hot


def join_dimension(
    rows: DataFrame, dimension: DataFrame, key: str, hot_minimum: int | None = None,
    reduce: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Left join of rows to a dimension too large to broadcast, one entry per key at most.

    Rows of hot keys, of which there are at most 10,000, meet the few entries of these by broadcast and stay
    where they are. All others are shuffled by the key; a dimension in buckets of it is not moved. The rows are
    written first: the counts and both joins read them, and what they come from runs once. ``reduce`` is an
    aggregate by the key and more, which takes place before the join: rows that are not hot move once for both.
    """
    return join_written(written(rows), dimension, key, hot_minimum, reduce)


def join_written(
    rows: DataFrame, dimension: DataFrame, key: str, hot_minimum: int | None = None,
    reduce: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``join_dimension`` of rows that are a written table already."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def by_key(part: DataFrame) -> DataFrame:
        moved = part if reduce is None else reduce(part.repartition(tasks, key))
        return moved.join(dimension, key, "left")

    hot = _hot_keys(rows, key, hot_minimum)
    if hot is None:
        return by_key(rows)
    entries = dimension.join(F.broadcast(hot.select(key)), key, "left_semi")
    marked = rows.join(F.broadcast(hot), key, "left")
    # Rows without a key have no entry to meet, so they need not move either.
    stay = F.col("hot").isNotNull() | F.col(key).isNull()
    met = marked.where(stay).drop("hot")
    met = (met if reduce is None else reduce(met)).join(F.broadcast(entries), key, "left")
    return met.unionByName(by_key(marked.where(~stay).drop("hot")))
