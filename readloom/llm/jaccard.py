"""N-gram Jaccard join as a T-occurrence search over inverted lists, after DivideSkip.

A document is its set of word shingles; equal sets are one class. Two classes link when they share at least
T shingles, T given by their sizes. Lists of shingles that occur once cannot help, long lists hardly do:

* Shingles are ordered by the length of their list. A class only enters the lists of its first (rarest)
  shingles, as many as one of which any partner must share.
* A pair met in a short list is decided by merging what both have in short lists; the long lists are
  probed by binary search, and only if they could still lift the pair to T.
* Lists whose classes already are in one component have nothing left to say. So each list first compares
  its likeliest hub with its members; what is still apart is then compared pair by pair.

Any order of shingles gives whole results. The order's statistics (list lengths over all documents) travel
as a Bloom filter of shingles in two lists or more and a table of the longest lists, both of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm import bloom
from readloom.llm.common import Scratch, small_batches
from readloom.llm.components import components
from readloom.llm.recompression import mix, word_layout, word_names
from readloom.llm.repeats import WORK_BYTES, numbered_copy, portions, word_slices

# A list with this many classes is long; at most MAX_LONG of them (the longest) are ranked one by one.
LONG_LIST = 32
MAX_LONG = 200_000
BITS_PER_SHINGLE = 12


@dataclass(frozen=True)
class Threshold:
    """Shingles of ``n`` words; two sets link from ``percent`` / 100 on."""

    n: int = 5
    percent: int = 80

    def prefix(self, size: np.ndarray | int):
        """How many of its first shingles a set shares one of with any partner."""
        return size - (self.percent * size + 99) // 100 + 1

    def needed(self, a, b):
        """Least overlap of linked sets of these sizes."""
        return -(-self.percent * (a + b) // (100 + self.percent))


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct fingerprints of each text's shingles; a shorter text is one shingle by itself.

    A long text is taken in slices that overlap by a shingle less one word.
    """
    long_ = {k for k, t in enumerate(texts) if len(t) > WORK_BYTES}
    if long_:
        short = iter(_shingle_sets([t for k, t in enumerate(texts) if k not in long_], n))
        return [_long_set(t, n) if k in long_ else next(short) for k, t in enumerate(texts)]
    return _shingle_sets(texts, n)


def _long_set(text: bytes, n: int) -> np.ndarray:
    found = np.zeros(0, np.uint64)
    for first, part in word_slices(text, n, WORK_BYTES):
        # The last slice may hold no shingle of its own, only the end of one.
        if not first or len(part.split(None, n - 1)) == n:
            found = np.union1d(found, _shingle_sets([part], n)[0])
    return found


def _shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    if not texts:
        return []
    units = word_layout([t.lower() for t in texts])
    names = word_names(units)
    grams = np.zeros(max(len(names) - n + 1, 0), np.uint64)
    for k in range(n):
        grams = mix(grams * np.uint64(31) + names[k:len(names) - n + 1 + k]) if len(grams) else grams
    sets = []
    for first, last in zip(units.first.tolist(), units.last.tolist()):
        if last - first >= n:
            sets.append(np.unique(grams[first:last - n + 1]))
        else:
            whole = np.array([last - first], np.uint64)
            for name in names[first:last]:
                whole = mix(whole * np.uint64(37) + name)
            sets.append(whole[:last > first])
    return sets


def _signatures(n: int):
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in portions(batch):
                sets = shingle_sets(texts, n)
                keys = np.frombuffer(
                    b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy())],
                    ["row", "n", "key1", "key2"])
    return run


def _all_shingles(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in portions(batch):
                joined = np.concatenate(shingle_sets(texts, n))
                # Copies in one portion are added up here already.
                shingle, count = np.unique(joined, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shingle.view(np.int64)), pa.array(count)], ["shingle", "n"])
    return run


def _profiles(rule: Threshold, filter_, segments: int, longest):
    """Per class: size, shingles in one list only, shingles of the prefix, short and long shared shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, (long_keys, long_rank) = filter_.value, longest.value
        for batch in batches:
            for rows, texts in portions(batch):
                own, sizes, alone, prefixes, shorts, longs = [], [], [], [], [], []
                for row, s in zip(rows, shingle_sets(texts, rule.n)):
                    shared = s[bloom.contains(bits, s, segments)]
                    size, single = len(s), len(s) - len(shared)
                    take = rule.prefix(size) - single
                    if take <= 0 or not len(shared):
                        continue
                    at = np.searchsorted(long_keys, shared)
                    at[at == len(long_keys)] = 0
                    is_long = long_keys[at] == shared if len(long_keys) else np.zeros(len(shared), bool)
                    rank = np.where(is_long, long_rank[at], 0) if len(long_keys) else np.zeros(len(shared))
                    prefix = shared[np.lexsort((shared, rank))[:take]]
                    own.append(row)
                    sizes.append(size)
                    alone.append(single)
                    prefixes.append(prefix.view(np.int64))
                    shorts.append(shared[~is_long].tobytes())
                    longs.append(shared[is_long].tobytes())
                if own:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, pa.int64()), pa.array(sizes, pa.int64()), pa.array(alone, pa.int64()),
                         pa.array(prefixes, pa.list_(pa.int64())),
                         pa.array(shorts, pa.binary()), pa.array(longs, pa.binary())],
                        ["row", "n", "alone", "prefix", "short", "long"])
    return run


def _decide(rule: Threshold):
    """Pairs with both profiles; True where they share the T shingles a link takes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {name: batch.column(name) for name in batch.schema.names}
            needed = rule.needed(c["n"].to_numpy(), c["n2"].to_numpy()).tolist()
            linked = []
            for k, want in enumerate(needed):
                short, short2, long, long2 = (
                    np.frombuffer(c[name][k].as_py(), np.uint64) for name in ("short", "short2", "long", "long2"))
                if min(len(short), len(short2)) + min(len(long), len(long2)) < want:
                    linked.append(False)
                    continue
                merged = np.sort(np.concatenate((short, short2)), kind="mergesort")
                found = int((merged[1:] == merged[:-1]).sum())
                if found < want and found + min(len(long), len(long2)) >= want and len(long2):
                    few, many = (long, long2) if len(long) < len(long2) else (long2, long)
                    at = np.minimum(np.searchsorted(many, few), len(many) - 1)
                    found += int((many[at] == few).sum())
                linked.append(found >= want)
            yield pa.RecordBatch.from_arrays(
                [c["row"], c["row2"], pa.array(linked)], ["a", "b", "linked"])
    return run


def may_link(rule: Threshold) -> F.Column:
    """What sizes and positions allow a pair that meets in a list, for columns n, pos, n2, pos2.

    In the list of the first shingle they share, all they share is at or behind it in both. A pair that
    links passes there, so what fails here need not be kept, whichever list it is.
    """
    common = F.least(F.col("n") - F.col("pos"), F.col("n2") - F.col("pos2"))
    return common * (100 + rule.percent) >= (F.col("n") + F.col("n2")) * rule.percent


class Join:
    """One run of the join: classes, their profiles and lists, and the components found so far."""

    def __init__(self, docs: DataFrame, rule: Threshold, scratch: Scratch):
        self.rule, self.scratch, self.spark = rule, scratch, docs.sparkSession
        self.numbered = numbered_copy(docs, scratch)
        self.signatures = scratch.write(
            self.numbered.select("_row", "doc.text").mapInArrow(
                _signatures(rule.n), "row long, n long, key1 long, key2 long"))
        self.classes = scratch.write(
            self.signatures.where("n > 0").groupBy("key1", "key2").agg(F.min("row").alias("class")))
        self.profiles = self._profiled()
        self.label = None

    def _profiled(self) -> DataFrame:
        spark, scratch = self.spark, self.scratch
        texts = self.numbered.select("_row", "doc.text").join(
            self.classes.select(F.col("class").alias("_row")), "_row").select("_row", "text")
        lists = scratch.write(
            texts.mapInArrow(_all_shingles(self.rule.n), "shingle long, n long")
            .groupBy("shingle").agg(F.sum("n").alias("n")).where("n > 1"), large=True)
        segments = bloom.n_segments(lists.count(), BITS_PER_SHINGLE)
        filter_ = spark.sparkContext.broadcast(bloom.build(lists.select("shingle"), segments))
        top = lists.where(F.col("n") >= LONG_LIST).orderBy(F.desc("n"), "shingle").limit(MAX_LONG).collect()
        keys = np.array([r["shingle"] for r in top], np.int64).view(np.uint64)
        order = np.argsort(keys)
        longest = spark.sparkContext.broadcast((keys[order], np.array([r["n"] for r in top], np.int64)[order]))
        profiles = scratch.write(texts.mapInArrow(
            _profiles(self.rule, filter_, segments, longest),
            "row long, n long, alone long, prefix array<long>, short binary, long binary"), large=True)
        scratch.drop(lists)
        return profiles

    def _labelled(self, lists: DataFrame) -> DataFrame:
        return lists.join(self.label, lists["row"] == self.label["node"], "left").select(
            *lists.columns, F.coalesce("component", "row").alias("component"))

    def _links(self, pairs: DataFrame) -> DataFrame:
        sets = self.profiles.select("row", "n", "short", "long")
        other = sets.select(*[F.col(c).alias(f"{c}2") for c in sets.columns])
        both = pairs.select("row", "row2").distinct().join(sets, "row").join(other, "row2")
        return self.scratch.write(both.mapInArrow(
            _decide(self.rule), "a long, b long, linked boolean").where("linked").select("a", "b"))

    def _merge(self, links: DataFrame) -> None:
        known = links if self.label is None else links.unionByName(
            self.label.select(F.col("node").alias("a"), F.col("component").alias("b")))
        self.label = components(known, self.scratch)

    def run(self) -> DataFrame:
        """``class``, ``component`` (its smallest class) for classes that link with another one."""
        lists = self.profiles.select("row", "n", "alone", F.posexplode("prefix").alias("k", "shingle")).select(
            "shingle", "row", "n", "alone", (F.col("alone") + F.col("k")).alias("pos"))
        # Counts per list are written, so that their joins have an exchange on both sides and may be split.
        used = self.scratch.write(
            lists.groupBy("shingle").agg(F.count("*").alias("k")).where("k > 1").select("shingle"))
        lists = self.scratch.write(lists.join(used, "shingle", "left_semi"))
        hubs = lists.groupBy("shingle").agg(F.min(F.struct("alone", "row", "n", "pos")).alias("hub"))
        hubs = self.scratch.write(hubs.select(
            "shingle", F.col("hub.row").alias("row2"), F.col("hub.n").alias("n2"), F.col("hub.pos").alias("pos2")))
        pairs = lists.join(hubs, "shingle").where((F.col("row") != F.col("row2")) & may_link(self.rule))
        self._merge(self._links(pairs))
        # A hub has met its whole list.
        done = hubs.select("shingle", F.col("row2").alias("row"))
        lists = lists.select("shingle", "row", "n", "pos").join(done, ["shingle", "row"], "left_anti")
        open_ = self._apart(lists)
        other = open_.select("shingle", *[
            F.col(c).alias(f"{c}2") for c in ("row", "n", "pos", "component")])
        pairs = open_.join(other, "shingle").where(
            (F.col("row") < F.col("row2")) & (F.col("component") != F.col("component2"))
            & may_link(self.rule))
        self._merge(self._links(pairs))
        return self.label.select(F.col("node").alias("class"), "component")

    def _apart(self, lists: DataFrame) -> DataFrame:
        """The lists that still hold more than one component, with the components."""
        labelled = self._labelled(lists)
        split = self.scratch.write(labelled.groupBy("shingle").agg(
            F.min("component").alias("low"), F.max("component").alias("high"))
            .where("low <> high").select("shingle"))
        return self.scratch.write(labelled.join(split, "shingle", "left_semi"))


def _joined(docs: DataFrame, rule: Threshold, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """The numbered documents, and row, n, class root (null without shingles) of each."""
    small_batches(docs.sparkSession)
    scratch = scratch or Scratch(docs.sparkSession, "jaccard")
    join = Join(docs, rule, scratch)
    found = join.run()
    members = join.signatures.join(join.classes, ["key1", "key2"], "left").join(found, "class", "left")
    return join.numbered, scratch.write(members.select(
        "row", "n", F.when(F.col("n") > 0, F.coalesce("component", "class")).alias("root")))


def near_duplicates(docs: DataFrame, rule: Threshold = Threshold()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    Null and blank texts have no shingles and link with nothing. Equal rows link with each other; rows that
    share a doc_id are documents of their own with one id. Null doc_ids are passed over when the smallest is
    taken. An empty table gives an empty table.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    numbered, rooted = _joined(docs.select(F.col("doc_id").cast("long"), "text"), rule, scratch)
    table = numbered.select(F.col("_row").alias("row"), "doc.doc_id").join(rooted, "row")
    # Written, so that the join below has an exchange on both sides and a large component may be split.
    table = scratch.write(table)
    smallest = scratch.write(
        table.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id")))
    return table.join(smallest, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"))


def one_of_each(docs: DataFrame, rule: Threshold = Threshold()) -> DataFrame:
    """The documents without near-duplicates: of each component the row with the smallest doc_id stays.

    Among rows with that id the first by row number stays. Texts without words link with nothing and all
    stay. Same columns as ``docs``.
    """
    numbered, rooted = _joined(docs, rule)
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row")
    table = numbered.select(F.col("_row").alias("row"), "doc.doc_id").join(rooted, "row")
    first = table.where("root is not null").groupBy("root").agg(F.min(order).alias("o"))
    kept = first.select(F.col("o.row").alias("_row")).unionByName(
        table.where("root is null").select(F.col("row").alias("_row")))
    return numbered.join(kept, "_row").select("doc.*")
