"""Ranked lexical search by norm buckets, after LEMP: the best documents of each item, exact in integers.

A document is a vector of impacts over the terms that any item has, an item a vector of term weights; the
score is their inner product. Documents never move: each task orders its vectors by length (their norm) and
cuts them into buckets.

1. *Length*: an item skips a bucket whose largest norm times the item's norm cannot reach what the item
   needs (Cauchy-Schwarz).
2. *Coordinates*: in a bucket that is left, an item's heaviest terms are added up per document; Cauchy-Schwarz
   bounds what the other terms can add, and documents that cannot reach the need are dropped.
3. Survivors are scored again in 64-bit integers.

What an item needs is its k-th best score so far: first that of the longest vectors of the corpus, which all
tasks get, then a task's own. Bounds are in doubles with slack, so no document that ties is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.llm.common import Scratch, small_batches
from readloom.llm.tokens import byte_table, token_counts

# Terms are digits, ASCII letters (lower-cased) and whatever lies beyond ASCII.
TERMS = byte_table({*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)})
# Distinct terms of the items that one scan of the documents looks for.
SCAN_TERMS = 1 << 18
# Distinct terms of the items that are laid out as one dense block.
DENSE_TERMS = 1 << 12
BUCKET = 1024
# Vectors that a task orders at a time.
ORDERED = 1 << 14
# Of the longest vectors, about so many give every item its first need.
HEAD = 4096
FOCUS = 8
SLACK = 1 + 1e-9


@dataclass(frozen=True)
class Rule:
    """The score: weight of a term and its impact in a document; length counts ``length_percent`` of 100."""

    k: int = 10
    length_percent: int = 75

    def damping(self, n: np.ndarray, documents: int, total: int) -> np.ndarray:
        return 100 - self.length_percent + (self.length_percent * n * documents) // max(total, 1)

    def impact(self, times: np.ndarray, damping: np.ndarray) -> np.ndarray:
        return (1_000_000_000 * times) // (1000 * times + 8 * damping)

    def weights(self, df: np.ndarray, documents: int) -> np.ndarray:
        return np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)


@dataclass
class Items:
    """Items of one scan: row numbers, their terms (numbers in ``terms``) and how often each stands there."""

    terms: list[bytes] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)
    own: list[np.ndarray] = field(default_factory=list)
    times: list[np.ndarray] = field(default_factory=list)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [token_counts(t or b"", TERMS) for t in batch.column(1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([list(c) for c in counts], pa.list_(pa.binary())),
            pa.array([list(c.values()) for c in counts], pa.list_(pa.int64()))], ["item", "terms", "times"])


def item_scans(items: DataFrame, most: int) -> Iterator[Items]:
    """The items with terms, in order of their number, as many a scan as have ``most`` distinct terms."""
    table = items.mapInArrow(_item_terms, "item long, terms array<binary>, times array<long>")
    numbers: dict[bytes, int] = {}
    scan = Items()
    for row in table.where(F.size("terms") > 0).orderBy("item").toLocalIterator():
        terms = [bytes(t) for t in row["terms"]]
        if scan.rows and len(numbers) + sum(t not in numbers for t in terms) > most:
            scan.terms = list(numbers)
            yield scan
            numbers, scan = {}, Items()
        scan.rows.append(row["item"])
        scan.own.append(np.array([numbers.setdefault(t, len(numbers)) for t in terms], np.int64))
        scan.times.append(np.array(row["times"], np.int64))
    if scan.rows:
        scan.terms = list(numbers)
        yield scan


VECTORS = "doc_id long, n long, terms binary, times binary"


def _vectors(shared) -> Callable:
    """Of each document: all its terms counted, and those that items have, with their numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: k for k, t in enumerate(shared.value)}
        for batch in batches:
            lengths, terms, times = [], [], []
            for text in batch.column(1):
                counts = token_counts((text.as_py() or "").encode("utf-8", "surrogatepass"), TERMS)
                found = [(number[t], n) for t, n in counts.items() if t in number]
                lengths.append(sum(counts.values()))
                terms.append(np.array([k for k, _ in found], "<i4").tobytes())
                times.append(np.array([n for _, n in found], "<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), pa.array(terms, pa.binary()),
                 pa.array(times, pa.binary())], ["doc_id", "n", "terms", "times"])
    return run


def _joined(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows of a binary column, and the row of each."""
    values = column.to_pylist()
    sizes = [len(v) // np.dtype(kind).itemsize for v in values]
    return np.frombuffer(b"".join(values), kind), np.repeat(np.arange(len(values)), sizes)


def _document_counts(n_terms: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(_joined(batch.column(0), "<i4")[0], minlength=n_terms)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], ["term", "df"])
    return run


IMPACTS = "doc_id long, norm double, terms binary, impacts binary"


def _impacts(rule: Rule, documents: int, total: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            times, row = _joined(batch.column(3), "<i4")
            damping = rule.damping(batch.column(1).to_numpy(), documents, total)
            impact = rule.impact(times.astype(np.int64), damping[row])
            norm = np.sqrt(np.bincount(row, impact.astype(float) ** 2, minlength=batch.num_rows))
            ends = np.cumsum(np.bincount(row, minlength=batch.num_rows))[:-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(norm), batch.column(2),
                 pa.array([x.tobytes() for x in np.split(impact.astype("<i4"), ends)], pa.binary())],
                ["doc_id", "norm", "terms", "impacts"])
    return run


@dataclass
class Query:
    """One item over the terms of its dense block: terms by falling weight, norms of all and of the lighter ones."""

    item: int
    terms: np.ndarray
    weights: np.ndarray
    norm: float
    rest_norm: float


@dataclass
class Block:
    """Items whose terms are laid out together: ``place`` gives a term's row in the layout, or -1."""

    place: np.ndarray
    n_terms: int
    queries: list[Query]


def blocks(scan: Items, weights: np.ndarray, most: int, focus: int) -> list[Block]:
    """The items of a scan in dense blocks of about ``most`` distinct terms; items without weight have no results."""
    found: list[Block] = []
    numbers: dict[int, int] = {}
    queries: list[Query] = []

    def close() -> None:
        place = np.full(len(scan.terms), -1, np.int64)
        place[list(numbers)] = list(numbers.values())
        found.append(Block(place, len(numbers), list(queries)))
        numbers.clear()
        queries.clear()

    for item, own, times in zip(scan.rows, scan.own, scan.times):
        weight = weights[own] * times
        order = np.argsort(-weight, kind="stable")
        order = order[weight[order] > 0]
        if not len(order):
            continue
        terms = own[order].tolist()
        if queries and len(numbers) + sum(t not in numbers for t in terms) > most:
            close()
        weight = weight[order]
        queries.append(Query(
            item, np.array([numbers.setdefault(t, len(numbers)) for t in terms]), weight,
            float(np.sqrt((weight.astype(float) ** 2).sum())),
            float(np.sqrt((weight[focus:].astype(float) ** 2).sum()))))
    if queries:
        close()
    return found


class Best:
    """The best documents of an item so far, null ids last among equal scores."""

    def __init__(self, k: int, need: int):
        self.k, self.need = k, max(need, 1)
        self.scores, self.ids, self.missing = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        keep = scores >= self.need
        if not keep.any():
            return
        scores, ids, missing = (np.concatenate(x) for x in (
            (self.scores, scores[keep]), (self.ids, ids[keep]), (self.missing, missing[keep])))
        order = np.lexsort((ids, missing, -scores))[:self.k]
        self.scores, self.ids, self.missing = scores[order], ids[order], missing[order]
        if len(order) == self.k:
            self.need = max(self.need, int(self.scores[-1]))


@dataclass
class Work:
    """How many pairs of item and document each step looked at."""

    pairs: int = 0
    after_length: int = 0
    after_coordinates: int = 0


def search_bucket(
    block: Block, best: dict[int, Best], norms: np.ndarray, layout: np.ndarray,
    ids: np.ndarray, missing: np.ndarray, focus: int, work: Work
) -> None:
    """All items of a block against one bucket: ``layout`` has a row a term and a column a document."""
    longest = float(norms.max())
    squares = norms ** 2
    for query in block.queries:
        held = best[query.item]
        work.pairs += len(norms)
        if query.norm * longest * SLACK < held.need:
            continue
        work.after_length += len(norms)
        heavy = layout[query.terms[:focus]]
        known = query.weights[:focus] @ heavy
        left = squares - np.einsum("ij,ij->j", heavy, heavy, dtype=float)
        bound = known + query.rest_norm * np.sqrt(np.maximum(left, 0.0) + 1e-6 * squares)
        near = np.flatnonzero(bound * SLACK >= held.need)
        if not len(near):
            continue
        work.after_coordinates += len(near)
        scores = known[near] + query.weights[focus:] @ layout[query.terms[focus:][:, None], near]
        held.add(scores, ids[near], missing[near])


def _search(shared, rule: Rule, bucket: int, focus: int) -> Callable:
    def ordered(found: list[Block], best: dict[int, Best], rows: list[pa.RecordBatch], work: Work) -> None:
        table = pa.Table.from_batches(rows)
        norms = table["norm"].to_numpy()
        order = np.argsort(-norms, kind="stable")
        order = order[norms[order] > 0]
        raw = table["doc_id"].combine_chunks()
        ids, missing = raw.fill_null(0).to_numpy(), raw.is_null().to_numpy(zero_copy_only=False)
        terms, impacts = table["terms"].to_pylist(), table["impacts"].to_pylist()
        for at in range(0, len(order), bucket):
            own = order[at:at + bucket]
            column = np.repeat(np.arange(len(own)), [len(terms[i]) // 4 for i in own])
            term = np.frombuffer(b"".join([terms[i] for i in own]), "<i4")
            impact = np.frombuffer(b"".join([impacts[i] for i in own]), "<i4")
            for block in found:
                layout = np.zeros((block.n_terms, len(own)), np.int64)
                row = block.place[term]
                here = row >= 0
                layout[row[here], column[here]] = impact[here]
                search_bucket(block, best, norms[own], layout, ids[own], missing[own], focus, work)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, needs = shared.value
        best = {q.item: Best(rule.k, needs.get(q.item, 1)) for b in found for q in b.queries}
        held: list[pa.RecordBatch] = []
        work = Work()
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= ORDERED:
                ordered(found, best, held, work)
                held = []
        if held:
            ordered(found, best, held, work)
        for item, b in best.items():
            if len(b.ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(b.ids), pa.int64()), pa.array(b.ids, mask=b.missing),
                     pa.array(b.scores)], ["item", "doc_id", "score"])
    return run


FOUND = "item long, doc_id long, score long"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def best_documents(
    docs: DataFrame, items: DataFrame, rule: Rule = Rule(), scan_terms: int = SCAN_TERMS,
    dense_terms: int = DENSE_TERMS, bucket: int = BUCKET, focus: int = FOCUS, head: int = HEAD
) -> DataFrame:
    """The ``rule.k`` highest-scoring documents of each item: item_id, rank, doc_id, score.

    Scores are above 0; equal scores go by ascending doc_id, null ids last; rows that share an id are
    documents, or items, of their own. Null and empty texts have no terms: such documents are never found,
    such items find nothing. An empty table on either side gives an empty table. Items whose terms exceed
    ``scan_terms`` in number are taken in several scans of the documents, with the same result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "ranking")
    numbered = scratch.write(items.select(
        F.monotonically_increasing_id().alias("item"), "item_id", "text"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    results = spark.createDataFrame([], FOUND)
    for scan in item_scans(numbered.select("item", "text"), scan_terms):
        n_terms = len(scan.terms)
        vectors = scratch.write(texts.mapInArrow(
            _vectors(spark.sparkContext.broadcast(scan.terms)), VECTORS))
        totals = vectors.where("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        documents, total = totals["docs"], totals["terms"] or 0
        df = np.zeros(n_terms, np.int64)
        for row in vectors.select("terms").mapInArrow(
                _document_counts(n_terms), "term long, df long").groupBy("term").agg(
                F.sum("df").alias("df")).collect():
            df[row["term"]] = row["df"]
        found = blocks(scan, rule.weights(df, documents), dense_terms, focus)
        impacts = scratch.write(vectors.mapInArrow(_impacts(rule, documents, total), IMPACTS))
        scratch.drop(vectors)

        def searched(table: DataFrame, needs: dict[int, int]) -> DataFrame:
            shared = spark.sparkContext.broadcast((found, needs))
            return scratch.write(table.mapInArrow(_search(shared, rule, bucket, focus), FOUND))

        share = 1 - min(head / max(documents, 1), 1)
        long_ = impacts.agg(F.percentile_approx("norm", share, 1000).alias("norm")).first()["norm"] or 0.0
        first = _ranked(searched(impacts.where(F.col("norm") >= long_), {}), rule.k)
        needs = {r["item"]: r["score"] for r in first.where(F.col("rank") == rule.k).collect()}
        results = results.unionByName(searched(impacts, needs))
        scratch.drop(impacts)
    return _ranked(results, rule.k).join(numbered.select("item", "item_id"), "item").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
