"""Exact repeats of a fixed length across a corpus, found by sparse keys that narrow pass by pass.

A *unit* is a byte or a word, a *window* is ``size`` consecutive units. A method names, for each window,
one place in it (its anchor) from the window's content alone, so equal windows have equal anchors at equal
distances. Neighbouring windows mostly share an anchor, which leaves one row for a run of windows:

1. The *core* of an anchor is content that every window with that anchor holds. A core seen once cannot
   belong to a repeat; its row is dropped.
2. The *span* of a row is the text of all its windows together. Equal spans are repeats throughout.
3. Rows that share a core but not the span are resolved window by window; one row stands for each span.

Every pass is a count per key, combined before the shuffle, and an equality join, which adaptive execution
may split: no group is ever gathered in one task. Fingerprints that decide (spans, windows) have 128 bits.
Long texts are worked on in slices that overlap by a window less one unit; what a slice cuts apart is found
equal window by window.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import Scratch, small_batches, wrapped

# Spans are matched in so many rounds, by core.
TURNS = 2
# Stands for the number of units of a text that is repeated throughout.
WHOLE = (1 << 31) - 1
# Bytes of text that a worker turns into units at a time.
WORK_BYTES = 1 << 20


@dataclass
class Units:
    """Texts laid out one after the other.

    ``bytes_[offsets[i]:offsets[j]]`` is the content of units i to j - 1, comparable across documents.
    ``first`` and ``last`` are the unit bounds of each document; units between documents belong to none.
    """

    bytes_: bytes
    offsets: np.ndarray
    first: np.ndarray
    last: np.ndarray


@dataclass(frozen=True)
class Method:
    """How texts become units, and how windows get their anchors.

    ``layout(texts)`` gives Units. ``anchors(units, starts)`` gives for each window start the anchor, and
    the core key of each anchor: two arrays as long as ``starts``. ``slices(text, size, n_bytes)`` cuts a long
    text: pairs of the number of a slice's first unit and the slice, such that every window of ``size`` units
    lies in exactly one of them.
    """

    size: int
    layout: Callable[[list[bytes]], Units]
    anchors: Callable[[Units, np.ndarray], tuple[np.ndarray, np.ndarray]]
    slices: Callable[[bytes, int, int], Iterator[tuple[int, bytes]]]


def byte_slices(text: bytes, size: int, n_bytes: int) -> Iterator[tuple[int, bytes]]:
    for first in range(0, max(len(text) - size + 1, 1), n_bytes):
        yield first, text[first:first + n_bytes + size - 1]


WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def word_slices(text: bytes, size: int, n_bytes: int) -> Iterator[tuple[int, bytes]]:
    at, first, wanted = 0, 0, n_bytes
    while True:
        end = at + wanted
        if end >= len(text):
            yield first, text[at:]
            return
        # To the end of a word; a slice has more words than a window.
        last = WORD.match(text, end)
        end = last.end() if last else end
        begins = [m.start() for m in WORD.finditer(text, at, end)]
        if len(begins) <= size:
            wanted *= 2
            continue
        yield first, text[at:end]
        done = len(begins) - size + 1
        at, first, wanted = begins[done] if done < len(begins) else end, first + done, n_bytes


def portions(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[bytes]]]:
    """The rows of a batch (row number, text) in lists of bounded size; null text is empty."""
    rows, texts, held = [], [], 0
    for row, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
        text = text or b""
        if rows and held + len(text) > WORK_BYTES:
            yield rows, texts
            rows, texts, held = [], [], 0
        rows.append(row)
        texts.append(text)
        held += len(text)
    if rows:
        yield rows, texts


def sliced(batch: pa.RecordBatch, method: Method) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts of a batch in lists of bounded size, long ones in slices: places in the batch, first units, texts."""
    places, firsts, texts, held = [], [], [], 0
    for place, text in enumerate(batch.column(1).cast(pa.binary())):
        text = text.as_py() or b""
        parts = [(0, text)] if len(text) <= WORK_BYTES else method.slices(text, method.size, WORK_BYTES)
        for first, part in parts:
            if texts and held + len(part) > WORK_BYTES:
                yield places, firsts, texts
                places, firsts, texts, held = [], [], [], 0
            places.append(place)
            firsts.append(first)
            texts.append(part)
            held += len(part)
    if texts:
        yield places, firsts, texts


def window_starts(units: Units, size: int) -> tuple[np.ndarray, np.ndarray]:
    """All window starts, and the number of the document each is in."""
    counts = np.maximum(units.last - units.first - size + 1, 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    return np.arange(len(doc)) - before[doc] + units.first[doc], doc


def digests(view: memoryview, begin: list[int], end: list[int], seeds: list[int]) -> np.ndarray:
    """128-bit fingerprints of slices as rows of two 64-bit numbers."""
    digest = xxhash.xxh3_128_digest
    joined = b"".join([digest(view[b:e], s) for b, e, s in zip(begin, end, seeds)])
    return np.frombuffer(joined, "<i8").reshape(-1, 2)


ROWS = "row long, start int, width int, core long, span1 long, span2 long"


def inside(units: Units, firsts: list[int], places: list[list[int] | None], size: int) -> np.ndarray:
    """Whether a window that starts at a unit lies within one of the runs of its document."""
    allowed = np.zeros(len(units.offsets), bool)
    for begin, last, first, own in zip(units.first.tolist(), units.last.tolist(), firsts, places):
        for start, end in union(own):
            a, b = max(start - first, 0), min(end - size + 1 - first, last - begin)
            if a < b:
                allowed[begin + a:begin + b] = True
    return allowed


def anchor_rows(method: Method) -> Callable:
    """Rows of row, text and, if only windows within known runs may repeat, places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(2).to_pylist() if batch.num_columns > 2 else None
            rows = batch.column(0).to_numpy()
            for own_places, firsts, texts in sliced(batch, method):
                units = method.layout(texts)
                starts, doc = window_starts(units, method.size)
                if places is not None:
                    near = inside(units, firsts, [places[k] for k in own_places], method.size)[starts]
                    starts, doc = starts[near], doc[near]
                if not len(starts):
                    continue
                anchor, core = method.anchors(units, starts)
                breaks = (np.diff(anchor) != 0) | (core[1:] != core[:-1]) | (np.diff(starts) != 1)
                new = np.concatenate(([True], breaks))
                head = np.flatnonzero(new)
                tail = np.append(head[1:], len(starts)) - 1
                s0, s1 = starts[head], starts[tail]
                spans = digests(
                    memoryview(units.bytes_), units.offsets[s0].tolist(),
                    units.offsets[s1 + method.size].tolist(), (anchor[head] - s0).tolist())
                own = doc[head]
                yield pa.RecordBatch.from_arrays([
                    pa.array(rows[np.array(own_places)[own]]),
                    pa.array((s0 - units.first[own] + np.array(firsts)[own]).astype(np.int32)),
                    pa.array((s1 - s0 + 1).astype(np.int32)),
                    pa.array(core[head].view(np.int64)),
                    pa.array(spans[:, 0].copy()), pa.array(spans[:, 1].copy()),
                ], ["row", "start", "width", "core", "span1", "span2"])
    return run


def window_rows(method: Method) -> Callable:
    """Fingerprints of the windows asked for: rows of row, text, asked (list of start << 32 | width)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked, rows = batch.column(2).to_pylist(), batch.column(0).to_numpy()
            for places, firsts, texts in sliced(batch, method):
                units = method.layout(texts)
                windows = (units.last - units.first - method.size + 1).tolist()
                own, starts = [], []
                for k, (place, first) in enumerate(zip(places, firsts)):
                    for packed in asked[place]:
                        begin, width = packed >> 32, packed & 0xFFFFFFFF
                        begin, end = max(begin - first, 0), min(begin + width - first, windows[k])
                        if begin < end:
                            own.append(np.full(end - begin, k))
                            starts.append(np.arange(begin, end))
                if not own:
                    continue
                doc, start = np.concatenate(own), np.concatenate(starts)
                place = start + units.first[doc]
                keys = digests(
                    memoryview(units.bytes_), units.offsets[place].tolist(),
                    units.offsets[place + method.size].tolist(), [0] * len(place))
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy()),
                    pa.array(rows[np.array(places)[doc]]),
                    pa.array((start + np.array(firsts)[doc]).astype(np.int32)),
                ], ["key1", "key2", "row", "start"])
    return run


def numbered_copy(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The documents (struct ``doc``) with a row number, written in buckets of it: later joins do not move texts."""
    spark = docs.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)
    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), wrapped(docs).alias("doc"))
    name = f"numbered_{uuid.uuid4().hex[:12]}"
    scratch.count += 1
    (numbered.repartition(buckets, "_row").write.bucketBy(buckets, "_row").sortBy("_row")
     .option("compression", "zstd").option("path", f"{scratch.root}/{scratch.count:03d}")
     .format("parquet").saveAsTable(name))
    scratch.free()
    table = spark.table(name)
    # The files are read by their path from here on; no entry stays in the catalog.
    spark.sql(f"DROP TABLE {name}")
    return table


def packed(start: Column, other: Column) -> Column:
    return F.shiftleft(start.cast("long"), 32) + other.cast("long")


@dataclass
class Corpus:
    """A numbered table whose equal texts stand for each other.

    ``texts`` (_row, text) has one row of each text, ``copies`` (_row) all rows whose text another row has.
    """

    numbered: DataFrame
    texts: DataFrame
    copies: DataFrame


def corpus_of(docs: DataFrame, scratch: Scratch) -> Corpus:
    """Only row numbers and digests are joined; texts are left where they are."""
    numbered = numbered_copy(docs, scratch)
    digests_ = scratch.write(
        numbered.select("_row", F.unhex(F.md5(F.col("doc.text").cast("binary"))).alias("digest"))
        .where("digest is not null"))
    groups = scratch.write(digests_.groupBy("digest").agg(
        F.count("*").alias("n"), F.min("_row").alias("first")).where("n > 1").drop("n"))
    copies = scratch.write(digests_.join(groups, "digest").select("_row", "first"))
    others = copies.where(F.col("_row") != F.col("first")).select("_row")
    texts = numbered.join(others, "_row", "left_anti").select("_row", "doc.text")
    return Corpus(numbered, texts, copies.select("_row"))


def repeated_places(
    corpus: Corpus, method: Method, scratch: Scratch, within: DataFrame | None = None, by_turn: bool = False
) -> DataFrame:
    """The repeated windows of a corpus: row, places (list of start << 32 | end, unit numbers).

    Rows without a repeat are absent. Intervals may overlap; their union is what repeated windows cover.
    A text that another row has is repeated from 0 to WHOLE. ``within`` is such a table for a smaller window of
    the same units: a repeated window lies in one of its runs, so no other is looked at. ``by_turn`` compares
    single windows in the turns of their cores, too, for half the disk and more scans.
    """
    size, texts = method.size, corpus.texts
    searched = texts if within is None else texts.join(within, "_row").select("_row", "text", "places")
    rows = scratch.write(searched.mapInArrow(anchor_rows(method), ROWS), large=True)
    # Rows whose core stands elsewhere, too.
    seen = scratch.write(rows.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core"), large=True)
    shared = scratch.write(rows.join(seen, "core", "left_semi"), large=True)
    scratch.drop(rows)
    scratch.drop(seen)
    # Equal spans have equal cores, so cores are taken in turns, each of which frees its shuffle files.
    turns = []
    for turn in range(TURNS):
        own = shared.where(F.pmod("core", F.lit(TURNS)) == turn)
        spans = scratch.write(own.groupBy("span1", "span2").agg(
            F.count("*").alias("n"), F.min("core").alias("core"), F.min("row").alias("first_row")), large=True)
        # Written, so that the join below has an exchange on both sides and may be split.
        mixed = scratch.write(spans.groupBy("core").agg(F.count("*").alias("m"), F.min("n").alias("least")).where(
            "m > 1 and least = 1").select("core", F.lit(True).alias("mixed")))
        marked = own.select("row", "start", "width", "span1", "span2").join(
            spans.join(mixed, "core", "left").select("span1", "span2", "n", "first_row", "mixed"),
            ["span1", "span2"])
        turns.append(scratch.write(marked.select(
            "row", "start", "width", (F.col("n") > 1).alias("repeated"),
            (F.coalesce("mixed", F.lit(False)) & ((F.col("n") == 1) | (F.col("row") == F.col("first_row"))))
            .alias("open")).where("repeated or open"), large=True))
        for df in (spans, mixed):
            scratch.drop(df)
    scratch.drop(shared)
    found = reduce(DataFrame.unionByName, turns)

    def requested(spans: DataFrame) -> DataFrame:
        asked = spans.groupBy(F.col("row").alias("_row")).agg(
            F.collect_list(packed(F.col("start"), F.col("width"))).alias("asked"))
        return texts.join(asked, "_row").select("_row", "text", "asked").mapInArrow(
            window_rows(method), "key1 long, key2 long, row long, start int")

    places = found.where("repeated").select("row", "start", "width")
    for own in turns if by_turn else [found]:
        twice = scratch.write(requested(own.where("open")).groupBy("key1", "key2").agg(
            F.count("*").alias("n")).where("n > 1").select("key1", "key2"), large=True)
        # Repeated spans only stood by as partners; what they cover is known.
        undecided = requested(own.where("open and not repeated"))
        places = places.unionByName(scratch.write(undecided.join(twice, ["key1", "key2"], "left_semi").select(
            "row", "start", F.lit(1).alias("width")), large=True))
        scratch.drop(twice)
    end = F.col("start") + F.col("width") + F.lit(size - 1)
    gathered = places.groupBy(F.col("row").alias("_row")).agg(
        F.collect_list(packed(F.col("start"), end)).alias("places"))
    whole = corpus.copies.select("_row", F.array(packed(F.lit(0), F.lit(WHOLE))).alias("places"))
    return gathered.join(corpus.copies, "_row", "left_anti").unionByName(whole)


def runs(places: list[int] | None, n_units: int, size: int) -> list[tuple[int, int]]:
    """What repeated windows of ``size`` units cover in a text of ``n_units``: none if it is shorter."""
    return [(s, min(e, n_units)) for s, e in union(places)] if n_units >= size else []


def union(places: list[int] | None) -> list[tuple[int, int]]:
    """Disjoint, maximal intervals in order; touching intervals are one."""
    merged: list[list[int]] = []
    for packed in sorted(places or []):
        start, end = packed >> 32, packed & 0xFFFFFFFF
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return [(s, e) for s, e in merged]


def remainders(docs: DataFrame, method: Method, label: str, shorter: Method | None = None) -> DataFrame:
    """Each document as a struct ``doc`` with ``places``, its repeated intervals by unit number (null if none).

    ``runs`` says what they cover of a text. ``shorter``, the same method with smaller windows, adds ``passages``, the intervals of those.
    """
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, label)
    corpus = corpus_of(docs, scratch)
    numbered = corpus.numbered
    if shorter is None:
        places = scratch.write(repeated_places(corpus, method, scratch), large=True)
        return numbered.join(places, "_row", "left").select("doc", "places")
    if shorter.size > method.size:
        raise ValueError("the shorter windows are the longer ones")
    passages = scratch.write(repeated_places(corpus, shorter, scratch, by_turn=True), large=True)
    places = scratch.write(repeated_places(corpus, method, scratch, within=passages), large=True)
    found = passages.select("_row", F.col("places").alias("passages")).join(places, "_row", "left")
    return numbered.join(found, "_row", "left").select("doc", "places", "passages")
