"""Suffix-array deduplication by bytes, with hashes in place of a radix sort that stops at the threshold.

Only which suffixes are equal down to ``size`` bytes matters, so no suffix is ordered: groups of equal
leading bytes are groups of equal hashes, and a suffix leaves as soon as its group has one member. The first
pass groups sampled suffixes (the least 8-byte code among SPREAD neighbours, so every window of ``size``
bytes holds a sampled suffix with that many bytes left) by their leading ``size - SPREAD + 1`` bytes; the
next compares all windows around a sample at once; the last compares single windows where these still
differ. Equal groups of the last passes are the repeated windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.llm.repeats import Method, Units, byte_slices, remainders, runs

SIZE = 400
# Neighbouring suffixes of which one is sampled; a third of the threshold or less.
SPREAD = 128
# Passages of more than 50 words of prose are hardly ever shorter than this many bytes.
PASSAGE = 240
PASSAGE_SPREAD = 128
CODE = 8
MIX = np.uint64(0x9E3779B97F4A7C15)


def byte_layout(texts: list[bytes]) -> Units:
    lengths = np.array([len(t) for t in texts], np.int64)
    last = np.cumsum(lengths)
    joined = b"".join(texts)
    return Units(joined, np.arange(len(joined) + 1), last - lengths, last)


def sampled_suffixes(size: int, spread: int) -> Callable[[Units, np.ndarray], tuple]:
    """Anchors: of the ``spread`` suffixes from a window's start on, the first with the least code."""
    low = np.uint64(0xFFFFFFFF)

    def anchors(units: Units, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = int(starts[-1]) + spread
        codes = np.ndarray((n,), "<u8", units.bytes_, 0, (1,)) * MIX
        codes &= ~low
        codes |= np.arange(n, dtype=np.uint64)
        width = 1
        while 2 * width <= spread:
            codes = np.minimum(codes[:-width], codes[width:])
            width *= 2
        if width < spread:
            codes = np.minimum(codes[:width - spread], codes[spread - width:])
        anchor = (codes & low).astype(np.int64)[starts]
        new = np.concatenate(([True], np.diff(anchor) != 0))
        view, deep, digest = memoryview(units.bytes_), size - spread + 1, xxhash.xxh3_64_intdigest
        cores = np.array([digest(view[a:a + deep]) for a in anchor[new].tolist()], np.uint64)
        core = cores[np.cumsum(new) - 1]
        return anchor, core
    return anchors


def byte_method(size: int = SIZE, spread: int | None = None) -> Method:
    if size < 3 * CODE:
        raise ValueError(f"the threshold must be {3 * CODE} bytes or more")
    spread = spread or min(SPREAD, size // 3)
    return Method(size, byte_layout, sampled_suffixes(size, spread), byte_slices)


def _cut(text: bytes, places: list[int] | None, size: int) -> tuple[bytes, list[tuple[int, int]]]:
    gone = runs(places, len(text), size)
    kept, at = [], 0
    for start, end in gone:
        kept.append(text[at:start])
        at = end
    return b"".join([*kept, text[at:]]), gone


REPORT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _report(size: int, passage: int | None = None) -> Callable:
    """Rows of doc_id, text, places; a fourth column of passages adds their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, places in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                kept, gone = _cut(text or b"", places, size)
                rows.append((len(text or b""), sum(e - s for s, e in gone), len(gone),
                             hashlib.sha256(kept).hexdigest()))
            columns = [pa.array([r[k] for r in rows], kind)
                       for k, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if passage:
                shorter = [runs(p, r[0], passage) for p, r in zip(batch.column(3).to_pylist(), rows)]
                columns += [pa.array([sum(e - s for s, e in own) for own in shorter], pa.int64()),
                            pa.array([len(own) for own in shorter], pa.int64())]
                names += ["n_passage_bytes", "n_passages"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)
    return run


def repeat_report(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """One row per document: its bytes, those removed, the removed runs, a digest of what is left.

    Null text is empty. Texts shorter than ``size`` lose nothing. Equal rows are occurrences of their own,
    so copies of ``size`` bytes or more lose everything, the first copy included. An empty table gives an
    empty table.
    """
    table = remainders(docs.select("doc_id", "text"), byte_method(size), "suffix")
    return table.select(F.col("doc.doc_id").cast("long").alias("doc_id"), "doc.text", "places").mapInArrow(
        _report(size), REPORT)


def passage_report(
    docs: DataFrame, size: int = SIZE, passage: int = PASSAGE, spread: int | None = PASSAGE_SPREAD
) -> DataFrame:
    """``repeat_report`` and, of repeated strings of ``passage`` bytes, the bytes they cover and their runs.

    The columns n_passage_bytes and n_passages tell of repeats too short to be removed. Strings of ``size``
    bytes are only looked for within the runs of the shorter ones, which hold all of them.
    """
    table = remainders(
        docs.select("doc_id", "text"), byte_method(size), "suffix", byte_method(passage, spread))
    return table.select(
        F.col("doc.doc_id").cast("long").alias("doc_id"), "doc.text", "places", "passages").mapInArrow(
        _report(size, passage), REPORT + ", n_passage_bytes long, n_passages long")


def without_repeats(docs: DataFrame, size: int = SIZE, spread: int | None = None) -> DataFrame:
    """The documents without their repeated bytes; same columns as ``docs``, no row is dropped.

    A code point that loses some of its bytes is removed whole. Null text stays null. ``n_chars``, where
    it is there, follows the new text.
    """
    table = remainders(docs, byte_method(size, spread), "suffix")
    hit = F.col("places").isNotNull()
    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields = dict(zip(names, batch.column(0).flatten()))
            texts = fields["text"].cast(pa.binary()).to_pylist()
            fields["text"] = pa.array(
                [_cut(t or b"", p, size)[0].decode("utf-8", "ignore")
                 for t, p in zip(texts, batch.column(1).to_pylist())], pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.StructArray.from_arrays(list(fields.values()), names)], ["doc"])

    changed = table.where(hit).mapInArrow(cut, T.StructType([T.StructField("doc", docs.schema)])).select("doc.*")
    if "n_chars" in names:
        changed = changed.withColumn(
            "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return table.where(~hit).select("doc.*").unionByName(changed)
