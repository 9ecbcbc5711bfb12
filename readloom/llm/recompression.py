"""Substring deduplication by recompression: rounds name runs and pairs until symbols are long.

A text starts as a row of words. Each round names runs of equal symbols, then pairs of a symbol from the
left half and one from the right half of the alphabet. A name is a fingerprint of what it stands for, so
all tasks name alike and no dictionary is exchanged. Equal substrings thus get the same symbols inside,
whatever surrounds them; only near their ends do neighbours decide.

Each symbol carries its *context*: the words that fix it wherever they occur. For a window of ``size``
words the places between two symbols whose context lies inside it are known from the window alone; among
those of the highest round, the least fingerprint of the two neighbours is the window's anchor. The names
of the two neighbours are the core that reveals repeats, spans and windows verify them (``repeats``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.repeats import Method, Units, remainders, runs, word_slices

SIZE = 35
ROUNDS = 4
# A byte that UTF-8 never holds, as a word between documents.
MARK = 0xFF

BASE = np.uint64(0x9E3779B97F4A7C15)
MIXES = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIXES[0]
    x = (x ^ (x >> np.uint64(27))) * MIXES[1]
    return x ^ (x >> np.uint64(31))


def word_layout(texts: list[bytes]) -> Units:
    """Words, each with one blank behind it; a mark stands before, between and behind the documents."""
    raw = np.frombuffer(bytes([32, MARK, 32]).join([b"", *texts, b""]), np.uint8)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    plain = np.where(blank, np.uint8(32), raw)[keep]
    offsets = np.concatenate(([0], np.flatnonzero(plain == 32) + 1))
    marks = np.flatnonzero(plain[offsets[:-1]] == MARK)
    return Units(plain.tobytes(), offsets, marks[:-1] + 1, marks[1:])


def word_names(units: Units) -> np.ndarray:
    plain = np.frombuffer(units.bytes_, np.uint8)
    begin, length = units.offsets[:-1], np.diff(units.offsets)
    inside = np.arange(len(plain)) - np.repeat(begin, length)
    powers = np.cumprod(np.full(int(length.max()), BASE, np.uint64))
    return mix(np.add.reduceat((plain.astype(np.uint64) + np.uint64(1)) * powers[inside], begin))


@dataclass
class Symbols:
    """Names, first word and context (first word, word behind the last) of a row of symbols."""

    name: np.ndarray
    start: np.ndarray
    low: np.ndarray
    high: np.ndarray


def one_round(s: Symbols, salt: int, n_words: int) -> Symbols:
    # Runs. That a run ends here is known from the symbols beside it.
    head = np.flatnonzero(np.concatenate(([True], s.name[1:] != s.name[:-1])))
    tail = np.append(head[1:], len(s.name)) - 1
    count = (tail - head + 1).astype(np.uint64)
    name = np.where(count > 1, mix(s.name[head] + count * BASE), s.name[head])
    low = np.append(-1, s.low)[head]
    high = np.append(s.high, n_words + 1)[tail + 1]
    start = s.start[head]
    # Pairs. A left symbol that stays alone needs to see the next, a right one the one before.
    half = mix(name ^ mix(np.array([salt], np.uint64)))
    right = (half >> np.uint64(63)).astype(bool)
    opens = np.append(~right[:-1] & right[1:], False)
    closes = np.append(False, opens[:-1])
    following = np.append(name[1:], np.uint64(0))
    paired = mix(mix(name + np.uint64(salt)) * np.uint64(3) + following)
    next_high = np.append(high[1:], n_words + 1)
    previous_low = np.append(-1, low[:-1])
    new_low = np.where(right & ~closes, previous_low, low)
    new_high = np.where(right, high, next_high)
    kept = ~closes
    return Symbols(np.where(opens, paired, name)[kept], start[kept], new_low[kept], new_high[kept])


def range_minimum(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least of values[begin[i]:end[i]] for each i; every range has a member."""
    length = end - begin
    result = np.empty(len(begin), values.dtype)
    table, width = values, 1
    while True:
        here = (length >= width) & (length < 2 * width)
        result[here] = np.minimum(table[begin[here]], table[end[here] - width])
        width *= 2
        if width > length.max():
            return result
        table = np.minimum(table[:-(width // 2)], table[width // 2:])


def symbol_borders(size: int, rounds: int) -> Callable[[Units, np.ndarray], tuple]:
    low32 = np.uint64(0xFFFFFFFF)

    def anchors(units: Units, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n_words = len(units.offsets) - 1
        at = np.arange(n_words)
        levels = [Symbols(word_names(units), at, at, at + 1)]
        for k in range(rounds):
            levels.append(one_round(levels[-1], k + 1, n_words))
        anchor = np.empty(len(starts), np.int64)
        core = np.empty(len(starts), np.uint64)
        left = np.arange(len(starts))
        for level in range(rounds, -1, -1):
            s = levels[level]
            if len(s.name) < 2 or not len(left):
                continue
            low, high = s.low[:-1], s.high[1:]
            print_ = mix(mix(s.name[:-1] + np.uint64(level)) * np.uint64(5) + s.name[1:])
            begin = np.searchsorted(low, starts[left], "left")
            end = np.searchsorted(high, starts[left] + size, "right")
            has = end > begin
            if not has.any():
                continue
            order = (print_ & ~low32) | np.arange(len(print_), dtype=np.uint64)
            best = (range_minimum(order, begin[has], end[has]) & low32).astype(np.int64)
            anchor[left[has]] = s.start[best + 1]
            core[left[has]] = print_[best]
            left = left[~has]
        return anchor, core
    return anchors


def word_method(size: int = SIZE, rounds: int = ROUNDS) -> Method:
    if size < 2:
        raise ValueError("a window has two words or more")
    return Method(size, word_layout, symbol_borders(size, rounds), word_slices)


def _report(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, places in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                words = (text or b"").split()
                kept, at = [], 0
                for start, end in runs(places, len(words), size):
                    kept += words[at:start]
                    at = end
                kept += words[at:]
                rows.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            columns = [pa.array([r[k] for r in rows], kind)
                       for k, kind in enumerate((pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], ["doc_id", "n_words", "n_removed", "kept_sha256"])
    return run


def repeat_report(docs: DataFrame, size: int = SIZE, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: its words, those removed, a digest of the words left.

    Null and blank texts have no words; texts of fewer than ``size`` words lose nothing. Equal rows are
    occurrences of their own, so copies of ``size`` words or more lose everything, the first included. An
    empty table gives an empty table.
    """
    table = remainders(docs.select("doc_id", "text"), word_method(size, rounds), "recompression")
    return table.select(F.col("doc.doc_id").cast("long").alias("doc_id"), "doc.text", "places").mapInArrow(
        _report(size), "doc_id long, n_words long, n_removed long, kept_sha256 string")
