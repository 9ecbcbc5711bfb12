"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling.

Two words are one inserted, deleted or replaced code point apart exactly when their common prefix and their
common suffix together reach the longer length minus one. One of the two then has at least half of that, so
near words meet under a key: the longer length, a side, and that many code points of the side. The words of
a key are a tile. A tile holds them as two padded code-point matrices, one flush left, one flush right, and
compares all its rows at once, column by column. A key with many words is dealt into blocks, each pair of
blocks is a tile, and no tile holds more than about two blocks.

Every word then points at its commonest near word where that is common enough, and pointers are doubled
until they end.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import Scratch, small_batches
from readloom.llm.tokens import byte_table, token_counts

# Words of a key in one block of a tile.
BLOCK = 512
# Distinct words that a task counts before it hands on a table.
HELD_WORDS = 1 << 18
# Latin-1 letters: other code points become separators, and a byte is a code point.
LETTERS = byte_table({*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)})


@dataclass(frozen=True)
class Rule:
    """Which words count, how words are damaged on purpose, and what a form must have."""

    min_length: int = 5
    min_count: int = 3
    # A word of a document loses a code point where this divides the checksum of both; 0: never.
    damage: int = 97
    # A form has at least so many times the occurrences of the word.
    ratio: int = 2


def damaged(run: bytes, prefix: int, modulus: int) -> bytes:
    """The run without the code point its checksum names, if the checksum is a multiple of ``modulus``."""
    checksum = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
    if checksum % modulus:
        return run
    at = checksum % len(run)
    return run[:at] + run[at + 1:]


def _counted(rule: Rule) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in held], pa.string()),
                 pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                prefix = zlib.crc32(f"{doc_id}:".encode())
                for word, n in token_counts(text.encode("latin-1", "replace"), LETTERS).items():
                    if rule.damage:
                        word = damaged(word, prefix, rule.damage)
                    if len(word) >= rule.min_length:
                        held[word] = held.get(word, 0) + n
                if len(held) >= HELD_WORDS:
                    yield table()
                    held = {}
        if held:
            yield table()
    return run


def word_counts(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``word``, ``n``: the words of all whole texts with enough code points and occurrences.

    A null text has no words; a null id counts as an empty one; repeated rows count again.
    """
    small_batches(docs.sparkSession)
    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    counted = docs.select(ids.alias("doc_id"), "text").mapInArrow(_counted(rule), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= rule.min_count)


def matrix(words: list[str], width: int, left: bool) -> np.ndarray:
    """One row of code points a word, padded with 0 on the other side."""
    padded = [w.ljust(width, "\0") if left else w.rjust(width, "\0") for w in words]
    return np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), width)


def common(a: np.ndarray, b: np.ndarray, known: int) -> np.ndarray:
    """For each row of ``a`` against each of ``b``, how many first columns agree; ``known`` of them do."""
    same = np.ones((len(a), len(b)), bool)
    length = np.full(same.shape, known, np.int32)
    for column in range(known, a.shape[1]):
        same &= a[:, column][:, None] == b[:, column][None, :]
        if not same.any():
            break
        length += same
    return length


def tile_pairs(longest: int, suffix: bool, a: list[str], b: list[str] | None) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` (or in ``a`` twice, each pair once) of near words, the longer with ``longest``.

    A pair that also meets in the tile of its prefix is left to that one.
    """
    known = longest // 2
    left = matrix(a, longest, True), matrix(b, longest, True) if b is not None else None
    right = matrix(a, longest, False)[:, ::-1], matrix(b, longest, False)[:, ::-1] if b is not None else None
    prefix = common(left[0], left[0] if b is None else left[1], 0 if suffix else known)
    tail = common(right[0], right[0] if b is None else right[1], known if suffix else 0)
    long_a = np.array([len(w) for w in a]) == longest
    long_b = long_a if b is None else np.array([len(w) for w in b]) == longest
    near = (prefix + tail >= longest - 1) & (long_a[:, None] | long_b[None, :])
    if suffix:
        near &= prefix < known
    if b is None:
        near = np.triu(near, 1)
    return np.nonzero(near)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of tile: tile, longest, suffix, halves (whether the tile has two blocks), block, word, n."""
    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns])

    out: tuple[list, list, list] = ([], [], [])

    def table() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())],
            ["word", "near", "near_n"])

    for _, own in groupby(rows(), key=lambda r: r[0]):
        own = list(own)
        longest, suffix, halves = own[0][1:4]
        first = [r for r in own if not halves or r[4] == 0]
        second = [r for r in own if r[4] == 1] if halves else None
        if not first or second == [] or (second is None and len(first) < 2):
            continue
        at, to = tile_pairs(
            longest, suffix, [r[5] for r in first], None if second is None else [r[5] for r in second])
        for i, j in zip(at.tolist(), to.tolist()):
            x, y = first[i], (first if second is None else second)[j]
            for column, pair in zip(out, ((x[5], y[5]), (y[5], x[5]), (y[6], x[6]))):
                column.extend(pair)
        if len(out[0]) >= 1 << 16:
            yield table()
            for column in out:
                column.clear()
    if out[0]:
        yield table()


def near_words(words: DataFrame, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """``word``, ``near``, ``near_n``: all pairs of distinct words one edit apart, both ways.

    ``words`` is a written table of distinct ``word`` of two code points or more, with ``n``.
    """
    spark = words.sparkSession
    length = F.length("word")
    # As the longer word or as long as the other; as the shorter one.
    sides = words.select("word", "n", F.explode(F.array(length, length + 1)).alias("longest")).select(
        "word", "n", "longest", F.explode(F.array(F.lit(False), F.lit(True))).alias("suffix"))
    half = F.floor(F.col("longest") / 2).cast("int")
    keyed = sides.withColumn("part", F.when(
        F.col("suffix"), F.substring(F.col("word"), -half, half)).otherwise(F.substring(F.col("word"), F.lit(1), half)))
    key = ["longest", "suffix", "part"]
    counts = keyed.groupBy(*key).agg(F.count("*").alias("m"), F.max(length).alias("top"))
    # A key without a word of the longer length, or with one word, has no pair.
    used = scratch.write(counts.where("m > 1 and top = longest").select(
        *key, F.ceil(F.col("m") / F.lit(block)).cast("int").alias("blocks")))
    dealt = keyed.join(used, key).withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    tiles = other.select(
        F.concat_ws("/", "longest", "suffix", low, high, "part").alias("tile"), "longest", "suffix",
        (low != high).alias("halves"), F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("block"),
        "word", "n")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return tiles.repartition(tasks, "tile").sortWithinPartitions("tile").mapInArrow(
        _compared, "word string, near string, near_n long")


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word``, ``root`` for a written table of ``word``, ``form`` without cycles: where the forms end."""
    links = forms.select("word", F.col("form").alias("root"))
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = scratch.write(links.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if links.where("moved").isEmpty():
            return links.select("word", "root")
        links = links.select("word", "root")


def spelling_groups(docs: DataFrame, rule: Rule = Rule(), block: int = BLOCK) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    ``n`` counts the word over all texts, ``n_near`` the words one edit away. ``form`` is the near word of
    largest n (ties: the first in code-point order) if that is at least ``rule.ratio`` times the word's n,
    else null, as is ``form_n``; ``root`` is where the forms end, the word itself if it has none. Null and
    empty texts have no words, equal rows count as often as they stand, an empty table gives an empty table.
    """
    if rule.min_length < 2 or rule.ratio < 2:
        raise ValueError("words need two code points, and a form must be more frequent than its word")
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.write(word_counts(docs, rule), large=True)
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near").alias("form")))
    near = scratch.write(near_words(words, scratch, block).groupBy("word").agg(
        F.count("*").alias("n_near"), best.alias("best")).select(
        "word", "n_near", "best.form", (-F.col("best.minus_n")).alias("form_n")), large=True)
    enough = F.col("form_n") >= F.lit(rule.ratio) * F.col("n")
    judged = scratch.write(words.join(near, "word", "left").select(
        "word", F.when(enough, F.col("form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("form_n")).alias("form_n")))
    ends = roots(judged.where("form is not null"), scratch)
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
