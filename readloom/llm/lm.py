"""Language-model scoring from a log-frequency Bloom filter of quantised n-gram counts.

Training counts words and word pairs in one shuffle. A count becomes a level of a coarse ladder, and the
filter holds an n-gram once for each level up to its own; probing levels until one is missing gives the
count back. The filter grows with the number of n-grams. Up to ``BROADCAST_BITS`` it travels to all workers;
a larger one stays in parts of bounded size, and the n-grams of the texts are sent to the parts that hold
them. Both ways give the same scores. A pair's probability blends the pair with the word, by the share of
its context that repeated pairs make up:

    p(w | v) = D c(vw) / c(v) + (1 - D m(v) / c(v)) p(w),   m(v) = sum of c(vw) over pairs seen twice or more

The add-one-half base needs exact counts: a bounded table of the most frequent words is broadcast, words
outside it are joined.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm import bloom
from readloom.llm.common import Scratch, small_batches
from readloom.llm.recompression import mix, word_layout, word_names
from readloom.llm.repeats import portions

DISCOUNT = 0.8
# Weight of repeated pairs in a context at most, so that new words keep some probability.
MOST_PAIRED = 0.9
LADDER_STEP = 1.25
BITS_PER_ITEM = 10
# A filter up to this size is broadcast (4 MB, about what a core has at hand); a larger one stays in parts.
BROADCAST_BITS = 1 << 25
# Words with exact counts that are broadcast.
MAX_FREQUENT = 1 << 19
# Tokens a task counts before it hands on a table.
COUNT_TOKENS = 1 << 21
# Segments in one part of a filter that is not broadcast: 512 KB, many more parts than tasks.
PART_SEGMENTS = 1 << 6
# Parts are asked in so many rounds, each of which frees its shuffle files.
ROUNDS = 2
# Numbers that no portion has: items come first in their part, then what is asked for frequent words.
NO_PORTION = -2
FREQUENT = -1

# Stands for the end of a text and for what precedes its first word.
END = np.uint64(0x6C62272E07BB0142)
PAIR = np.uint64(1)
TOP = np.uint64(0xFFFFFFFF00000000)
# Bits of a key that the filter uses: of a pair those of both words together and some of the first.
KEY_BYTES = 5
KEY_BITS = np.uint64((1 << 8 * KEY_BYTES) - 1)
MASS = np.uint64(0xD6E8FEB86659FD93)


def ladder(step: float = LADDER_STEP, top: int = 1 << 50) -> np.ndarray:
    """Counts that levels 1, 2, ... stand for: 1, 2, 3, ... and then in growing steps."""
    values = [1]
    while values[-1] < top:
        values.append(max(values[-1] + 1, int(values[-1] * step)))
    return np.array(values, np.int64)


LEVELS = ladder()


def item(keys: np.ndarray, level: int) -> np.ndarray:
    return mix((keys & KEY_BITS) + np.uint64(level) * np.uint64(2))


def token_keys(texts: list[bytes]) -> list[np.ndarray]:
    """Fingerprints of the words of each text, then its end; even numbers."""
    units = word_layout([t.lower() for t in texts])
    names = word_names(units) & ~PAIR
    return [np.append(names[a:b], END) for a, b in zip(units.first, units.last)]


def pair_keys(tokens: np.ndarray) -> np.ndarray:
    """Odd numbers whose upper half tells the first word, the lower half the second in its company."""
    before = np.append(END, tokens[:-1])
    return (before & TOP) | (mix(before * np.uint64(3) + tokens) & ~TOP) | PAIR


def mass_keys(context: np.ndarray) -> np.ndarray:
    return mix((context & TOP) ^ MASS) & ~PAIR


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and pairs with their counts, in tables that cover up to COUNT_TOKENS tokens each."""
    held, n_held = [], 0

    def table() -> pa.RecordBatch:
        key, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])

    for batch in batches:
        for _, texts in portions(batch):
            for tokens in token_keys(texts):
                held += [tokens, pair_keys(tokens)]
                n_held += len(tokens)
            if n_held >= COUNT_TOKENS:
                yield table()
                held, n_held = [], 0
    if held:
        yield table()


@dataclass
class Distinct:
    """The distinct words and pairs of texts in a row, and where each token finds its own.

    ``known`` says which words are frequent, ``spot`` where those stand among the frequent ones.
    """

    words: np.ndarray
    at_word: np.ndarray
    known: np.ndarray
    spot: np.ndarray
    pairs: np.ndarray
    at_pair: np.ndarray

    @staticmethod
    def of(tokens: np.ndarray, frequent: np.ndarray) -> Distinct:
        words, at_word = np.unique(tokens, return_inverse=True)
        pairs, at_pair = np.unique(pair_keys(tokens), return_inverse=True)
        spot, known = np.searchsorted(frequent, words), np.zeros(len(words), bool)
        if len(frequent):
            spot = np.minimum(spot, len(frequent) - 1)
            known = frequent[spot] == words
        return Distinct(words, at_word, known, spot[known], pairs, at_pair)

    def asked(self) -> np.ndarray:
        """What the filter is asked: words that are not frequent, the mass behind them, and all pairs."""
        rare = self.words[~self.known]
        return np.concatenate([rare, mass_keys(rare), self.pairs])


@dataclass
class Model:
    """What workers need: the filter (None if it stays in parts), totals, and the exact counts of frequent words."""

    bits: np.ndarray | None
    segments: int
    n_tokens: int
    n_distinct: int
    frequent: np.ndarray
    frequent_counts: np.ndarray
    # What the filter answers for frequent words and for the mass behind them, asked once.
    frequent_levels: np.ndarray
    frequent_mass: np.ndarray

    def level(self, keys: np.ndarray) -> np.ndarray:
        return levels(self.bits, keys, self.segments)

    def count(self, keys: np.ndarray) -> np.ndarray:
        return counts_of(self.level(keys))

    def filter_counts(self, d: Distinct, level: np.ndarray) -> tuple[np.ndarray, ...]:
        """What the filter gives for each token, for the mass behind it, and for its pair.

        ``level``: its answers to ``d.asked()``; frequent words were asked once.
        """
        n_rare = len(d.words) - np.count_nonzero(d.known)
        own, mass = np.zeros(len(d.words)), np.zeros(len(d.words))
        own[d.known], mass[d.known] = self.frequent_levels[d.spot], self.frequent_mass[d.spot]
        counts = counts_of(level)
        own[~d.known], mass[~d.known] = counts[:n_rare], counts[n_rare:2 * n_rare]
        return own[d.at_word], mass[d.at_word], counts[2 * n_rare:][d.at_pair]

    def log_probabilities(self, own: np.ndarray, mass: np.ndarray, together: np.ndarray) -> np.ndarray:
        """Of texts in a row, each behind an end token: the last token of all is one, too."""
        together = np.where(together < 2, 0, together)
        p = (own + 0.5) / (self.n_tokens + 0.5 * (self.n_distinct + 1))
        before = np.maximum(np.roll(own, 1), 1)
        share = np.minimum(DISCOUNT * np.roll(mass, 1) / before, MOST_PAIRED)
        paired = np.minimum(DISCOUNT * together / before, share)
        return np.log10(paired + (1 - share) * p)


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    """From the lower half, in which both words of a pair have their part: pairs of one word are spread, too."""
    return (keys >> np.uint64(8)) & np.uint64(segments - 1)


def segment_column(key: F.Column, segments: int) -> F.Column:
    return F.shiftright(key, 8).bitwiseAND(F.lit(segments - 1))


def levels(bits: np.ndarray, keys: np.ndarray, segments: int) -> np.ndarray:
    """Levels found before the first missing one."""
    found = np.zeros(len(keys), np.int64)
    left = np.arange(len(keys))
    while len(left):
        left = left[holds(bits, keys[left], int(found[left[0]]) + 1, segments)]
        found[left] += 1
        left = left[found[left] < len(LEVELS)]
    return found


def told_levels(bits: np.ndarray, keys: np.ndarray, segments: int) -> np.ndarray:
    """Levels of what texts ask, a byte each. Pairs of the filter were seen twice; without the second level: unseen."""
    maybe = keys & PAIR == 0
    pairs = np.flatnonzero(~maybe)
    maybe[pairs[holds(bits, keys[pairs], 2, segments)]] = True
    found = np.zeros(len(keys), np.uint8)
    found[maybe] = levels(bits, keys[maybe], segments)
    return found


def counts_of(level: np.ndarray) -> np.ndarray:
    """Counts as the ladder gives them back: the middle of a step, in proportion."""
    low = LEVELS[np.maximum(level, 1) - 1]
    high = LEVELS[np.minimum(np.maximum(level, 1), len(LEVELS) - 1)] - 1
    return np.where(level > 0, np.sqrt(low * np.maximum(high, low).astype(float)), 0.0)


def offsets(keys: np.ndarray, level, segments: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """A key keeps all its levels in one segment, which one task can fill."""
    _, inside = bloom.places(item(keys, level), segments)
    return segment_of(keys, segments), inside


def holds(bits: np.ndarray, keys: np.ndarray, level: int, segments: int) -> np.ndarray:
    """Numbers of the keys the filter has at this level; a key is dropped at its first missing bit."""
    base = segment_of(keys, segments) * np.uint64(bloom.SEGMENT_BITS)
    print_ = item(keys, level)
    left = np.arange(len(keys))
    for probe in range(bloom.PROBES):
        at = base[left] + bloom.offset(print_[left], probe)
        left = left[(bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    return left


def _places(batch_keys: pa.Array, counts: pa.Array, segments: int) -> Iterator[tuple]:
    """Segments and bits of all levels of keys with these counts."""
    keys = batch_keys.to_numpy(zero_copy_only=False).view(np.uint64)
    level = np.searchsorted(LEVELS, counts.to_numpy(zero_copy_only=False), "right")
    for k in range(1, int(level.max(initial=0)) + 1):
        yield offsets(keys[level >= k], k, segments)


def _fill(segments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return bloom.filled(
            batches, segments, lambda batch: _places(batch.column(0), batch.column(1), segments))
    return run


def narrowed(keys: np.ndarray) -> bytes:
    """The bits of keys that the filter uses, five bytes each."""
    return np.ascontiguousarray((keys & KEY_BITS).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]).tobytes()


def widened(raw: bytes | np.ndarray) -> np.ndarray:
    raw = np.frombuffer(raw, np.uint8)
    keys = np.zeros((len(raw) // KEY_BYTES, 8), np.uint8)
    keys[:, :KEY_BYTES] = raw.reshape(-1, KEY_BYTES)
    return keys.view("<u8").reshape(-1)


def byte_strings(raw: bytes, offsets: np.ndarray) -> pa.Array:
    """Byte strings that lie one behind the other."""
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)])


def flat_bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The other way: the bytes, and where each string begins and the last ends."""
    _, offsets, raw = strings.cast(pa.binary()).buffers()
    offsets = np.frombuffer(offsets, np.int32)[strings.offset:strings.offset + len(strings) + 1].astype(np.int64)
    raw = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def asked_by_part(
    texts: list[bytes], frequent: np.ndarray, segments: int, part_segments: int
) -> tuple[np.ndarray, list[np.ndarray]]:
    """The parts of the filter that texts ask, and the distinct keys for each, in an order that texts alone decide.

    Frequent words, and the mass behind them, are known everywhere and not asked.
    """
    return in_parts(Distinct.of(np.concatenate(token_keys(texts)), frequent).asked(), segments, part_segments)


def part_of(keys: np.ndarray, segments: int, part_segments: int) -> np.ndarray:
    """In the narrowest numbers, which are ordered fastest."""
    few = segments // part_segments <= 1 << 16
    return (segment_of(keys, segments) // np.uint64(part_segments)).astype(np.uint16 if few else np.int64)


def by_part(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by part that keeps that of each part; the parts; where each begins in it, and the end."""
    order = np.argsort(part, kind="stable")
    ordered = part[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(part) else np.zeros(0, np.int64)
    return order, ordered[first].astype(np.int64), np.append(first, len(part))


def in_parts(keys: np.ndarray, segments: int, part_segments: int) -> tuple[np.ndarray, list[np.ndarray]]:
    order, parts, first = by_part(part_of(keys, segments, part_segments))
    return parts, np.split(keys[order], first[1:-1])[:len(parts)]


def _asks(shared, segments: int, part_segments: int, turn: int, rounds: int):
    """What the texts of a portion ask in this round: one row a part."""
    def asked(portion: int, texts: list[bytes]) -> pa.RecordBatch:
        keys = Distinct.of(np.concatenate(token_keys(texts)), shared.value).asked()
        part = part_of(keys, segments, part_segments)
        now = np.flatnonzero(part % rounds == turn)
        order, parts, first = by_part(part[now])
        return pa.RecordBatch.from_arrays(
            [pa.array(parts), pa.array(np.full(len(parts), portion, np.int64)),
             byte_strings(narrowed(keys[now][order]), first * KEY_BYTES)], ["part", "portion", "keys"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts = None, []
        for batch in batches:
            for portion, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if texts and portion != held:
                    yield asked(held, texts)
                    texts = []
                held = portion
                texts.append(text or b"")
        if texts:
            yield asked(held, texts)
    return run


def _answers(part_segments: int):
    """Fills a part of the filter with the items that come first, then answers what is asked of it.

    An answer has the level of each key in the order of the asks, a byte each.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A part has the segments whose numbers agree but for the lowest bits, so it is a filter by itself.
        bits, held = np.zeros(part_segments * bloom.SEGMENT_BITS // 8, np.uint8), None
        for batch in batches:
            part = batch.column(0).to_numpy(zero_copy_only=False)
            is_ask = batch.column(1).to_numpy(zero_copy_only=False) != NO_PORTION
            cut = np.flatnonzero((np.diff(part) != 0) | (np.diff(is_ask) != 0)) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(part)]):
                if a == b:
                    continue
                if part[a] != held:
                    bits[:], held = 0, part[a]
                own = batch.slice(a, b - a)
                if not is_ask[a]:
                    for segment, inside in _places(own.column(2), own.column(3), part_segments):
                        base = segment * np.uint64(bloom.SEGMENT_BITS)
                        for offset in inside:
                            at = base + offset
                            np.bitwise_or.at(
                                bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
                    continue
                raw, ends = flat_bytes(own.column(4))
                found = told_levels(bits, widened(raw), part_segments)
                yield pa.RecordBatch.from_arrays(
                    [own.column(1), own.column(0), byte_strings(found.tobytes(), ends // KEY_BYTES)],
                    ["portion", "part", "levels"])
    return run


def answered(
    items: DataFrame, texts: DataFrame, segments: int, part_segments: int | None = None, turn: int = 0, rounds: int = 1,
    frequent: np.ndarray = np.zeros(0, np.uint64),
) -> DataFrame:
    """What a filter of any size says of the texts of each portion: (portion, part, levels).

    ``items`` are (key, n), ``texts`` (portion, text). The levels of a part are in the order of the keys that
    ``asked_by_part`` has for it. A task holds one part of the filter at a time; the number of parts follows
    the number of items, so what is asked of a part does not grow with the corpus. Frequent words are asked
    for once, under the portion FREQUENT: the words and then the mass behind them.
    """
    spark = items.sparkSession
    part_segments = min(part_segments or PART_SEGMENTS, segments)
    asks = texts.select("portion", "text").mapInArrow(
        _asks(spark.sparkContext.broadcast(frequent), segments, part_segments, turn, rounds),
        "part long, portion long, keys binary")
    if len(frequent):
        parts, lists = in_parts(np.concatenate([frequent, mass_keys(frequent)]), segments, part_segments)
        known = [(p, FREQUENT, narrowed(k)) for p, k in zip(parts.tolist(), lists) if p % rounds == turn]
        asks = asks.unionByName(spark.createDataFrame(known, asks.schema))
    none = F.lit(None)
    both = items.select(
        F.floor(segment_column(F.col("key"), segments) / F.lit(part_segments)).cast("long").alias("part"),
        F.lit(NO_PORTION).cast("long").alias("portion"), "key", "n", none.cast("binary").alias("keys"),
    ).where(F.col("part") % rounds == turn).unionByName(asks.select(
        "part", "portion", F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("n"), "keys"))
    # Parts are dealt out in turn, so that tasks have as many of them, give or take one.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    task = F.floor(F.col("part") / rounds).cast("long") % tasks
    return both.repartitionById(tasks, task.cast("int")).sortWithinPartitions("part", "portion").mapInArrow(
        _answers(part_segments), "portion long, part long, levels binary")


def _mass_key(pair: F.Column) -> F.Column:
    """Upper halves only; the worker that fills the filter turns them into mass keys."""
    return F.shiftright(pair, 32)


def _mass_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        upper = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) << np.uint64(32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(mass_keys(upper).view(np.int64)), batch.column(1)], ["key", "n"])


def train(docs: DataFrame, scratch: Scratch) -> tuple[Model, DataFrame, DataFrame]:
    """The model of the texts, the exact word counts (key, n), and what the filter holds (key, n)."""
    spark = docs.sparkSession
    counted = docs.select(F.lit(0).alias("row"), "text").mapInArrow(_count, "key long, n long")
    is_pair = F.col("key").bitwiseAND(F.lit(1)) == 1
    grams = scratch.write(
        counted.groupBy("key").agg(F.sum("n").alias("n")).where(~is_pair | (F.col("n") > 1)), large=True)
    words = grams.where(~is_pair)
    mass = scratch.write(
        grams.where(is_pair).groupBy(_mass_key(F.col("key")).alias("key")).agg(F.sum("n").alias("n"))
        .mapInArrow(_mass_batches, "key long, n long"))
    totals = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()

    items = grams.unionByName(mass)
    level = F.lit(1) + F.floor(F.log("n") / F.lit(float(np.log(LADDER_STEP)))).cast("long")
    n_items = items.agg(F.sum(F.least(level, F.col("n"))).alias("n")).first()["n"] or 0
    segments = bloom.n_segments(int(n_items), BITS_PER_ITEM, max_bits=1 << 62)
    bits = None
    if segments * bloom.SEGMENT_BITS <= min(BROADCAST_BITS, bloom.MAX_BITS):
        bits = bloom.put_together(items, segment_column(F.col("key"), segments), segments, _fill(segments))

    # The least count of which all words at or above it fit the bound.
    by_count = words.groupBy(F.least(F.col("n"), F.lit(1000)).alias("c")).count().orderBy(F.desc("c")).collect()
    least, room = 1001, MAX_FREQUENT
    for row in by_count:
        room -= row["count"]
        if room < 0:
            break
        least = row["c"]
    top = words.where(F.col("n") >= least).toArrow() if least <= 1000 else None
    keys = np.zeros(0, np.uint64) if top is None else top["key"].to_numpy().view(np.uint64)
    counts = np.zeros(0, np.int64) if top is None else top["n"].to_numpy()
    order = np.argsort(keys)
    keys, counts, none = keys[order], counts[order], np.zeros(0)
    model = Model(bits, segments, int(totals["n"] or 0), int(totals["v"]), keys, counts, none, none)
    if bits is not None:
        model.frequent_levels, model.frequent_mass = model.count(keys), model.count(mass_keys(keys))
    return model, words, items


SCORED = ("row long, n_tokens long, known long, logs double, score double, keys array<long>, times array<long>, "
          "doc_id long, held_out boolean")


def _scored(
    model: Model, rows: list, texts: list[bytes], carried: list, told: Callable[[np.ndarray], np.ndarray]
) -> pa.RecordBatch:
    """Scores of a portion of texts. ``told``: what the filter says of keys, wherever it is."""
    sets = token_keys(texts)
    d = Distinct.of(np.concatenate(sets), model.frequent)
    n_tokens = np.array([len(s) for s in sets])
    start = np.cumsum(n_tokens) - n_tokens
    # Each text begins after an end token, so one pass serves all texts of the portion.
    scores = np.add.reduceat(model.log_probabilities(*model.filter_counts(d, told(d.asked()))), start)
    logs, found = np.zeros(len(d.words)), d.known[d.at_word]
    logs[d.known] = np.log10(model.frequent_counts[d.spot] + 0.5)
    # Other words of each text with their occurrences.
    other = np.flatnonzero(~found)
    text_of = np.repeat(np.arange(len(sets)), n_tokens)
    pair, times = np.unique(text_of[other] * len(d.words) + d.at_word[other], return_counts=True)
    ends = pa.array(np.searchsorted(pair, np.arange(len(sets) + 1) * len(d.words)).astype(np.int32))
    return pa.RecordBatch.from_arrays([
        pa.array(rows, pa.int64()), pa.array(n_tokens), pa.array(np.add.reduceat(found.astype(np.int64), start)),
        pa.array(np.add.reduceat(logs[d.at_word], start)), pa.array(scores),
        pa.ListArray.from_arrays(ends, pa.array(d.words[pair % len(d.words)].view(np.int64))),
        pa.ListArray.from_arrays(ends, pa.array(times)), *carried],
        ["row", "n_tokens", "known", "logs", "score", "keys", "times", "doc_id", "held_out"])


def _looked_up(wanted: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, counts[at], 0.0)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        for batch in batches:
            at_row = 0
            for rows, texts in portions(batch):
                carried = [batch.column(k).slice(at_row, len(rows)) for k in (2, 3)]
                at_row += len(rows)
                yield _scored(
                    model, rows, texts, carried, lambda keys: told_levels(model.bits, keys, model.segments))
    return run


def _in_portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row with the number of the first row of its portion."""
    for batch in batches:
        portion = [rows[0] for rows, _ in portions(batch) for _ in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array(portion, pa.int64()), *batch.columns], ["portion", *batch.schema.names])


def _score_portion(shared, part_segments: int):
    def run(own: pa.Table, answers: pa.Table) -> pa.Table:
        model = Model(**shared.value)
        texts = [t or b"" for t in own["text"].cast(pa.binary()).to_pylist()]
        answer = dict(zip(answers["part"].to_pylist(), answers["levels"].to_pylist()))

        def told(keys: np.ndarray) -> np.ndarray:
            order, parts, _ = by_part(part_of(keys, model.segments, part_segments))
            level = np.empty(len(keys), np.uint8)
            level[order] = np.frombuffer(b"".join([answer[p] for p in parts.tolist()]), np.uint8)
            return level

        carried = [own[c].combine_chunks() for c in ("doc_id", "held_out")]
        return pa.Table.from_batches([_scored(model, own["row"].to_pylist(), texts, carried, told)])
    return run


def _scored_by_parts(rows: DataFrame, items: DataFrame, model: Model, scratch: Scratch) -> DataFrame:
    """Scores from a filter that stays in parts: texts ask in portions, and each portion meets its answers."""
    spark = rows.sparkSession
    texts = scratch.write(rows.mapInArrow(
        _in_portions, "portion long, row long, text string, doc_id long, held_out boolean"), large=True)
    part_segments = min(PART_SEGMENTS, model.segments)
    answers = reduce(DataFrame.unionByName, [
        scratch.write(answered(items, texts, model.segments, part_segments, turn, ROUNDS, model.frequent), large=True)
        for turn in range(ROUNDS)])
    known = {r["part"]: r["levels"] for r in answers.where(F.col("portion") == FREQUENT).collect()}
    parts, lists = in_parts(
        np.concatenate([model.frequent, mass_keys(model.frequent)]), model.segments, part_segments)
    if known:
        keys = np.concatenate(lists)
        counts = counts_of(np.frombuffer(b"".join([known[p] for p in parts.tolist()]), np.uint8).astype(np.int64))
        order = np.argsort(keys, kind="stable")
        looked = {"keys": keys[order], "counts": counts[order]}
        model.frequent_levels = _looked_up(model.frequent, **looked)
        model.frequent_mass = _looked_up(mass_keys(model.frequent), **looked)
    shared = spark.sparkContext.broadcast(vars(model))
    return texts.groupBy("portion").cogroup(
        answers.where(F.col("portion") != FREQUENT).groupBy("portion")).applyInArrow(
        _score_portion(shared, part_segments), SCORED)


def score(docs: DataFrame) -> DataFrame:
    """One row per document: held_out, n_tokens, n_known, train_tokens, base_score, score.

    Documents whose crc32 of doc_id (as text) leaves 1 modulo 5 are held out of training; a null id counts as
    empty text. Null text is empty and has its end token only. Repeated rows are texts of their own. An empty
    table, or one without training texts, gives counts of 0 and finite scores.
    """
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "lm")
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "text", F.col("doc_id").cast("long").alias("doc_id"),
        held.alias("held_out"))
    model, words, items = train(docs.where(~held), scratch)
    if model.bits is None:
        scored = scratch.write(_scored_by_parts(rows, items, model, scratch), large=True)
    else:
        scored = scratch.write(rows.mapInArrow(_score(spark.sparkContext.broadcast(vars(model))), SCORED))
    rare = scored.select("row", F.explode(F.arrays_zip("keys", "times")).alias("t")).select(
        "row", F.col("t.keys").alias("key"), F.col("t.times").alias("times"))
    extra = rare.join(words, "key", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("more_logs"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"))
    divisor = float(np.log10(model.n_tokens + 0.5 * (model.n_distinct + 1)))
    return (
        scored.drop("keys", "times").join(extra, "row", "left")
        .select(
            "doc_id", "held_out", "n_tokens",
            (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
            F.lit(model.n_tokens).cast("long").alias("train_tokens"),
            (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(divisor))
            .alias("base_score"),
            "score"))
