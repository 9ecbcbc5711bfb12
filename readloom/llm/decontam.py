"""Benchmark decontamination: BM25 over test items, searched with block-max WAND by every passage.

The test items are the indexed side, the corpus asks: each passage of each document is a query, and every
item that scores above the threshold is retrieved. Scores are parts of what the item scores with itself,
so one threshold serves short and long items. What is retrieved counts as a leak when the passage also
holds enough word n-grams of the item's question and of its answer. The n-grams of a short part are shorter,
so that one changed word never takes away more than the rule allows.

Document frequencies and the mean length are those of all items, and passages follow the length class of an
item, so scores do not depend on the block an item is in. The index of one block of items (at most BLOCK_BYTES
of item text) is built once and broadcast; more blocks mean more scans of the corpus. Documents are never
shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.common import Scratch, small_batches
from readloom.llm.recompression import mix, word_layout, word_names
from readloom.llm.repeats import Units, portions

BLOCK_BYTES = 16 << 20
POSTING_BLOCK = 64
# Ranges of items, coarse and fine, for which the greatest weight of every term is kept; cells of a table at most.
RANGES = (16, 256)
RANGE_CELLS = 1 << 23
K1, B = 1.2, 0.75

# All ASCII but letters and digits parts words.
PLAIN = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
SENTENCE_END = regex.compile(r"(?<=[.!?])\s+|(?<=[。！？])\s*(?=[^\s。！？\p{Pe}\p{Pf}])")
# Beyond ASCII: punctuation and separators part words; in scripts without blanks each character is one.
OTHER = regex.compile(
    r"[\p{P}\p{Z}]+|([\p{Han}\p{Hiragana}\p{Katakana}ー\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])")


@dataclass(frozen=True)
class LeakRule:
    """Share of the item's own BM25 score, and of the n-grams of question and answer, that make a leak."""

    score: float = 0.6
    overlap: float = 0.6
    ngram: int = 4
    # Of shorter items a part says too little, so they are matched letter by letter.
    min_item_words: int = 4
    # Items up to this length share an index; each further one is for items up to twice as long.
    shortest_class: int = 64


def parted(text: str) -> str:
    """The text with blanks where words part beyond ASCII."""
    return text if text.isascii() else OTHER.sub(r" \1 ", text)


def layout(texts: list[str]) -> tuple[Units, np.ndarray]:
    """Words of lower-cased texts without punctuation, and their fingerprints."""
    units = word_layout([parted(t.lower()).encode("utf-8", "replace").translate(PLAIN) for t in texts])
    return units, word_names(units)


def part_ngram(n_words: int, rule: LeakRule) -> int:
    """The longest n-grams, up to the rule's, of which a part still has its share when one word changes."""
    return max(1, min(rule.ngram, int((1 - rule.overlap) * (n_words + 1) / (2 - rule.overlap) + 1e-9)))


def grams_in_order(names: np.ndarray, n: int) -> np.ndarray:
    out = np.full(max(len(names) - n + 1, 0), n, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(31) + names[k:k + len(out)])
    return out


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence answers what the others ask; a single sentence is cut in halves."""
    sentences = [s for s in SENTENCE_END.split(text.strip()) if s]
    if len(sentences) > 1:
        return " ".join(sentences[:-1]), sentences[-1]
    words = parted(text).split()
    return " ".join(words[:len(words) // 2]), " ".join(words[len(words) // 2:])


@dataclass
class Statistics:
    """Of all items: their number, their mean length, and in how many a word is (words in order)."""

    n_items: int
    mean_length: float
    words: np.ndarray
    counts: np.ndarray

    @staticmethod
    def of(sets: list[np.ndarray]) -> "Statistics":
        own = [np.unique(s) for s in sets]
        words, counts = np.unique(np.concatenate(own) if own else np.zeros(0, np.uint64), return_counts=True)
        return Statistics(len(sets), float(np.mean([len(s) for s in sets] or [1])), words, counts)

    def df(self, words: np.ndarray) -> np.ndarray:
        return self.counts[np.searchsorted(self.words, words)]


class Index:
    """Postings of the items of one length class, with the greatest weight of each block of postings."""

    def __init__(
        self, items: list[tuple[int, str]], sets: list[np.ndarray], rule: LeakRule, statistics: Statistics, longest: int
    ):
        self.ids = [i for i, _ in items]
        self.rule = rule
        # Length of the items of the class at most.
        self.longest = longest
        self.parts = []
        for _, text in items:
            units, names = layout(list(question_and_answer(text)))
            self.parts.append([names[a:b] for a, b in zip(units.first, units.last)])
        entry = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        self.terms, term = np.unique(np.concatenate(sets), return_inverse=True)
        pair, tf = np.unique(term.astype(np.int64) * len(sets) + entry, return_counts=True)
        term, self.entry = pair // len(sets), pair % len(sets)
        self.bounds = np.searchsorted(term, np.arange(len(self.terms) + 1))
        df = statistics.df(self.terms)[term]
        length = np.array([len(s) for s in sets])
        weight = np.log1p((statistics.n_items - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (
            tf + K1 * (1 - B + B * length[self.entry] / statistics.mean_length))
        # Divided by what the item scores with itself.
        self.weight = weight / np.bincount(self.entry, weight, len(sets))[self.entry]
        self.most = np.maximum.reduceat(self.weight, self.bounds[:-1])
        self.range_most = []
        for wanted in RANGES:
            ranges = max(1, min(wanted, len(sets), RANGE_CELLS // len(self.terms)))
            most = np.zeros((len(self.terms), ranges), np.float32)
            np.maximum.at(most, (term, self.entry * ranges // len(sets)), self.weight * (1 + 1e-6))
            self.range_most.append(most)
        self.blocks = [
            [(int(self.entry[min(k + POSTING_BLOCK, b) - 1]), float(self.weight[k:k + POSTING_BLOCK][:b - k].max()))
             for k in range(a, b, POSTING_BLOCK)]
            for a, b in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist())]

    def search(self, terms: list[int]) -> list[tuple[int, float]]:
        """All entries that score the threshold or more for a query of distinct terms."""
        need = self.rule.score - 1e-9
        # A cursor: entry it stands at, term, place in the postings.
        cursors = sorted((int(self.entry[self.bounds[t]]), t, int(self.bounds[t])) for t in terms)
        found = []
        while cursors:
            bound, pivot = 0.0, -1
            for k, (_, t, _) in enumerate(cursors):
                bound += self.most[t]
                if bound >= need:
                    pivot = k
                    break
            if pivot < 0:
                break
            target = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == target:
                pivot += 1
            # The blocks that hold the target say whether it can reach the threshold at all.
            bound, block_end = 0.0, None
            for _, t, _ in cursors[:pivot + 1]:
                last, most = next((x for x in self.blocks[t] if x[0] >= target), (None, 0.0))
                bound += most
                if last is not None:
                    block_end = last if block_end is None else min(block_end, last)
            if bound >= need:
                if cursors[0][0] == target:
                    score = float(sum(self.weight[p] for e, _, p in cursors[:pivot + 1] if e == target))
                    if score >= need:
                        found.append((target, score))
                    goal = target + 1
                else:
                    goal = target
            else:
                goal = block_end + 1 if block_end is not None else target + 1
                if pivot + 1 < len(cursors):
                    goal = min(goal, cursors[pivot + 1][0])
                goal = max(goal, target + 1)
            moved = []
            for e, t, p in cursors:
                if e < goal:
                    end = int(self.bounds[t + 1])
                    p += int(np.searchsorted(self.entry[p:end], goal))
                    if p == end:
                        continue
                    e = int(self.entry[p])
                moved.append((e, t, p))
            cursors = sorted(moved)
        return found

    def passages(self, n_words: int) -> list[tuple[int, int]]:
        """Passages of twice the length of an item of the class, each starting half-way through the one before."""
        step = self.longest
        return [(a, min(a + 2 * step, n_words)) for a in range(0, max(n_words - step, 1), step)]

    def leaks(self, units: Units, names: np.ndarray) -> dict[int, dict[int, tuple]]:
        """Per document (number in the portion), per item: score, overlap of question and of answer."""
        at = np.searchsorted(self.terms, names)
        at[at == len(self.terms)] = 0
        known = np.flatnonzero(self.terms[at] == names)
        spans, doc = [], []
        for k, (first, last) in enumerate(zip(units.first.tolist(), units.last.tolist())):
            own = self.passages(last - first) if last > first else []
            spans += [(first + a, first + b) for a, b in own]
            doc += [k] * len(own)
        if not spans or not len(known):
            return {}
        span = np.array(spans)
        a, b = np.searchsorted(known, span[:, 0]), np.searchsorted(known, span[:, 1])
        count = b - a
        passage = np.repeat(np.arange(len(span)), count)
        inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + a[passage]
        pair = np.unique(passage * np.int64(len(self.terms)) + at[known[inside]])
        passage, term = pair // len(self.terms), pair % len(self.terms)
        result: dict[int, dict[int, tuple]] = {}
        for p, lo, hi in self._hopeful(passage, term):
            hits = self.search(term[lo:hi].tolist())
            if not hits:
                continue
            words = names[span[p, 0]:span[p, 1]]
            for entry, score in hits:
                question, answer = (self._share(part, words) for part in self.parts[entry])
                if self._leaked(self.parts[entry], (question, answer)):
                    items = result.setdefault(doc[p], {})
                    before = items.get(self.ids[entry])
                    if before is None or (score, question, answer) > before:
                        items[self.ids[entry]] = (score, question, answer)
        return result

    def _hopeful(self, passage: np.ndarray, term: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Passages that may reach the threshold in some range of items, with the place of their terms."""
        head = np.flatnonzero(np.diff(passage, prepend=-1))
        tail = np.append(head[1:], len(passage))
        need = np.float32(self.rule.score - 1e-3)
        for most in self.range_most:
            hopeful = []
            for k in range(0, len(head), 512):
                count = tail[k:k + 512] - head[k:k + 512]
                first = np.cumsum(count) - count
                place = np.arange(count.sum()) - np.repeat(first - head[k:k + 512], count)
                bound = np.add.reduceat(most[term[place]], first, axis=0).max(axis=1)
                hopeful.append(k + np.flatnonzero(bound >= need))
            kept = np.concatenate(hopeful) if hopeful else np.zeros(0, np.int64)
            head, tail = head[kept], tail[kept]
        yield from zip(passage[head].tolist(), head.tolist(), tail.tolist())

    def _share(self, part: np.ndarray, words: np.ndarray) -> float:
        """Part of the n-grams of ``part`` that the words have; 1 if it has none.

        Shorter n-grams than the rule's could be met anywhere, so they have to lie together, in as many words
        as the part has and one more.
        """
        if not len(part):
            return 1.0
        n = part_ngram(len(part), self.rule)
        own, held = grams_in_order(part, n), grams_in_order(words, n)
        if not len(held):
            return 0.0
        if n == self.rule.ngram:
            return float(np.isin(own, held).mean())
        seen = np.cumsum(own[:, None] == held, axis=1)
        width = len(own) + 1
        if width < len(held):
            seen = np.column_stack([seen[:, width - 1], seen[:, width:] - seen[:, :-width]])
        else:
            seen = seen[:, -1:]
        return float((seen > 0).mean(axis=0).max())

    def _leaked(self, parts: list[np.ndarray], shares: tuple[float, float]) -> bool:
        """Both parts have their share, or one word of one or two has changed and the other part is whole."""
        if min(shares) >= self.rule.overlap - 1e-9:
            return True
        return any(
            len(parts[k]) <= 2 and shares[k] >= (len(parts[k]) - 1) / len(parts[k]) and shares[1 - k] == 1
            and len(parts[1 - k]) > 2 for k in (0, 1) if len(parts[k]))


class ShortItems:
    """Items of few words: leaked where a text holds them whole, but for case and runs of blanks."""

    def __init__(self, items: list[tuple[int, str]], rule: LeakRule):
        units, names = layout([t for _, t in items])
        # Items by length and by fingerprint of all their words.
        self.items: dict[int, dict[int, list[tuple[int, str]]]] = {}
        for item, a, b in zip(items, units.first.tolist(), units.last.tolist()):
            if 0 < b - a < rule.min_item_words:
                (name,) = grams_in_order(names[a:b], b - a).tolist()
                self.items.setdefault(b - a, {}).setdefault(name, []).append((item[0], folded(item[1])))
        self.names = {n: np.array(sorted(own), np.uint64) for n, own in self.items.items()}

    def leaks(self, units: Units, names: np.ndarray, texts: list[str]) -> dict[int, dict[int, tuple]]:
        """As ``Index.leaks``, with full scores."""
        result: dict[int, dict[int, tuple]] = {}
        for n, own in self.items.items():
            held = grams_in_order(names, n)
            place = np.flatnonzero(np.isin(held, self.names[n]))
            doc = np.searchsorted(units.first, place, "right") - 1
            inside = (doc >= 0) & (place + n <= units.last[doc])
            found: dict[int, set[int]] = {}
            for k, name in zip(doc[inside].tolist(), held[place[inside]].tolist()):
                found.setdefault(k, set()).add(name)
            for k, met in found.items():
                text = folded(texts[k])
                for name in met:
                    for item, wanted in own[name]:
                        if stands_in(wanted, text):
                            result.setdefault(k, {})[item] = (1.0, 1.0, 1.0)
        return result


def folded(text: str) -> str:
    return " ".join(text.lower().split())


def stands_in(wanted: str, text: str) -> bool:
    """Whether the text holds these characters without a cut through a word of a script with blanks."""
    def joins(a: str, b: str) -> bool:
        return a.isalnum() and b.isalnum() and not OTHER.match(a) and not OTHER.match(b)

    at = text.find(wanted)
    while at >= 0:
        end = at + len(wanted)
        if not (at and joins(text[at - 1], wanted[0])) and not (end < len(text) and joins(wanted[-1], text[end])):
            return True
        at = text.find(wanted, at + 1)
    return False


def word_sets(texts: list[str]) -> list[np.ndarray]:
    units, names = layout(texts)
    return [names[a:b] for a, b in zip(units.first, units.last)]


def indexes(
    items: list[tuple[int, str]], rule: LeakRule, statistics: Statistics | None = None
) -> list[Index]:
    """One index per class of length; without ``statistics`` the items are all there are."""
    sets = word_sets([t for _, t in items])
    statistics = statistics or Statistics.of([s for s in sets if len(s) >= rule.min_item_words])
    classes: dict[int, list[int]] = {}
    for k, s in enumerate(sets):
        if len(s) >= rule.min_item_words:
            size = rule.shortest_class
            while size < len(s):
                size *= 2
            classes.setdefault(size, []).append(k)
    return [
        Index([items[k] for k in own], [sets[k] for k in own], rule, statistics, size)
        for size, own in sorted(classes.items())]


def _item_words(rule: LeakRule):
    """Of each item the number of its words and its distinct words, if it is indexed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = word_sets(batch.column(1).to_pylist())
            kept = [len(s) >= rule.min_item_words for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(s) if k else 0 for s, k in zip(sets, kept)], pa.int64()),
                 pa.array([np.unique(s).view(np.int64) if k else [] for s, k in zip(sets, kept)], pa.list_(pa.int64()))],
                ["item_id", "text", "n", "words"])
    return run


def item_blocks(
    items: DataFrame, rule: LeakRule, block_bytes: int = BLOCK_BYTES
) -> Iterator[tuple[list[tuple[int, str]], Statistics]]:
    """The distinct items with text in order, in lists of bounded size with the statistics their words need.

    Statistics are counted over all items by Spark; a block gets those of its own words.
    """
    scratch = Scratch(items.sparkSession, "decontam")
    counted = scratch.write(
        items.select(F.col("item_id").cast("long"), "text").where("text is not null").distinct()
        .mapInArrow(_item_words(rule), "item_id long, text string, n long, words array<long>")
        .withColumn("item", F.monotonically_increasing_id()))
    totals = counted.where("n > 0").agg(F.count("*").alias("n"), F.avg("n").alias("mean")).first()
    listed = counted.select("item", F.explode("words").alias("word"))
    # Written, so that the join has an exchange on both sides and a common word may be split.
    counts = scratch.write(listed.groupBy("word").agg(F.count("*").alias("df")))
    own = listed.join(counts, "word").groupBy("item").agg(F.collect_list(F.struct("word", "df")).alias("dfs"))
    rows = counted.select("item", "item_id", "text").join(own, "item", "left").orderBy("item_id", "text")
    block, held, dfs = [], 0, {}

    def done() -> tuple[list[tuple[int, str]], Statistics]:
        words = np.array(list(dfs), np.int64).view(np.uint64)
        order = np.argsort(words)
        return block, Statistics(
            totals["n"], float(totals["mean"] or 1), words[order], np.array(list(dfs.values()), np.int64)[order])

    for row in rows.toLocalIterator():
        if block and held + len(row["text"]) > block_bytes:
            yield done()
            block, held, dfs = [], 0, {}
        block.append((row["item_id"], row["text"]))
        held += len(row["text"])
        dfs.update((x["word"], x["df"]) for x in row["dfs"] or [])
    if block:
        yield done()


def _shared(spark: SparkSession, block: list[tuple[int, str]], statistics: Statistics, rule: LeakRule):
    """The indexes of a block, built here once, for all tasks."""
    return spark.sparkContext.broadcast((indexes(block, rule, statistics), ShortItems(block, rule)))


def _found(shared, rows: list, texts: list[bytes]) -> list[dict[int, tuple]]:
    """Leaks of each text, all indexes together."""
    own, short = shared.value
    decoded = [t.decode("utf-8", "replace") for t in texts]
    units, names = layout(decoded)
    leaks: list[dict[int, tuple]] = [{} for _ in rows]
    for index in own:
        for k, items in index.leaks(units, names).items():
            leaks[k] |= items
    for k, items in short.leaks(units, names, decoded).items():
        leaks[k] = items | leaks[k]
    return leaks


def leaks(
    docs: DataFrame, items: DataFrame, rule: LeakRule = LeakRule(), block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per document row and leaked item: doc_id, item_id, score, question_overlap, answer_overlap.

    Null texts hold nothing, null items and items without a word are none; equal items count once. Items of
    fewer words than ``min_item_words`` leak where a text holds them letter by letter. In scripts without
    blanks each character counts as a word. A document without leaks has no
    row; repeated documents have their rows each. Of several passages the best score counts. Empty tables
    give an empty table.
    """
    spark = docs.sparkSession
    small_batches(spark)
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    result = spark.createDataFrame([], schema)
    for block, statistics in item_blocks(items, rule, block_bytes):
        shared = _shared(spark, block, statistics, rule)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for rows, texts in portions(batch):
                    found = [
                        (doc_id, item, *values)
                        for doc_id, own in zip(rows, _found(shared, rows, texts))
                        for item, values in sorted(own.items(), key=lambda x: (x[0] is None, x[0]))]
                    columns = list(zip(*found)) if found else [[]] * 5
                    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, kind) for c, kind in zip(columns, kinds)],
                        ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])
        result = result.unionByName(texts.mapInArrow(run, schema))
    return result


def without_leaks(docs: DataFrame, items: DataFrame, rule: LeakRule = LeakRule()) -> DataFrame:
    """The documents in which no item leaked; same columns as ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    for block, statistics in item_blocks(items, rule):
        shared = _shared(spark, block, statistics, rule)
        place = docs.columns.index("text")

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = pa.RecordBatch.from_arrays(
                    [pa.array(range(batch.num_rows), pa.int64()), batch.column(place)], ["row", "text"])
                clean = []
                for rows, texts in portions(own):
                    clean += [r for r, hit in zip(rows, _found(shared, rows, texts)) if not hit]
                yield batch.take(pa.array(clean, pa.int64()))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
