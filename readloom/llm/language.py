"""Language identification by piece probabilities, summed over all ways to segment a word.

The pieces are those of a fixed public vocabulary, single bytes among them, so every word can be segmented.
A language gives each piece a probability; a word's probability is the sum over all its segmentations, which
the forward algorithm takes place by place, for many words of one length and all languages at once. A text is its
words; its score is the sum of their logarithms and of the language's share of the training texts.

The probabilities come from expectation maximisation over the exact word counts of all training texts: words
are counted per language in one shuffle, and each round is a pass over the distinct words, whose expected
piece counts are summed per task before they move.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import Scratch, small_batches
from readloom.llm.tokens import byte_table

# Longer pieces of the vocabulary are left out; single bytes always stay. So many bytes fit one number.
MAX_PIECE = 8
# Longer runs of letters are cut into words of so many code points.
MAX_WORD = 48
ROUNDS = 3
# Added to the expected count of every piece.
SMOOTHING = 0.1
UNKNOWN = "und"
# Code points that are taken apart at a time, and distinct words held by a task.
SLICE = 1 << 20
HELD_WORDS = 1 << 18
# Cells (words x places x lengths) of one pass.
CELLS = 1 << 19

RUN = re.compile(r"[^\W\d_]+")
NO_RUN = re.compile(r"[\W\d_]")
# Runs of a text in ASCII are what this leaves between blanks.
LETTERS = byte_table([*range(0x41, 0x5B), *range(0x61, 0x7B)])


def vocabulary_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def pieces_of(path: str, longest: int = MAX_PIECE) -> list[bytes]:
    """The byte strings of a rank file up to ``longest`` bytes, and all single bytes."""
    with open(path, "rb") as file:
        known = [base64.b64decode(line.split()[0]) for line in file if line.strip()]
    return sorted({p for p in known if 0 < len(p) <= longest} | {bytes([b]) for b in range(256)})


def words_of(text: str) -> Iterator[list[str]]:
    """The lower-cased runs of letters of a whole text, in lists of bounded size; long runs come in parts."""
    start = 0
    while start < len(text):
        end = len(text)
        if end - start > SLICE:
            cut = NO_RUN.search(text, start + SLICE)
            end = cut.start() if cut else end
        part = text[start:end]
        if part.isascii():
            runs = part.encode().translate(LETTERS).decode().split()
        else:
            runs = RUN.findall(part.lower())
        if max(map(len, runs), default=0) > MAX_WORD:
            runs = [r[k:k + MAX_WORD] for r in runs for k in range(0, len(r), MAX_WORD)]
        # Number signs that are no decimal digits match as well; most texts have none.
        yield runs if "".join(runs).isalpha() else [r for r in runs if any(map(str.isalpha, r))]
        start = end


def word_counts(text: str) -> Counter:
    counts: Counter = Counter()
    for found in words_of(text):
        counts.update(found)
    return counts


class Pieces:
    """The vocabulary by length, as sorted packed numbers, so that all places of many words are looked up at once.

    The beginnings of longer pieces are kept beside the pieces: a place where nothing begins with its first
    bytes is not looked up with more of them.
    """

    def __init__(self, pieces: list[bytes]):
        self.n = len(pieces)
        self.longest = max(map(len, pieces))
        if self.longest > MAX_PIECE:
            raise ValueError(f"pieces may have {MAX_PIECE} bytes")
        number = {p: k for k, p in enumerate(pieces)}
        self.by_length = {}
        for length in range(1, self.longest + 1):
            goes_on = {p[:length] for p in pieces if len(p) > length}
            starts = sorted(goes_on | {p for p in pieces if len(p) == length}, key=lambda p: p[::-1])
            self.by_length[length] = (
                np.array([int.from_bytes(p, "little") for p in starts], np.uint64),
                np.array([number.get(p, self.n) for p in starts], np.int64),
                np.array([p in goes_on for p in starts], bool))

    def lattice(self, raw: np.ndarray) -> np.ndarray:
        """Words of one length as rows of bytes to words x places x lengths: the piece there, or ``n``.

        In memory, the words of a place and length lie side by side.
        """
        m, n = raw.shape
        ahead = np.zeros((n, m), np.uint64)
        for k in range(min(self.longest, n)):
            ahead[:n - k] |= raw.T[k:].astype(np.uint64) << np.uint64(8 * k)
        ahead = ahead.reshape(-1)
        found = np.full((min(self.longest, n), n * m), self.n, np.int64)
        left = np.arange(n * m)
        for length in range(1, len(found) + 1):
            starts, numbers, goes_on = self.by_length[length]
            left = left[:np.searchsorted(left, (n - length + 1) * m)]
            if not len(starts) or not len(left):
                break
            keys = ahead[left] & np.uint64((1 << (8 * length)) - 1)
            at = np.minimum(np.searchsorted(starts, keys), len(starts) - 1)
            hit = starts[at] == keys
            left, at = left[hit], at[hit]
            found[length - 1, left] = numbers[at]
            left = left[goes_on[at]]
        return found.reshape(-1, n, m).transpose(2, 1, 0)


def forward(lattice: np.ndarray, edge: Callable[[np.ndarray], np.ndarray], logs: bool) -> list[np.ndarray]:
    """For each place, the sum over all segmentations up to it: arrays of words x languages.

    ``edge`` gives the probabilities of pieces, or their logarithms.
    """
    m, n, longest = lattice.shape
    start = edge(lattice[:, 0, 0])
    table = [np.zeros_like(start) if logs else np.ones_like(start)]
    for place in range(1, n + 1):
        total = None
        for length in range(1, min(longest, place) + 1):
            value = edge(lattice[:, place - length, length - 1])
            before = table[place - length]
            if logs:
                value = value + before
                total = value if total is None else np.logaddexp(total, value)
            else:
                value = value * before
                total = value if total is None else total + value
        table.append(total)
    return table


def backward(lattice: np.ndarray, edge: Callable[[np.ndarray], np.ndarray], logs: bool) -> list[np.ndarray]:
    """For each place, the sum over all segmentations from it to the end."""
    m, n, longest = lattice.shape
    start = edge(lattice[:, 0, 0])
    table = [None] * n + [np.zeros_like(start) if logs else np.ones_like(start)]
    for place in range(n - 1, -1, -1):
        total = None
        for length in range(1, min(longest, n - place) + 1):
            value = edge(lattice[:, place, length - 1])
            after = table[place + length]
            if logs:
                value = value + after
                total = value if total is None else np.logaddexp(total, value)
            else:
                value = value * after
                total = value if total is None else total + value
        table[place] = total
    return table


def same_length(words: list[str], cells: int = CELLS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of words, and their bytes behind a blank as rows, in groups of one length and bounded size."""
    raw = [b" " + w.encode("utf-8", "surrogatepass") for w in words]
    lengths = np.array([len(w) for w in raw], np.int64)
    for n in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == n)
        step = max(1, cells // (n * MAX_PIECE))
        for at in range(0, len(own), step):
            part = own[at:at + step]
            yield part, np.frombuffer(b"".join([raw[k] for k in part]), np.uint8).reshape(len(part), n)


@dataclass
class Model:
    """Piece numbers, log probabilities (pieces x languages), languages and the logarithms of their shares."""

    pieces: list[bytes]
    logs: np.ndarray
    languages: list[str]
    shares: np.ndarray

    def __post_init__(self):
        self.lookup = Pieces(self.pieces)
        none = np.full((1, len(self.languages)), -np.inf)
        self.edge_logs = np.concatenate((self.logs, none))
        self.edge = np.exp(self.edge_logs)
        # Products over so many bytes stay far from the smallest double; longer words go by logarithms.
        least = float(-self.logs.min()) if self.logs.size else 1.0
        self.safe = int(600 / max(least, 1e-9))

    def word_logs(self, words: list[str]) -> np.ndarray:
        """Logarithm of each word's probability, summed over its segmentations: words x languages."""
        found = np.zeros((len(words), len(self.languages)))
        for part, raw in same_length(words):
            logs = raw.shape[1] > self.safe
            edges = self.edge_logs if logs else self.edge
            total = forward(self.lookup.lattice(raw), lambda pieces, e=edges: e[pieces], logs)[-1]
            found[part] = total if logs else np.log(total)
        return found

    def expected(self, words: list[str], lang: np.ndarray, times: np.ndarray, into: np.ndarray) -> None:
        """Add the pieces that words of these languages hold on average over their segmentations.

        ``into`` has a row a piece, one more for none, and a column a language.
        """
        width = len(self.languages)
        flat = into.reshape(-1)
        for part, raw in same_length(words):
            own, logs = lang[part], raw.shape[1] > self.safe
            edges = (self.edge_logs if logs else self.edge).reshape(-1)
            lattice = self.lookup.lattice(raw)
            # Looked up once; both passes take the values as they are.
            values = edges[lattice * width + own[:, None, None]]
            before, after = forward(values, _as_is, logs), backward(values, _as_is, logs)
            whole, n_times = before[-1], times[part]
            n, longest = lattice.shape[1:]
            cells, shares = [], []
            for place in range(n):
                for length in range(1, min(longest, n - place) + 1):
                    pieces = lattice[:, place, length - 1]
                    here = np.flatnonzero(pieces < self.lookup.n)
                    value, a, b = values[here, place, length - 1], before[place][here], after[place + length][here]
                    share = np.exp(a + value + b - whole[here]) if logs else a * value * b / whole[here]
                    cells.append(pieces[here] * width + own[here])
                    shares.append(share * n_times[here])
            # One sum for all places, as it passes over the whole table.
            flat += np.bincount(np.concatenate(cells), np.concatenate(shares), len(flat))


def _as_is(values: np.ndarray) -> np.ndarray:
    return values


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words per language with their occurrences, from rows of lang, text."""
    held: dict[str, Counter] = {}

    def table() -> pa.RecordBatch:
        rows = [(lang, w, n) for lang, words in held.items() for w, n in words.items()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64()))],
            ["lang", "word", "n"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = held.setdefault(lang, Counter())
            for found in words_of(text.as_py() or ""):
                own.update(found)
            if sum(map(len, held.values())) >= HELD_WORDS:
                yield table()
                held = {}
    if held:
        yield table()


def _expected(shared) -> Callable:
    """Expected piece counts per language of rows (lang number, word, n), summed over the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        total = np.zeros(model.edge.shape)
        for batch in batches:
            model.expected(
                batch.column(1).to_pylist(), batch.column(0).to_numpy(), batch.column(2).to_numpy(), total)
        piece, lang = np.nonzero(total[:-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(piece), pa.array(lang), pa.array(total[piece, lang])], ["piece", "lang", "n"])
    return run


def train(texts: DataFrame, scratch: Scratch, path: str | None = None, rounds: int = ROUNDS) -> Model:
    """The model of the rows (lang, text) whose lang is not null.

    The driver and each worker hold one number a piece and language.
    """
    spark = texts.sparkSession
    labelled = texts.where("lang is not null").select("lang", "text")
    share = labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").collect()
    languages = [r["lang"] for r in share]
    n_texts = np.array([r["n"] for r in share], float)
    pieces = pieces_of(path or vocabulary_file())
    logs = np.full((len(pieces), len(languages)), -np.log(len(pieces)))
    shares = np.log(n_texts / max(n_texts.sum(), 1))
    model = Model(pieces, logs, languages, shares)
    if not languages:
        return model
    # Languages in order, as numbers: the driver holds the list anyway.
    number = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("lang")) - 1
    words = scratch.write(
        labelled.mapInArrow(_counted, "lang string, word string, n long")
        .groupBy("lang", "word").agg(F.sum("n").alias("n")).select(number.alias("lang"), "word", "n"))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(
            {"pieces": pieces, "logs": model.logs, "languages": languages, "shares": shares})
        summed = words.mapInArrow(_expected(shared), "piece long, lang long, n double").groupBy(
            "piece", "lang").agg(F.sum("n").alias("n")).toArrow()
        counts = np.full(logs.shape, SMOOTHING)
        counts[summed["piece"].to_numpy(), summed["lang"].to_numpy()] += summed["n"].to_numpy()
        model.logs = np.log(counts / counts.sum(axis=0))
    return model


class Numbers(dict):
    """Words in the order in which they were first asked for, with their numbers."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def _predicted(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        known = Numbers()
        logs = np.zeros((0, len(model.languages)))
        for batch in batches:
            if len(known) >= HELD_WORDS:
                known, logs = Numbers(), logs[:0]
            places, times = [], []
            for text in batch.column(2):
                own = word_counts(text.as_py() or "")
                places.append(np.fromiter(map(known.__getitem__, own), np.int64, len(own)))
                times.append(np.fromiter(own.values(), float, len(own)))
            logs = np.concatenate((logs, model.word_logs(list(islice(known, len(logs), None)))))
            languages, scores = [], []
            for at, n in zip(places, times):
                if not len(at) or not model.languages:
                    languages.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                total = n @ logs[at] + model.shares
                best = int(total.argmax())
                languages.append(model.languages[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(languages, pa.string()),
                 pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])
    return run


def predict(rows: DataFrame, model: Model) -> DataFrame:
    """``lang_pred`` and ``score`` (its probability among the model's languages) for doc_id, held_out, text."""
    shared = rows.sparkSession.sparkContext.broadcast({
        "pieces": model.pieces, "logs": model.logs, "languages": model.languages, "shares": model.shares})
    return rows.select("doc_id", "held_out", "text").mapInArrow(
        _predicted(shared), "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, path: str | None = None, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Documents whose crc32 of doc_id (as text) leaves 1 modulo 3 are held out of training, as are those
    without lang; a null id counts as empty text. A null text, or one without a letter, is ``und`` with
    score 0, as is every text if nothing could be learned. Ties go to the first language in order. Repeated
    rows are rows of their own. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    small_batches(spark)
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text")
    model = train(docs.where(~held).select("lang", "text"), Scratch(spark, "language"), path, rounds)
    return predict(rows, model)
