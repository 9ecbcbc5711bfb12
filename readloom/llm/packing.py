"""Best-two-fit packing of tokenised documents into sequences of a fixed length.

Tokenising runs once, in parallel, into a narrow stage table. Packing needs lengths only: pieces are
dealt at random into groups of bounded size, one task packs a group, so no task grows with the corpus.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import Scratch, small_batches

SEQUENCE = 2048
END_ID = 0
# Pieces in one packing task, on average; each task leaves about one sequence that is not full.
GROUP = 50_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens() -> dict[str, int]:
    """The marks that the JSON tokenizer of the same vocabulary cuts out of a text before all else."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}


class Encoder:
    """Text to little-endian ids, an added token to its own.

    Texts are encoded whole: to split them into words and look up what is remembered of each costs more than to
    encode them, as rare words make up most of a vocabulary.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        encoding = tiktoken.Encoding(
            "corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added_tokens())
        self.plain = partial(encoding.encode, allowed_special="all")
        # The same ids as an array, without a list in between.
        self.array = partial(encoding.encode_to_numpy, allowed_special="all")

    def ids(self, text: str) -> bytes:
        return self.array(text).astype("<u4", copy=False).tobytes()


def cuts(n_tokens: int, size: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter than ``size``."""
    first = n_tokens - (n_tokens - 1) // size * size
    return [(0, first), *((s, size) for s in range(first, n_tokens, size))]


def _cut_batches(path: str, size: int, with_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            encoder = encoder or Encoder(path)
            rows = ([], [], [], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.ids(text.as_py() or "") + end
                for k, (start, length) in enumerate(cuts(len(ids) // 4, size)):
                    own = ids[4 * start:4 * (start + length)]
                    for column, value in zip(rows, (doc_id, k, start, length, zlib.crc32(own), own)):
                        column.append(value)
            columns = [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()),
                       *(pa.array(c, pa.int64()) for c in rows[2:5])]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(rows[5], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)
    return run


def token_pieces(
    docs: DataFrame, size: int = SEQUENCE, with_ids: bool = False, path: str | None = None
) -> DataFrame:
    """Every document as pieces of at most ``size`` tokens, its end token included.

    Null text is empty: one piece that holds the end token. ``with_ids`` adds the ids themselves, as
    little-endian unsigned 32-bit numbers.
    """
    small_batches(docs.sparkSession)
    schema = PIECES + (", ids binary" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _cut_batches(path or tokenizer_file(), size, with_ids), schema)


def best_two_fit(lengths: np.ndarray, capacity: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece.

    A bin takes the largest piece that fits until none does. If a gap is left, its smallest piece is
    exchanged for the two unpacked ones that together fill the space of gap and piece best, provided
    they fill it better. Ties: the larger of the two pieces is as large as possible; equal lengths go
    by position, last first.
    """
    stock: dict[int, list[int]] = {}
    for place, length in enumerate(lengths.tolist()):
        stock.setdefault(length, []).append(place)
    open_ = sum(1 << length for length in stock)
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)

    def largest(limit: int) -> int:
        return (open_ & ((1 << (limit + 1)) - 1)).bit_length() - 1

    def best_pair(room: int, above: int) -> tuple[int, int] | None:
        best, a = None, largest(room - 1)
        while a > 0 and 2 * a > above:
            b = largest(min(a, room - a))
            if b == a and len(stock[a]) < 2:
                b = largest(a - 1)
            if b > 0 and a + b > above:
                best, above = (a, b), a + b
                if above == room:
                    break
            a = largest(a - 1)
        return best

    n_bins = 0
    while open_:
        held: list[int] = []
        gap = capacity
        while gap and (length := largest(gap)) > 0:
            held.append(stock[length].pop())
            gap -= length
            if not stock[length]:
                open_ ^= 1 << length
        if gap and open_:
            smallest = int(lengths[held[-1]])
            pair = best_pair(gap + smallest, smallest)
            if pair:
                back = held.pop()
                for length in pair:
                    held.append(stock[length].pop())
                    if not stock[length]:
                        open_ ^= 1 << length
                stock[smallest].append(back)
                open_ |= 1 << smallest
        offset = 0
        for place in held:
            bins[place], offsets[place] = n_bins, offset
            offset += int(lengths[place])
        n_bins += 1
    return bins, offsets


def pack(pieces: DataFrame, size: int = SEQUENCE, group: int = GROUP) -> DataFrame:
    """``pieces`` plus sequence_id and offset; ``pieces`` must be a written table (it is read twice).

    Full pieces are sequences by themselves. The others are dealt by row number into as many groups as
    keep ``group`` pieces each on average. An empty table gives an empty table; repeated rows are
    packed as rows of their own.
    """
    spark = pieces.sparkSession
    numbered = pieces.withColumn("_row", F.monotonically_increasing_id())
    full = numbered.where(F.col("length") >= size).select(
        *pieces.columns, (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = numbered.where(F.col("length") < size)
    n_groups = -(-short.count() // group) or 1
    schema = full.schema

    names = [f.name for f in schema.fields]

    def pack_group(rows: pa.Table) -> pa.Table:
        bins, offsets = best_two_fit(rows["length"].to_numpy(), size)
        ids = bins + (rows["_group"].to_numpy().astype(np.int64) << 32)
        return rows.append_column("sequence_id", pa.array(ids)).append_column(
            "offset", pa.array(offsets)).select(names)

    dealt = short.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(n_groups)).cast("int"))
    packed = dealt.drop("_row").groupBy("_group").applyInArrow(pack_group, schema)
    return full.unionByName(packed)


def pack_documents(docs: DataFrame, size: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack: one row per piece with its sequence and place.

    Null doc_ids stay null; documents that share an id are packed row by row.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    return pack(scratch.write(token_pieces(docs, size, with_ids)), size)
