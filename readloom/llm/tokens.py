"""Tokens of whole texts in lists of bounded size, by a byte table that maps separators to blanks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

# Bytes of a text that are split at a time; a longer token is taken whole.
SLICE = 1 << 20


def byte_table(kept: range | list[int] | set[int]) -> bytes:
    """A translation that keeps the given bytes, lower-cases A-Z among them and blanks the others."""
    kept = set(kept)
    return bytes(
        (c + 32 if 0x41 <= c <= 0x5A else c) if c in kept else 0x20 for c in range(256))


def token_lists(raw: bytes, table: bytes, size: int = SLICE) -> Iterator[list[bytes]]:
    plain = raw.translate(table)
    start = 0
    while start < len(plain):
        end = len(plain)
        if end - start > size:
            end = plain.rfind(b" ", start, start + size)
            if end <= start:
                end = plain.find(b" ", start + size)
            end = len(plain) if end < 0 else end
        yield plain[start:end].split()
        start = end + (end == start)


def token_counts(raw: bytes, table: bytes, size: int = SLICE) -> Counter:
    counts: Counter = Counter()
    for tokens in token_lists(raw, table, size):
        counts.update(tokens)
    return counts
