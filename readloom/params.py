"""Run parameters and the fixed vocabulary of the domain."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any

# Taxonomic ranks from the top of the tree to the bottom, and special taxa.
RANKS = [
    "norank", "superkingdom", "phylum", "class", "order", "family", "genus", "species",
]
LOWER_RANK = dict(zip(RANKS[:-1], RANKS[1:]))
ROOT_TAXID = "1"
UNKNOWN_TAXID = "0"
CELLULAR_TAXID = "131567"

# Read ends and read statuses.
END1, END2 = "pe1", "pe2"
CANDIDATE, GOOD, BAD = "unaccounted", "function", "nofunction"


@dataclass(frozen=True)
class RunParams:
    """Cutoffs of one run; ``for_collection`` layers per-collection overrides on the defaults."""

    identity_cutoff: float = 50.0
    length_cutoff: int = 15
    overlap_cutoff: int = 10
    bitscore_range: float = 0.03
    contig_min_length: int = 300
    contig_min_coverage: float = 3.0
    rank_cutoffs: dict[str, float] = field(default_factory=dict)

    def for_collection(self, overrides: dict[str, Any]) -> "RunParams":
        return replace(self, **overrides)


def parse_rank_cutoffs(text: str, identity_cutoff: float) -> dict[str, float]:
    """``'species,80,genus,75'`` to a rank -> cutoff map; 'norank' takes the general cutoff."""
    tokens = text.split(",")
    cutoffs = {rank: float(value) for rank, value in zip(tokens[::2], tokens[1::2])}
    cutoffs["norank"] = identity_cutoff
    return cutoffs
