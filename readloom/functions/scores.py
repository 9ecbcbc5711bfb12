"""Score arithmetic as Column expressions; lengths of subjects and cutoffs are in amino acids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FLOOR = 1000.0


def per_kilobase(s_len: Column) -> Column:
    """RPK of a read, FPK of a fragment."""
    return F.lit(1000.0) / 3 / s_len


def effective_per_kilobase(s_len: Column, read_length: Column, length_cutoff: int) -> Column:
    """ERPK: reads per kilobase of the part of the gene where a read can be recognised."""
    effective = s_len * 3 - 6 * length_cutoff + read_length + 1
    return F.when(effective > 1, F.lit(1000.0) / effective).otherwise(_FLOOR)


def effective_fragments_per_kilobase(
    s_len: Column, read_length: Column, length_cutoff: int, insert_size: Column
) -> Column:
    """EFPK; a null insert size means unknown."""
    base = s_len * 3 - 6 * length_cutoff
    effective = (
        F.when(insert_size.isNull(), base + 2 * read_length + 1)
        .when(insert_size > 2 * read_length + s_len, 2 * (base + read_length + 1))
        .otherwise(base + insert_size + 1)
    )
    return F.when(effective > 0, F.lit(1000.0) / effective).otherwise(_FLOOR)


def hit_rpkm(s_len: Column, fraction: Column, read_count: Column, length_cutoff: int) -> Column:
    usable = s_len - length_cutoff
    scaled = fraction * 1e9
    return F.when(usable > 0, scaled / (usable * 3 * read_count)).otherwise(
        scaled / (read_count * 3)
    )


def relative_abundance(
    coverage: Column, average: Column, fraction: Column | float = 1.0
) -> Column:
    weighted = coverage * fraction
    return F.when(average == 0, weighted).otherwise(weighted / average)
