"""Identifier rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _drop_last(text: Column, n: int) -> Column:
    return F.substring(text, F.lit(1), F.length(text) - n)


def _last_char(text: Column) -> Column:
    return F.substring(text, -1, 1)


def _has_end(text: Column, separator: str) -> Column:
    return text.endswith(separator + "1") | text.endswith(separator + "2")


def parse_read_id(line: Column) -> Column:
    """Header line to ``struct(read_id, end)``; five header styles, unknown ones keep no end."""
    text = F.regexp_replace(line, "^@", "")
    tokens = F.split(text, " ")
    count = F.size(tokens)
    first = F.get(tokens, F.lit(0))

    def result(read_id: Column, end: Column) -> Column:
        return F.struct(read_id.alias("read_id"), end.alias("end"))

    empty = F.lit("")
    stripped = result(_drop_last(text, 2), _last_char(text))
    return (
        F.when(count == 2, result(first, F.substring(F.get(tokens, F.lit(1)), 1, 1)))
        .when(
            (count == 3) & _has_end(first, "."),
            result(_drop_last(first, 2), _last_char(first)),
        )
        .when(count > 2, result(first, empty))
        .when(_has_end(text, "/"), stripped)
        .when(_has_end(text, ".") & (F.size(F.split(text, r"\.")) == 3), stripped)
        .otherwise(result(text, empty))
    )


def mate_read_id(read_id: Column) -> Column:
    """Swap a trailing 1 and 2 after '/' or '.'; ids with a space carry no end in the id."""
    flipped = F.concat(_drop_last(read_id, 1), F.translate(_last_char(read_id), "12", "21"))
    swaps = ~read_id.contains(" ") & (_has_end(read_id, "/") | _has_end(read_id, "."))
    return F.when(swaps, flipped).otherwise(read_id)


def mate_end(end: Column) -> Column:
    return F.when(end == "pe1", "pe2").when(end == "pe2", "pe1").otherwise("")


_REGION = r"(?s)^(.*)\|(\d+)\|(\d+)$"


def region_key(read_id: Column, start: Column, end: Column) -> Column:
    return F.concat_ws("|", read_id, start.cast("string"), end.cast("string"))


def parse_region_key(key: Column) -> Column:
    """``read|start|end`` to its parts; the read id itself may hold '|'."""
    return F.struct(
        F.regexp_extract(key, _REGION, 1).alias("read_id"),
        F.regexp_extract(key, _REGION, 2).cast("int").alias("r_start"),
        F.regexp_extract(key, _REGION, 3).cast("int").alias("r_end"),
    )


def parse_gene_id(gene_id: Column) -> Column:
    """``function|contig_n`` to its parts."""
    tail = F.substring_index(gene_id, "|", -1)
    return F.struct(
        F.substring_index(gene_id, "|", 1).alias("function"),
        F.when(tail.contains("_"), F.regexp_replace(tail, "_[^_]*$", ""))
        .otherwise("")
        .alias("contig_id"),
        F.substring_index(tail, "_", -1).alias("gene_number"),
    )


def contig_of_protein(protein_id: Column, strip_prefix: bool = True) -> Column:
    """Contig id inside a protein id: no last '_' token, and no one-character prefix."""
    head = F.substring_index(protein_id, " # ", 1)
    contig = F.when(head.contains("_"), F.regexp_replace(head, "_[^_]*$", "")).otherwise("")
    return F.substring(contig, F.lit(2), F.length(contig)) if strip_prefix else contig


def split_functions(joined: Column) -> Column:
    """'|'-joined function list to an array; an unknown protein has one empty function."""
    return F.coalesce(F.split(joined, r"\|"), F.array(F.lit("")))
