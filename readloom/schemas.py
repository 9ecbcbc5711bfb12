"""Schemas of the domain tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _D, _L = T.StringType(), T.IntegerType(), T.DoubleType(), T.LongType()

# Column order of the aligner's headerless table.
HIT_COLUMNS = [
    ("query_id", _S), ("subject_id", _S), ("identity", _D), ("length", _I),
    ("mismatch", _I), ("s_len", _I), ("q_start", _I), ("q_end", _I),
    ("s_start", _I), ("s_end", _I), ("evalue", _D), ("bitscore", _D),
]
HITS = T.StructType([T.StructField(name, kind) for name, kind in HIT_COLUMNS])
HIT_LIST = T.StructType(HITS.fields + [T.StructField("functions", _S)])

# Everything about a hit that is not its de-duplication key (subject, q_start, q_end).
HIT_PAYLOAD = [
    "ord", "identity", "length", "mismatch", "s_len", "s_start", "s_end", "evalue", "bitscore",
]
# Input order of hits; the last three settle rows that share a position.
HIT_ORDER = ["ord", "subject_id", "q_start", "q_end"]

# The hit as it is kept inside an annotated read.
KEPT_HIT_FIELDS = [
    "subject_id", "identity", "length", "mismatch", "s_len",
    "q_start", "q_end", "s_start", "s_end", "evalue", "bitscore", "functions",
]
KEPT_HIT = T.StructType(
    [T.StructField("subject_id", _S)]
    + [f for f in HITS.fields if f.name not in ("query_id", "subject_id")]
    + [T.StructField("functions", T.ArrayType(_S))]
)
