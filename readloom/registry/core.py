"""Registry of named queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.adapters import Domain
from readloom.registry.views import with_views

Query = Callable[[Domain], DataFrame]

QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
# Values that stand for a missing one in a query's result, so that both engines show the same.
_FILL: dict[str, dict[str, str | int | float]] = {}

_domains: dict[tuple[str, str], Domain] = {}


def domain(spark: SparkSession, folder: str) -> Domain:
    """One domain per application and folder, so stage tables are written once and shared."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _domains:
        _domains[key] = Domain(spark, folder)
    return _domains[key]


# Sums of doubles depend on their order, so both engines show as many digits as all orders agree on: six
# decimals or, of numbers too small for these, nine significant digits. Spark rounds the decimal text of a
# double and the oracle its binary value; a nudge far below the last decimal settles halves the same way.
_NUDGE = 1e-9
_SMALL = 1e-3
_DIGITS = "%.8e"


def shown(value: Column) -> Column:
    small = F.format_string(_DIGITS, value).cast("double") + F.lit(0.0)
    return F.when(F.abs(value) < _SMALL, small).otherwise(F.round(value + _NUDGE, 6))


def shown_sql(sql: str) -> str:
    """``round(x, 6)`` of a query's SQL as ``shown`` has it."""
    out, at = [], 0
    while (start := sql.find("round(", at)) >= 0:
        depth, end = 1, start + len("round(")
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner = sql[start + len("round("):end - 1]
        out.append(sql[at:start])
        if inner.endswith(", 6"):
            x = f"({shown_sql(inner[:-3])})::DOUBLE"
            out.append(f"CASE WHEN abs({x}) < {_SMALL} THEN CAST(printf('{_DIGITS}', {x}) AS DOUBLE) + 0.0::DOUBLE "
                       f"ELSE round({x} + {_NUDGE}, 6) END")
        else:
            out.append(f"round({shown_sql(inner)})")
        at = end
    return "".join([*out, sql[at:]])


def rounded(df: DataFrame) -> DataFrame:
    """Doubles with the digits both engines agree on, as the SQL side shows them."""
    return df.select(*[
        shown(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def query(
    name: str, sql: str | None = None, fill: dict[str, str | int | float] | None = None
) -> Callable[[Query], Query]:
    """Register a query under its name, with the SQL that must give the same rows."""
    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            _SQL[name] = sql
        _FILL[name] = fill or {}
        return build
    return register


def runnable(name: str) -> Callable[[SparkSession, str], DataFrame]:
    build = QUERIES[name]

    def run(spark: SparkSession, folder: str) -> DataFrame:
        table = rounded(build(domain(spark, folder)))
        return table.na.fill(_FILL[name]) if _FILL[name] else table

    run.__name__ = name
    return run


def oracle_sql() -> dict[str, str]:
    """The SQL of every query that has one, with the views it needs."""
    texts = {}
    for name, sql in _SQL.items():
        text = shown_sql(sql)
        if _FILL[name]:
            filled = ", ".join(f"coalesce({c}, {v!r}) AS {c}" for c, v in _FILL[name].items())
            text = f"SELECT * REPLACE ({filled}) FROM ({text})"
        texts[name] = with_views(text)
    return texts
