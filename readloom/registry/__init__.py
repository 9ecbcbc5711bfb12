"""Named queries over the domain tables, each beside the SQL that checks it."""

from readloom.registry import files, genes, hits, reads, reports, runs, taxonomy  # noqa: F401
from readloom.registry.core import QUERIES, oracle_sql, runnable

__all__ = ["QUERIES", "oracle_sql", "runnable"]
