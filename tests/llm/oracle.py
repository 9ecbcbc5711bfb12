"""Compare queries of the package with their SQL: python tests/llm/oracle.py sf0.01 NAME..."""

from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

import oracle_check  # noqa: E402
from readloom.session import build_session  # noqa: E402

if __name__ == "__main__":
    folder = f"/root/testdata/{sys.argv[1]}"
    spark = build_session("llm-oracle")
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_check.connect(folder)
    for name in sys.argv[2:]:
        start = time.time()
        print(name, oracle_check.compare(spark, con, folder, name), f"{time.time() - start:.1f}s", flush=True)
