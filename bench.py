"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs end to end into Spark's ``noop`` sink (the whole plan is
executed, nothing is collected to the driver). Warm-up first: two queries on
the tiny sf0.001 tables start the JVM code paths and the Python workers (a
one-off ~8 s per application); nothing of the timed data is cached.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bitext.plans.registry import QUERIES  # noqa: E402
from bitext.session import build_session  # noqa: E402

HEADLINE = [
    "corpus_summary",      # U3: clean -> dedup -> filter -> exact split
    "clean_audit",         # A1
    "vocab_src",           # A3
    "sentences",           # P8
    "glossary_protect",    # P9
    "translate_docs",      # U2 (memory + glossary + model slot + fan-out)
    "evaluate_systems",    # U4 / A5 corpus BLEU
    "metrics_rows",        # A10 report
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app_name="bitext-bench", shuffle_partitions=cpus,
                          # the tables are files of one row group: deal them to all cores
                          extra={"spark.bitext.spreadSmallInputs": "true"})
    spark.sparkContext.setLogLevel("ERROR")
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in ("sentences", "corpus_summary"):  # warm-up
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
