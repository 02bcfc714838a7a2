"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Every query is run to completion with a ``noop`` write (all rows computed,
nothing collected on the driver). A warm-up query on sf0.001 runs first so
JVM start-up and first code generation are not charged to any query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cardsentry.plans.catalog import queries  # noqa: E402
from cardsentry.session import get_session  # noqa: E402

HEADLINE = [
    "feat_all",                     # feature derivation over all payments
    "kpi_totals",                   # one-pass KPI aggregate
    "recent_predictions",           # top-k then join
    "frauds_by_state",              # join, filter, group, top-k
    "amount_quartiles",             # exact distributed quantiles per label
    "daily_report_rows",            # previous-day extract
    "validate_violations",          # validation of the dirty feed
    "sink_payments_insert_ignore",  # keyed insert-if-new, two batches
    "split_stratified",             # exact per-class 80/20 split
    "score_transactions",           # scoring output shape
    "eval_classification_report",   # per-class report
    "src_json_split",               # split-orient JSON feed decode
    "stream_insert_ignore",         # streaming insert-ignore
    "ml_train_score",               # 100-tree forest fit + score
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    only = [q for q in sys.argv[1:] if q]
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    qs = queries()
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        qs["kpi_totals"](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in only or HEADLINE:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
