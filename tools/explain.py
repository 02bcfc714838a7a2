"""Print the physical plan of registered queries and a census of its operators.

Usage: python tools/explain.py [sf_dir] key [key ...] [--full]

For each key: the formatted plan (with ``--full``) and counts of the operators
that matter at scale (shuffles, join strategies, partial aggregation, windows,
scans with their read schema and pushed filters).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cardsentry.plans.catalog import queries  # noqa: E402
from cardsentry.session import get_session  # noqa: E402

# operator lines of the formatted plan's detail section: "(12) Exchange"
CENSUS = [
    ("shuffles", r"^\(\d+\) Exchange$"),
    ("broadcasts", r"^\(\d+\) BroadcastExchange$"),
    ("broadcast_joins", r"^\(\d+\) BroadcastHashJoin"),
    ("sort_merge_joins", r"^\(\d+\) SortMergeJoin"),
    ("aggregates", r"^\(\d+\) (Hash|SortAggregate|ObjectHash)"),
    ("windows", r"^\(\d+\) Window$"),
    ("top_k", r"^\(\d+\) TakeOrderedAndProject"),
    ("scans", r"^\(\d+\) Scan "),
]


def census(plan: str) -> dict[str, int]:
    return {name: len(re.findall(pat, plan, flags=re.M)) for name, pat in CENSUS}


def main() -> None:
    args = [a for a in sys.argv[1:] if a != "--full"]
    full = "--full" in sys.argv
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in args if not a.startswith("/")]
    spark = get_session(shuffle_partitions=8)
    qs = queries()
    for k in keys:
        df = qs[k](spark, sf_dir)
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        print(f"===== {k}: {census(plan)}")
        for m in sorted(set(re.findall(r"ReadSchema: struct<[^>]*>", plan))):
            print("   ", m)
        for m in sorted(set(re.findall(r"PushedFilters: \[[^\]]*\]", plan))):
            if m != "PushedFilters: []":
                print("   ", m)
        if full:
            print(plan)
    spark.stop()


if __name__ == "__main__":
    main()
