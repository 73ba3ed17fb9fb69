"""Print the formatted physical plan of registered queries, after running
them once so AQE's final plan is shown, plus a one-line summary.

usage: python tools/explain_plan.py <sf_dir> <query> [<query> ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pairforge.plans import QUERIES  # noqa: E402
from pairforge.session import build_session  # noqa: E402


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        summary = {
            "scans": len(re.findall(r"FileScan parquet", plan)),
            "exchanges": len(re.findall(r"Exchange ", plan)),
            "broadcast_joins": len(re.findall(r"BroadcastHashJoin", plan)),
            "sort_merge_joins": len(re.findall(r"SortMergeJoin", plan)),
            "python_udfs": len(re.findall(r"ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", plan)),
        }
        print(f"== {name}: {summary}")
        for m in sorted(set(re.findall(r"ReadSchema: struct<[^>]*>", plan))):
            print("  ", m)
        for m in sorted(set(re.findall(r"PushedFilters: \[[^\]]*\]", plan))):
            print("  ", m)
        df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
