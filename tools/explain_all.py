"""Summarise the physical plan of every registered query.

Usage: python tools/explain_all.py [sf_dir] [out_dir]
Prints, per query, the number of exchanges and of each join strategy, Python
operators, and whether filters reach the Parquet scans; writes each
formatted plan to ``out_dir`` when given. Queries that write files are
skipped (their plans are built eagerly). Counts come from the plan before
AQE runs it: identical scalar subqueries listed several times are reused at
run time (``ReusedSubquery``), and AQE may turn sort-merge joins into
broadcasts once it sees the real sizes.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillsight.plans.registry import queries  # noqa: E402
from tillsight.session import get_session  # noqa: E402

SKIP = {"csv_validation", "load_reconcile", "incremental_load"}
INCLUDE_SUBQUERIES = {"BroadcastNestedLoopJoin", "CartesianProduct"}
NODES = ("Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin",
         "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
         "FlatMapGroupsInPandas", "Window", "TakeOrderedAndProject")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else None
    spark = get_session("local[8]", shuffle_partitions=16,
                        conf={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    print(f"{'query':28s} " + " ".join(f"{n[:10]:>10s}" for n in NODES) + "  pushed")
    for name, fn in queries().items():
        if name in SKIP:
            continue
        df = fn(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        # Nested-loop and cartesian joins are counted in the formatted plan,
        # which also lists the plans of scalar subqueries.
        counts = [len(re.findall(rf"\b{n}\b", text if n in INCLUDE_SUBQUERIES else plan))
                  for n in NODES]
        pushed = len(re.findall(r"PushedFilters: \[[^\]]+\]", text))
        print(f"{name:28s} " + " ".join(f"{c:>10d}" for c in counts) + f"  {pushed:>6d}")
        if out:
            os.makedirs(out, exist_ok=True)
            with open(os.path.join(out, f"{name}.txt"), "w", encoding="utf-8") as fh:
                fh.write(text)
    spark.stop()


if __name__ == "__main__":
    main()
