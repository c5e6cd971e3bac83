"""Explain every registered batch query and flag plan shapes that do not scale.

Usage: python scripts/plan_audit.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from reviewlake.plans.coverage_queries import COVERAGE_QUERIES  # noqa: E402
from reviewlake.plans.queries import QUERIES  # noqa: E402
from reviewlake.session import get_spark  # noqa: E402

FLAGS = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
         "FlatMapGroupsInPandas", "Window ", "WindowGroupLimit", "SortMergeJoin", "BroadcastHashJoin")


def main() -> None:
    base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]")
    for name, fn in {**QUERIES, **COVERAGE_QUERIES}.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, base).explain("formatted")
        plan = buf.getvalue()
        found = {f.strip(): plan.count(f) for f in FLAGS if f in plan}
        scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
        pushed = [p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if p]
        print(f"{name:22s} {found} scans={len(scans)} pushed={pushed[:2]}")


if __name__ == "__main__":
    main()
