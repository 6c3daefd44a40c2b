"""Summarise the executed (adaptive, final) physical plan of every headline query.

    python tools/plan_summary.py [sf_dir] > PLANS.md

Each query is run once (collected: use a small scale), then its final plan
is read from the public ``explain`` output and reduced to the operators that
matter at scale: shuffles, broadcasts, reused exchanges, aggregate kinds,
Python stages, and what reached the parquet scans.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from quarry.plans.registry import QUERIES  # noqa: E402
from quarry.session import build_session  # noqa: E402


def _plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _summary(text: str) -> dict:
    body = text.split("\n\n")[0]
    if "== Final Plan ==" in body:  # adaptive plans print the final and the initial tree
        body = body.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    count = lambda pat: len(re.findall(pat, body))
    filters = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", text)) - {""})
    schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", text)))
    return {
        "shuffles": count(r"Exchange \(") - count(r"BroadcastExchange \(") - count(r"ReusedExchange \("),
        "reused": count(r"ReusedExchange \("),
        "broadcast joins": count(r"BroadcastHashJoin"),
        "sort-merge joins": count(r"SortMergeJoin"),
        "hash aggregates": count(r"(?<!Object)HashAggregate \("),
        "object aggregates": count(r"ObjectHashAggregate \("),
        "sort aggregates": count(r"SortAggregate \("),
        "windows": count(r"Window \("),
        "python": count(r"MapInPandas \(|ArrowEvalPython \(|FlatMapGroupsInPandas"),
        "pushed filters": "; ".join(filters) or "-",
        "read schema": "; ".join(schemas),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", app="quarry-plans", shuffle_partitions=16)
    cols = ["shuffles", "reused", "broadcast joins", "sort-merge joins", "hash aggregates", "object aggregates",
            "sort aggregates", "windows", "python"]
    print("# PLANS\n")
    print(f"Final adaptive plans of the headline queries (`python tools/plan_summary.py {sf}`), counted from the")
    print("public `explain(\"formatted\")` output after one run. Shuffles exclude broadcast and reused exchanges.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    details = []
    for name in HEADLINE:
        s = _summary(_plan(QUERIES[name](spark, sf)))
        print(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |")
        details.append((name, s))
    print("\n## Scans\n")
    for name, s in details:
        cols_read = s["read schema"] or "reads a checkpoint of its input (staged before sampling)"
        print(f"* `{name}`: filters `{s['pushed filters']}`; columns `{cols_read}`")
    spark.stop()


if __name__ == "__main__":
    main()
