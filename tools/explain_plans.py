"""Summarise the final physical plan of every registered query of the crawl operators.

Runs each query at the given scale, then reads the executed adaptive plan:
shuffles (Exchange), broadcasts, sorts, whole-stage codegen stages, Python
stages, the columns each Parquet scan reads and its pushed filters. Writes a
Markdown table to stdout.

Usage: python tools/explain_plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def summarise(plan: str) -> dict:
    final = plan.split("== Initial Plan ==")[0]
    return {
        "shuffles": len(re.findall(r"\bExchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", final)),
        "reused": final.count("ReusedExchange"),
        "broadcasts": final.count("BroadcastExchange"),
        "sorts": len(re.findall(r"\bSort \[", final)),
        "codegen": len(set(re.findall(r"\*\((\d+)\)", final))),
        "python": len(re.findall(r"(?:MapInPandas|MapInArrow|ArrowEvalPython|BatchEvalPython)", final)),
        "reads": sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", final))),
        "pushed": sorted(set(p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", final) if p)),
    }


def main() -> None:
    from crawlstats.plans import queries as registry
    from crawlstats.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = local_session()
    print("| query | shuffles | reused | broadcasts | sorts | codegen stages | python | scans read |")
    print("|---|---|---|---|---|---|---|---|")
    for name, fn in registry.queries().items():
        if only and name not in only:
            continue
        df = fn(spark, sf_dir)
        df.collect()
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        reads = "; ".join(r.replace("struct<", "").replace(">", "") for r in s["reads"]) or "(checkpoint/sink)"
        print(
            f"| {name} | {s['shuffles']} | {s['reused']} | {s['broadcasts']} | {s['sorts']} | "
            f"{s['codegen']} | {s['python']} | {reads} |"
        )
    spark.stop()


if __name__ == "__main__":
    main()
