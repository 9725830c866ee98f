"""Summarise the executed (adaptive, final) physical plan of every query.

Usage: python tests/plan_report.py [sf_dir] > PLANS.md
Per query: shuffles, join strategies, windows (and whether any is unpartitioned),
sort aggregates, Python stages, and for each scan the columns read and pushed filters.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])


def summarise(plan: str) -> dict:
    lines = plan.splitlines()
    exchanges = [l for l in lines if re.search(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", l)]
    joins = sorted({m.group(1) for l in lines for m in [re.search(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", l)] if m})
    windows = [l for l in lines if re.search(r"\bWindow \[", l)]
    unpartitioned = [l for l in windows if "], [], [" in l]
    scans = []
    for l in lines:
        m = re.search(r"FileScan (\w+) \[([^\]]*)\].*?Location: \w+\(\d+ paths\)\[([^\]]*)\]", l)
        if m:
            table = m.group(3).rstrip("/").split("/")[-1]
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", l)
            cols = re.sub(r"#\d+L?", "", m.group(2))
            scans.append(f"{table}({cols})" + (f" pushed[{pushed.group(1)}]" if pushed and pushed.group(1) else ""))
    return {
        "shuffles": len(exchanges),
        "joins": ",".join(joins) or "-",
        "windows": f"{len(windows)}" + (f" ({len(unpartitioned)} unpartitioned)" if unpartitioned else ""),
        "sortagg": sum(1 for l in lines if "SortAggregate" in l),
        "python": sum(1 for l in lines if re.search(r"(MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas)", l)),
        "scans": "; ".join(sorted(set(scans))) or "-",
    }


def main() -> None:
    import __spark_entry__ as se
    from vigil.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(master="local[4]")
    print(f"# Executed plans at `{sf_dir}` (final adaptive plans)\n")
    print("Generated by `tests/plan_report.py`. Shuffles = exchanges in the final plan (AQE may turn\n"
          "planned shuffle joins into broadcasts at this scale; at 100 TB the size statistics keep\n"
          "them shuffled). Scans list the columns read and the filters pushed into Parquet.\n")
    print("| Query | Shuffles | Joins | Windows | SortAgg | Python | Scans (columns read, pushed filters) |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name in sorted(se.queries()):
        df = se.queries()[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(f"| `{name}` | {s['shuffles']} | {s['joins']} | {s['windows']} | {s['sortagg']} | {s['python']} | "
              f"{s['scans']} |", flush=True)


if __name__ == "__main__":
    main()
