"""Physical-plan summary of every registered query, as a Markdown table.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Runs each query and reads its final adaptive plan: shuffles by kind, exchanges reused,
broadcasts, sort-based aggregates, Python nodes, Parquet scans that ran and the columns
they read.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarterlens.plans import registry  # noqa: E402
from quarterlens.session import build_session  # noqa: E402

SHUFFLES = {"hash": "Exchange hashpartitioning", "range": "Exchange rangepartitioning",
            "single": "Exchange SinglePartition", "round-robin": "Exchange RoundRobinPartitioning"}
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "MapInArrow",
          "FlatMapGroupsInArrow", "FlatMapCoGroupsInArrow")
SCAN = re.compile(r"FileScan parquet \[([^\]]*)\].*?Location: \w+\([^)]*\)\[file:[^\]]*/(\w+)\.parquet\]")


HEADER = """# Physical plans of the registered queries

Generated by `python tools/plan_report.py` on `{sf}`: final adaptive plans, as they ran. Columns:
shuffle exchanges by partitioning (`single` is the final step of a global aggregate or a scalar
subquery after its partial step), exchanges that were reused instead of run again, broadcast
exchanges, sort-based aggregates, Python evaluation nodes, Parquet scans that ran, and the
columns each table's scans read. Runtime re-planning turns joins with a small side into broadcast
joins, so at a larger size some broadcasts are shuffles. Queries that checkpoint their input first
plan against the checkpoint, so their upstream is not listed with them; as-of joins count their
groups in a small aggregate of their own while they are built. A subquery is counted wherever
Spark prints it, more than once if several expressions read it. The five queries that fit a model
are left out, and so are those of `quarterlens.llm`, whose stages the README describes.
"""


def final_part(plan: str) -> str:
    """An adaptive plan's text without its initial plans, those of subqueries included."""
    out, skip = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and depth >= skip:
            continue
        skip = depth if "== Initial Plan ==" in line else None
        if skip is None:
            out.append(line)
    return "\n".join(out) + "\n"


def summarise(plan: str) -> dict:
    plan = final_part(plan)
    reused = len(re.findall(r"ReusedExchange \[", plan))
    ran = re.sub(r"ReusedExchange \[[^\n]*", "", plan)
    out = {k: ran.count(v) for k, v in SHUFFLES.items()}
    out["reused"] = reused
    out["broadcast"] = ran.count("BroadcastExchange")
    out["sort_agg"] = ran.count("SortAggregate(")
    out["python"] = sum(ran.count(f" {p} ") + ran.count(f" {p}\n") for p in PYTHON)
    scans = {}
    found = SCAN.findall(ran)
    for cols, table in found:
        names = sorted({re.sub(r"#\d+L?$", "", c.strip()) for c in cols.split(",") if c.strip()})
        scans.setdefault(table, set()).update(names)
    out["n_scans"] = len(found)
    out["scans"] = "; ".join(f"{t}({', '.join(sorted(c))})" for t, c in sorted(scans.items()))
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    models = {"gbt_accuracy", "mlp_accuracy", "score_documents", "boosted_trees",
              "dense_net"}                               # they fit a model while planning
    print(HEADER.format(sf=os.path.basename(sf.rstrip("/"))))
    print("| query | hash | range | single | round-robin | reused | broadcast | sort agg | python | "
          "scans | columns read |")
    print("|---|---|---|---|---|---|---|---|---|---|---|")
    registry.load_all()
    for name, q in sorted(registry.QUERIES.items()):
        if name in models:
            continue
        df = q(spark, sf)
        df.collect()                                     # small results at the report's size
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(f"| {name} | " + " | ".join(str(s[k]) for k in (
            "hash", "range", "single", "round-robin", "reused", "broadcast", "sort_agg", "python",
            "n_scans", "scans")) + " |")


if __name__ == "__main__":
    main()
