"""Summarise the physical plan of every registered query into PLANS.md.

For each query: shuffles (Exchange), broadcasts, Python/Arrow nodes, scans
with their pushed filters and read columns.  Queries whose work is a
driver-side fit return a small result table; their data pass runs while the
DataFrame is built, and the plan of that pass is shown for the main fits
below the table.

Usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plan_text(df) -> str:
    """The formatted physical plan (scan metadata is not abbreviated there)."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def summarise(plan: str) -> dict:
    heads = re.findall(r"^\((\d+)\) (.+?)\s*$", plan, flags=re.M)
    ex = sum(1 for _, h in heads if h.startswith("Exchange"))
    bc = sum(1 for _, h in heads if h.startswith("BroadcastExchange"))
    py = sorted({h.split()[0] for _, h in heads
                 if h.split()[0] in ("MapInArrow", "MapInPandas", "FlatMapGroupsInPandas",
                                     "ArrowEvalPython", "BatchEvalPython")})
    scans = []
    for block in re.split(r"\n(?=\(\d+\) )", plan):
        head = block.splitlines()[0] if block else ""
        if not re.match(r"\(\d+\) (Scan |InMemoryTableScan|LocalTableScan)", head):
            continue
        loc = re.search(r"Location: \w+ \[([^\]]*)\]", block)
        name = head.split(") ", 1)[1].strip()
        if loc:
            base = loc.group(1).split(",")[0].rstrip("/").rsplit("/", 1)[-1]
            name = base.replace(".parquet", "") if base.endswith(".parquet") else name.replace("Scan ", "")
        pf = re.search(r"PushedFilters: \[(.*)\]", block)
        rs = re.search(r"ReadSchema: struct<(.*)>", block)
        cols = [c.split(":")[0] for c in re.split(r",(?![^<]*>)", rs.group(1))] if rs and rs.group(1) else []
        scans.append((name, pf.group(1) if pf else "", cols))
    return {"exchanges": ex, "broadcasts": bc, "python": py, "scans": scans}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from tessera.plans import QUERIES
    from tessera.session import get_spark
    from tessera.operators import classification as CL
    from tessera.operators import regression as RG
    from tessera.plans import inputs as I

    spark = get_spark(master=f"local[{os.environ.get('BENCH_CPUS', '8')}]", spark__driver__memory="16g", spark__sql__shuffle__partitions=os.environ.get("BENCH_CPUS", "8"))
    out = ["# PLANS", "",
           f"Physical plans of the registered queries (`tools/plan_report.py`, {sf_dir}, AQE on, "
           "before runtime re-planning). *Shuffles* counts Exchange nodes, *Bcast* broadcast "
           "exchanges; scans list pushed filters and the columns read. Queries marked "
           "*driver-side fit* return a small result table built from a data pass that already ran "
           "(that pass's plan is shown at the end).", "",
           "| Query | Shuffles | Bcast | Python | Scans (pushed filters; columns read) |",
           "| --- | --- | --- | --- | --- |"]
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        s = summarise(plan_text(df))
        scans = "; ".join(f"{n}" + (f" [{pf}]" if pf else "") + (f" ({', '.join(c)})" if c else "")
                          for n, pf, c in s["scans"]) or "–"
        if all(("ExistingRDD" in n or "LocalTableScan" in n) for n, _, _ in s["scans"]) \
                and s["exchanges"] == 0 and not s["python"]:
            scans = "*driver-side fit*: small result table"
        out.append(f"| `{name}` | {s['exchanges']} | {s['broadcasts']} | {', '.join(s['python']) or '–'} | {scans} |")
    out += ["", "## The data passes behind the driver-side fits", ""]
    from tessera.operators.aggregates import BLOCK_SCHEMA, block_sums

    rows = I.embedding_rows(spark, sf_dir)
    out += ["### Gram summary (`gram_sums` and `block_sums`, one pass for descent and cross-validation)", "", "```",
            plan_text(block_sums(RG.gram_sums(rows.withColumn("fold", I.fold_of("vec_id")), "label", "x", "fold"))).split("\n\n")[0],
            "```", ""]
    r = CL.prepare_rows(rows, "label", "x", key="vec_id")
    parts = r.select("label", "x").mapInArrow(lambda batches: iter(()), BLOCK_SCHEMA)
    out += ["### One round of a softmax / network fit (per-task partial sums, summed by block and salt, then by block)", "", "```",
            plan_text(block_sums(parts)).split("\n\n")[0], "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
