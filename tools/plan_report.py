"""Summarise the physical plan of every query of the catalog into PLANS.md.

Usage: python tools/plan_report.py [sf_dir]

For each query: exchanges (shuffles), join strategies, scans with their
pushed filters and read columns, and any operator that should never appear
(nested-loop or cartesian joins, Python UDF evaluation).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adsphere.catalog import QUERIES  # noqa: E402
from adsphere.session import build_session, ensure_checkpoint_dir  # noqa: E402

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(plan: str) -> dict:
    ops = re.findall(r"^\(\d+\) (\w+)", plan, flags=re.M)
    joins = sorted({o for o in ops if o.endswith("Join")})
    scans = []
    for block in re.split(r"\n\s*\n", plan):
        block = block.strip()
        if re.match(r"\(\d+\) Scan parquet", block):
            table = re.search(r"Location: \w+ \[?[^\]]*?([\w\-]+)\.parquet", block)
            read = re.search(r"ReadSchema: struct<(.*)>", block)
            pushed = re.search(r"PushedFilters: \[(.*)\]", block)
            cols = len(read.group(1).split(",")) if read and read.group(1) else 0
            scans.append((table.group(1) if table else "table", cols,
                          pushed.group(1) if pushed and pushed.group(1) else ""))
    return {"exchanges": ops.count("Exchange"), "broadcasts": ops.count("BroadcastExchange"),
            "joins": joins, "scans": scans, "forbidden": sorted({o for o in ops if o in FORBIDDEN})}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16)
    ensure_checkpoint_dir(spark)
    lines = ["# PLANS — physical-plan summary of every query of the catalog", "",
             f"Generated by `python tools/plan_report.py {sf_dir}` (initial AQE plans, before runtime "
             "re-optimisation; materialised intermediate tables appear as Parquet scans of the checkpoint "
             "folder). Columns: shuffles (`Exchange`), broadcasts, join operators, scans as "
             "`table(columns read; pushed filters)`.", "",
             "| Query | Shuffles | Broadcasts | Joins | Scans | Forbidden |", "| --- | --- | --- | --- | --- | --- |"]
    bad = 0
    for name, fn in QUERIES.items():
        s = summarise(formatted(fn(spark, sf_dir)))
        scans = "; ".join(f"{t}({c}{'; ' + p if p else ''})" for t, c, p in s["scans"])
        bad += bool(s["forbidden"])
        lines.append(f"| {name} | {s['exchanges']} | {s['broadcasts']} | {', '.join(s['joins']) or '–'} | "
                     f"{scans} | {', '.join(s['forbidden']) or 'none'} |")
    lines += ["", f"Queries with a forbidden operator: {bad}."]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")
    spark.stop()
    print(f"wrote PLANS.md; forbidden operators in {bad} queries")


if __name__ == "__main__":
    main()
