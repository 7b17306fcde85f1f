"""Summarize the physical plan of every registered query (PLANS.md).

    python tools/plan_summary.py [sf_dir] > PLANS.md

Per query: shuffles (with their keys), join strategies, aggregations,
windows, and for each Parquet scan the columns read and pushed filters.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarize(text: str) -> dict:
    shuffles = re.findall(r"Arguments: (hashpartitioning|rangepartitioning|SinglePartition)\(?([^\n]*)", text)
    ops = re.findall(r"^\(\d+\) (\w+(?: \w+)*)", text, flags=re.M)
    scans = []
    for block in re.split(r"\n(?=\(\d+\) )", text):
        if block.startswith("(") and "Scan parquet" in block.splitlines()[0]:
            loc = re.search(r"Location: [^\[]*\[([^\]]*)\]", block)
            schema = re.search(r"ReadSchema: struct<([^>]*)>", block)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", block)
            scans.append((os.path.basename(loc.group(1)) if loc else "?",
                          ", ".join(c.split(":")[0] for c in schema.group(1).split(",")) if schema else "",
                          pushed.group(1) if pushed else ""))
    return {
        "shuffles": [f"{kind}({re.split(r'\), (ENSURE|REPARTITION)', re.sub(r'#[0-9]+L?', '', args))[0]})"
                     for kind, args in shuffles],
        "joins": sorted({o for o in ops if "Join" in o or o == "BroadcastNestedLoopJoin"}),
        "aggregates": sum(1 for o in ops if o.endswith("Aggregate")),
        "windows": sum(1 for o in ops if o == "Window"),
        "topk": any(o == "TakeOrderedAndProject" for o in ops),
        "scans": scans,
    }


def main() -> None:
    from ordersentry.session import get_session
    from ordersentry import catalog
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(shuffle_partitions=8)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_summary.py` at {os.path.basename(sf)} (AQE may re-plan joins at run "
          "time; broadcast choices below are the initial plan).\n")
    for name, fn in catalog.queries().items():
        s = summarize(formatted(fn(spark, sf)))
        print(f"## {name}\n")
        print(f"- shuffles ({len(s['shuffles'])}): " + ("; ".join(s["shuffles"]) or "none"))
        print(f"- joins: {', '.join(s['joins']) or 'none'}; aggregations: {s['aggregates']}; "
              f"windows: {s['windows']}; top-k: {'yes' if s['topk'] else 'no'}")
        for table, cols, pushed in s["scans"]:
            print(f"- scan `{table}`: reads [{cols}]" + (f"; pushed [{pushed}]" if pushed else ""))
        print()
    spark.stop()


if __name__ == "__main__":
    main()
