"""Write PLANS.md: the final adaptive plan of key queries after execution.

Usage: python tools/plans_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from innkeep.plans.catalog import all_queries  # noqa: E402
from innkeep.session import get_session  # noqa: E402

KEYS = [
    "silver_bookings",
    "country_stats",
    "popular_countries",
    "mom_growth",
    "kpi_summary",
    "numeric_summary",
    "rate_histogram",
    "value_counts_country",
    "filtered_bookings",
    "dq_not_null",
]


def final_plan(df) -> tuple[str, list[str]]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n")[0]
    if "== Final Plan ==" in tree:
        tree = tree.split("== Final Plan ==")[1].split("+- == Initial Plan ==")[0]
    scans = re.findall(r"\((\d+)\) Scan parquet.*?\n(.*?)\n\n", text, re.S)
    notes = []
    for _, body in scans:
        for line in body.split("\n"):
            if line.startswith(("PushedFilters", "PartitionFilters", "ReadSchema")):
                notes.append(line[:220])
    return tree.rstrip(), notes


def extra_frames(spark, sf: str) -> dict:
    """Plans that are steps of the CSV-to-gold run rather than registered queries."""
    from innkeep.operators.bronze import load_csv, read_bronze
    from innkeep.operators.silver import build_silver
    from innkeep.plans import datasets as D
    from innkeep.session import staging_path

    bronze = staging_path(spark, "plans-bronze")
    load_csv(spark, D.csv_extract(spark, sf), bronze, min_rows=1)
    return {"pipeline_silver (cleaned layer from the loaded bronze table)": build_silver(read_bronze(spark, bronze))}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16)
    qs = all_queries()
    print(f"# Physical plans (final adaptive plans at {os.path.basename(sf)}, local[8])\n")
    print("Generated by `tools/plans_report.py`; `*` marks whole-stage-codegen operators.\n")
    frames = [(k, qs[k](spark, sf)) for k in KEYS] + list(extra_frames(spark, sf).items())
    for k, df in frames:
        df.collect()
        tree, notes = final_plan(df)
        exchanges = tree.count("Exchange") - tree.count("BroadcastExchange") - tree.count("ReusedExchange")
        print(f"## {k}\n")
        print(f"shuffle exchanges: {exchanges}, broadcast exchanges: {tree.count('BroadcastExchange')}\n")
        print("```\n" + tree.strip("\n") + "\n```\n")
        if notes:
            print("```\n" + "\n".join(dict.fromkeys(notes)) + "\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
