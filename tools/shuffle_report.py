"""Bytes shuffled per step, from Spark's event log.

Usage: python tools/shuffle_report.py [sf_dir]

Runs each step in its own job group with the event log written to a fresh
scratch folder, then sums the task metrics of every stage per group:
shuffle bytes written and the number of stages. Prints a Markdown table
(appended to PLANS.md by hand).
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from innkeep.operators import fingerprint_index as index  # noqa: E402
from innkeep.operators.bronze import load_csv, read_bronze  # noqa: E402
from innkeep.operators.silver import build_silver, first_per_fingerprint, has_repeated  # noqa: E402
from innkeep.plans import datasets as D  # noqa: E402
from innkeep.plans.catalog import all_queries  # noqa: E402
from innkeep.session import get_session, staging_path  # noqa: E402
from innkeep.sources.tables import SILVER_PARTITIONING, write_layer  # noqa: E402
from innkeep.sources.versioned import VersionedTable  # noqa: E402

QUERIES = ["popular_countries", "mom_growth", "kpi_summary", "numeric_summary", "null_profile", "dq_report"]


def steps(spark, sf: str):
    """(name, thunk) pairs; each thunk runs one step to completion."""
    qs = all_queries()
    bronze = staging_path(spark, "shuffle-bronze")
    extract = D.csv_extract(spark, sf)
    D.silver_table(spark, sf)
    out = [("load_csv (empty bronze)", lambda: load_csv(spark, extract, bronze, min_rows=1))]
    out.append(("load_csv again (all rows stored)", lambda: load_csv(spark, extract, bronze, min_rows=1)))

    def silver(dedup):
        target = staging_path(spark, "shuffle-silver")
        return lambda: write_layer(build_silver(read_bronze(spark, bronze), dedup=dedup), target, partition_by=SILVER_PARTITIONING)

    out.append(("has_repeated alone", lambda: has_repeated(read_bronze(spark, bronze))))
    out.append(("silver written from bronze, dedup=auto", silver("auto")))
    out.append(("silver written from bronze, dedup=True", silver(True)))

    def insert():
        table = VersionedTable(spark, bronze)
        segments = index.segments_of(table.latest())
        index.absent(table, segments, first_per_fingerprint(D.landing(spark, sf)), D.landing(spark, sf)).write.format("noop").mode("overwrite").save()

    out.append(("insert-if-absent, all rows stored", insert))
    for q in QUERIES:
        out.append((q, lambda q=q: qs[q](spark, sf).collect()))
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="innkeep-events-", dir="/tmp")
    spark = get_session(
        "local[8]",
        app_name="innkeep-shuffle-report",
        shuffle_partitions=16,
        extra_conf={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
        },
    )
    sc = spark.sparkContext
    names = []
    for name, run in steps(spark, sf):
        sc.setJobGroup(name, name)
        run()
        names.append(name)
    spark.stop()

    stage_group: dict[int, str] = {}
    totals = {n: {"shuffle": 0, "stages": set()} for n in names}
    (path,) = glob.glob(os.path.join(log_dir, "*"))
    with open(path) as f:
        events = [json.loads(line) for line in f]
    for e in events:
        if e["Event"] == "SparkListenerJobStart":
            group = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in e.get("Stage IDs", []):
                if group in totals:
                    stage_group[sid] = group
    for e in events:
        if e["Event"] != "SparkListenerTaskEnd" or e["Stage ID"] not in stage_group:
            continue
        m = e.get("Task Metrics") or {}
        t = totals[stage_group[e["Stage ID"]]]
        t["shuffle"] += m.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
        t["stages"].add(e["Stage ID"])

    def mb(b: int) -> str:
        return f"{b / 2**20:.2f}"

    print(f"| step ({os.path.basename(sf)}) | shuffle written MB | stages run |")
    print("|---|---|---|")
    for n in names:
        t = totals[n]
        print(f"| {n} | {mb(t['shuffle'])} | {len(t['stages'])} |")


if __name__ == "__main__":
    main()
