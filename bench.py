"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_RUNS     runs per query, the best one counts (default 2)
    BENCH_COMPARE  1 to also time each query's SQL in DuckDB on the same cores
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

HEADLINE = (
    "stg_entities",
    "dedupe",
    "tag_bridge",
    "dimension",
    "class_summary",
    "share_of_class",
    "pairwise_corr",
    "coverage",
    "pair_lift",
    "quantiles",
    "quantiles_by_flag",
    "summary_by_priority",
    "format_variants",
    "profile_columns",
    "dedupe_lineitem",
    "duplicate_groups",
    "dedupe_documents",
    "extract_numbers_documents",
    "corr_lineitem",
    "bands_quantity",
    "scd2",
    "heatmap_grid",
    "tag_stats",
    "check_suite",
)


def best(run, runs):
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    from catalog import all_queries, all_sql
    from siltstone.session import build_session

    spark = build_session(
        f"local[{cpus}]", "siltstone-bench",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    builds = all_queries()
    names = [n for n in sys.argv[1:] if n in builds] or [n for n in HEADLINE if n in builds]

    def run(name):
        builds[name](spark, sf).write.format("noop").mode("overwrite").save()

    run("class_summary")
    times = {name: best(lambda n=name: run(n), runs) for name in names}
    line = {
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf, "cpus": int(cpus),
    }
    if os.environ.get("BENCH_COMPARE") == "1":
        from tools.compare import connect

        con, sql = connect(sf), all_sql()
        con.execute(f"set threads to {cpus}")
        line["duckdb"] = {n: best(lambda n=n: con.execute(sql[n]).fetchall(), runs) for n in names if n in sql}
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
