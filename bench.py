"""Time the registered jobs: one warm-up, then the median of BENCH_RUNS runs of each.

Prints one JSON line.  BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS and BENCH_ONLY (comma-separated job
names) select folder, cores, repetitions and jobs; ``--duckdb`` times the SQL checks instead.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
ONLY = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]


def median_time(action) -> float:
    action()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 4)


def spark_times() -> dict[str, float]:
    from factdim.plans.jobs import JOBS
    from factdim.session import build_session

    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        {
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            "spark.sql.warehouse.dir": "/tmp/factdim-bench-warehouse",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name, job in JOBS.items():
        if ONLY and name not in ONLY:
            continue
        times[name] = median_time(
            lambda job=job: job(spark, FOLDER).write.format("noop").mode("overwrite").save()
        )
        print(f"{name}: {times[name]}", file=sys.stderr)
    spark.stop()
    return times


def duckdb_times() -> dict[str, float]:
    import duckdb

    from factdim.plans.checks import CHECKS

    con = duckdb.connect(config={"threads": int(CPUS)})
    for file in sorted(os.listdir(FOLDER)):
        if file.endswith(".parquet"):
            name = file.removesuffix(".parquet")
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{file}'")
    return {
        name: median_time(lambda sql=sql: con.execute(sql).fetchall())
        for name, sql in CHECKS.items()
        if not ONLY or name in ONLY
    }


def main() -> None:
    times = duckdb_times() if "--duckdb" in sys.argv else spark_times()
    print(
        json.dumps(
            {
                "metric": "total of median seconds per job",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
