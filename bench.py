"""Times the headline queries beside DuckDB running their oracles; prints one JSON line.

BENCH_SF_DIR names the data, BENCH_CPUS the cores, BENCH_QUERIES (comma-separated, or ``all``) a
selection; BENCH_WARM=0 skips the warm-up run of each query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import duckdb  # noqa: E402

from checks.registry import all_checks  # noqa: E402
from tickloom.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# One or more of every family; the rest runs with BENCH_QUERIES=all.
HEADLINE = (
    "basic_info summary daily_range industry_list risk_summary daily_basic technical_rolling "
    "technical_all fundamentals_positional fundamentals_calendar asof_statement valuation "
    "valuation_point_in_time northbound_sums margin_changes quotes holder_changes statements_sina "
    "merge_overwrite merge_sources keep_last flow_identities calendar_gaps turnover_reconciled "
    "null_profile stored_watermarks stream_running_bars coverage stock_detail completeness update_twice"
).split()


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    asked = os.environ.get("BENCH_QUERIES", "")
    warm = os.environ.get("BENCH_WARM", "1") != "0"
    checks = all_checks()
    names = list(checks) if asked == "all" else [q for q in asked.split(",") if q] or HEADLINE

    spark = local_session("bench", cpus, shuffle_partitions=cpus)
    duck = duckdb.connect()
    duck.execute(f"SET threads = {cpus}")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")

    spark_times, duck_times, failed = {}, {}, {}
    for name in names:
        check = checks[name]

        def run():
            check.query(spark, sf_dir).write.format("noop").mode("overwrite").save()

        try:
            if warm:
                run()
            spark_times[name] = timed(run)
            if check.oracle is not None:
                duck_times[name] = timed(lambda: duck.execute(check.oracle).fetchall())
        except Exception as error:  # a failing query must not hide the others' times
            failed[name] = str(error).splitlines()[0][:200]
        print(name, spark_times.get(name), duck_times.get(name), file=sys.stderr, flush=True)

    result = {
        "metric": "total wall time of the queries, each after one warm-up",
        "value": round(sum(spark_times.values()), 3),
        "unit": "sec",
        "queries": spark_times,
        "duckdb": duck_times,
        "duckdb_total": round(sum(duck_times.values()), 3),
        "sf": sf_dir.rsplit("sf", 1)[-1],
        "cpus": cpus,
    }
    if failed:
        result["failed"] = failed
    print(json.dumps(result))


if __name__ == "__main__":
    main()
