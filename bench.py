"""Times the operators and whole intakes; prints one JSON line.

BENCH_SF_DIR   folder of the given tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_ONLY     comma-separated name prefixes, to time a part
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators.measure import measure_files
from quayside.session import local_session, new_folder
from standins import delivery
from standins.delivery import Delivery
from standins.frames import table
from standins.operators import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ONLY = tuple(p for p in os.environ.get("BENCH_ONLY", "").split(",") if p)

# name, table, stamp of a row's file: many small files, monthly files, one large file
DELIVERIES = {
    "hourly_events": ("events", "date_format(date_add('2000-01-01', datediff(ts, '2024-01-01') * 24 + hour(ts)), 'yyyyMMdd')"),
    "monthly_lineitem": ("lineitem", "date_format(trunc(l_shipdate, 'month'), 'yyyyMMdd')"),
    "single_lineitem": ("lineitem", "'20240101'"),
    "quoted_documents": ("documents", "'20240101'"),
}


# deliveries, loads and what is read back of them, as one time
WHOLE_RUNS = {
    "load_latest_view": delivery.latest_orders,
    "load_with_errors": delivery.with_errors,
    "load_rerun": delivery.rerun,
    "probe_orders": delivery.probed_orders,
}


def wanted(name: str) -> bool:
    return not ONLY or name.startswith(ONLY)


def finish(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS, app="quayside-bench")
    times: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)

    finish(table(spark, SF_DIR, "region"))
    for name, query in QUERIES.items():
        if wanted(name):
            timed(name, lambda query=query: finish(query(spark, SF_DIR)))

    for name, query in WHOLE_RUNS.items():
        if wanted(name):
            timed(name, lambda query=query: finish(query(spark, SF_DIR)))

    for name, (source, stamp) in DELIVERIES.items():
        if not wanted(name):
            continue
        landing = Delivery(spark)
        landing.put(source.upper(), table(spark, SF_DIR, source), F.expr(stamp), quote_all=source == "documents")
        landing.announce()
        paths = landing.landed()
        timed(f"{name}_measure", lambda: finish(measure_files(spark, paths, new_folder(spark, "bench"))[0]))
        result = {}
        timed(f"{name}_load", lambda: result.update(landing.load().first().asDict()))
        if result["files_loaded"] != len(paths):
            raise RuntimeError(f"{name}: {result} of {len(paths)} files")
        timed(f"{name}_summary", lambda: finish(landing.store.load_summary()))

    print(
        json.dumps(
            {
                "metric": "total time of all operators and intakes",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
