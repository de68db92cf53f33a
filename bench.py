"""Timings of the headline operations; prints one JSON line.

    BENCH_SF_DIR  folder of the given tables       (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores                      (default 8)
    BENCH_ROWS    generate this many base rows instead of reading orders, for scale runs
    BENCH_RUNS    runs of each repeatable query, of which the median counts (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from datetime import date, timedelta

from pyspark.sql import functions as F

from tidemark.functions.dates import lookback_window
from tidemark.operators import profile as pf
from tidemark.operators import reconcile as rc
from tidemark.operators.expand import expand
from tidemark.operators.settle import settle
from tidemark.operators.sink import full_load
from tidemark.plans.rebuild import rebuild, rebuild_dates
from tidemark.plans.strategies import compare_strategies
from tidemark.session import build_session, shared_folder
from tidemark.sources.generated import generated_shipments
from tidemark.sources.orders import base_shipments, read_orders
from tidemark.sources.tables import shipments

AS_OF = date(2001, 8, 2)
LAST_NIGHT = AS_OF - timedelta(days=1)
WINDOW = lookback_window(AS_OF)


def default_memory() -> str:
    """Half of the machine's memory, at most 20 GB."""
    total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") >> 30
    return f"{max(2, min(20, total // 2))}g"


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    generated_rows = int(os.environ.get("BENCH_ROWS", "0"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    settings = {
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", default_memory()),
        "spark.driver.host": "127.0.0.1",
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(4 * int(cpus)),
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tidemark-bench-"),
        # One machine: enough write tasks for its cores, and no listing task per date.
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m" if generated_rows else "4m",
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": cpus,
    }
    spark = build_session("tidemark-bench", f"local[{cpus}]", settings)
    spark.sparkContext.setLogLevel("ERROR")
    shared_folder(spark)

    if generated_rows:
        base = generated_shipments(spark, generated_rows, AS_OF)
    else:
        base = base_shipments(read_orders(spark, folder))
    offset = F.greatest(F.lit(5_000_000).cast("bigint"), base.agg(F.max("shipment_id")).scalar() + 1)
    expanded = expand(base, id_offset=offset)
    source = settle(expanded, AS_OF)
    timings: dict[str, float] = {}

    def timed(name, action, times=runs):
        taken = []
        for _ in range(times):
            start = time.perf_counter()
            action()
            taken.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(taken), 3)
        print(f"{name}: {timings[name]}", file=sys.stderr, flush=True)

    def consumed(df):
        """Computes every column of every row and stores nothing."""
        return lambda: df.write.format("noop").mode("overwrite").save()

    timed("base_rows", consumed(base))
    timed("expand_copies", consumed(expanded))
    timed("expand_and_settle", consumed(source))
    # The table stands as it did last night.
    table = "bench_shipments"
    timed("full_load", lambda: full_load(settle(expanded, LAST_NIGHT), table), times=1)
    sink = shipments(spark, table)
    timed("table_overview", consumed(pf.table_overview(sink)))
    timed("status_breakdown", consumed(pf.status_breakdown(sink)))
    timed("carrier_profile", consumed(pf.carrier_profile(sink)))
    timed("recent_dates_top10", consumed(pf.recent_dates(sink)))
    timed("per_date_profile", consumed(pf.per_date_profile(sink, WINDOW)))
    # Both rebuilds read a stored source, laid out by date; writing it is not timed.
    full_load(source, "bench_source")
    source = shipments(spark, "bench_source")
    timed("rebuild_window", lambda: rebuild(source, table, AS_OF, clustered=True).check())
    timed("rebuild_one_date", lambda: rebuild_dates(source, table, [WINDOW.last], clustered=True).check())

    def compare(deep):
        current = shipments(spark, table)
        profiles = [pf.per_date_profile(side, WINDOW, checksums=deep) for side in (source, current)]
        return (rc.deep_reconcile if deep else rc.reconcile)(*profiles)

    timed("reconcile", lambda: rc.verdict(compare(False)).collect())
    timed("deep_reconcile", lambda: rc.verdict(compare(True)).collect())
    old = settle(base.filter(F.col("shipment_date") < F.lit(WINDOW.last)), LAST_NIGHT)
    timed("strategy_comparison", consumed(compare_strategies(old, settle(base, AS_OF), WINDOW)))

    verdict = rc.verdict(compare(True)).first()["verdict"]
    if verdict != "ALL_PASSED":
        raise SystemExit(f"the rebuilt window does not match its source: {verdict}")
    rows = pf.version_counts(shipments(spark, table)).first()["total_rows"]
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of query times",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": "generated" if generated_rows else folder.rstrip("/").split("/sf")[-1],
                "table_rows": rows,
            }
        )
    )


if __name__ == "__main__":
    main()
