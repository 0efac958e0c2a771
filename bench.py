"""Benchmark: headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``.

Each query is planned and fully executed into Spark's ``noop`` sink (no
collect to the driver); the time covers planning plus execution. The JVM is
warmed up first on the smallest data set (untimed). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from relaykit.plans import catalog  # noqa: E402
from relaykit.session import build_session  # noqa: E402

HEADLINE = [
    "outbox_all",            # scan → payload JSON → ordinals/batches → outbox (all tables, all dates)
    "stats_by_date",         # counts for all tables and dates in one job
    "request_plan",          # call plan from counts
    "record_outcomes",       # attempt log → outcomes → per-record result
    "dead_letters",          # failed rows with masked ids and record JSON
    "run_summary",           # per table/date/all totals
    "failure_rate_window",   # trailing 10-call failure rate
    "status_apply",          # status log → current state of tracked rows
    "mask_json",             # secret redaction over documents
    "mask_url",              # URL masking over pages
    "failed_log_parse",      # failed-records log → rows
]


def request_checks(spark, sf_dir: str) -> dict:
    """Request counts must equal the plan: outbox rows = Σ best-case calls
    at this scale, and 1000 rows give 1000 SINGLE calls or 50 BATCH of 20."""
    from pyspark.sql import functions as F

    from relaykit.operators.batching import request_plan
    run = catalog._run(spark, sf_dir)
    outbox_n = run.outbox.count()
    planned = run.plan.agg(F.sum("best_calls")).first()[0]
    thousand = spark.createDataFrame([("s", "d", 1000), ("b", "d", 1000)], "table_name string, dt string, n long")
    modes = spark.createDataFrame([("s", "SINGLE"), ("b", "BATCH")], "table_name string, mode string")
    calls = {r.table_name: r.best_calls for r in request_plan(thousand, modes, 20).collect()}
    return {"outbox_requests": outbox_n, "planned_requests": int(planned),
            "requests_match_plan": outbox_n == planned,
            "thousand_rows_single_calls": calls["s"], "thousand_rows_batch_calls": calls["b"]}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    # warm-up (not timed): the same queries once on the smallest data set, so
    # JIT and generated-code caches are warm and timings are steady state
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for name in HEADLINE:
            catalog.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        df = catalog.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    n_events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    checks = request_checks(spark, sf_dir)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "headline_total_sec",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "records": n_events,
        "outbox_records_per_sec": round(n_events / times["outbox_all"], 1) if times["outbox_all"] else None,
        "checks": checks,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
