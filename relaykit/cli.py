"""Command line: the run modes of a reporting job, as Spark jobs.

    python -m relaykit.cli once     --root ROOT --out OUT [--date D]
    python -m relaykit.cli retry    --root ROOT --out OUT [--date D]
    python -m relaykit.cli backfill --root ROOT --out OUT --start D1 --end D2
    python -m relaykit.cli stats    --root ROOT [--date D]

``ROOT/<table>/dt=YYYY-MM-DD/*.parquet`` holds the reported tables. Without
``--date`` the run takes yesterday (session time zone). ``retry`` is the same
job as ``once``: outputs of the date are overwritten. All tables and dates
run as one Spark job; there is no per-table or per-date loop. Tables without
an ``event_id`` get a key from a hash of the row. Options given here win over
the settings file.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import audit
from .plans.report_run import ReportRun, RunConfig, parse_overrides
from .registry import REGISTRY, parse_table_list
from .session import build_session, ensure_conf
from .sources.tables import date_range, has_column, read_partitioned, with_row_key

DEFAULT_TABLES = ",".join(REGISTRY.names())


def yesterday(spark: SparkSession) -> str:
    return spark.range(1).select(F.date_format(F.date_sub(F.current_date(), 1), "yyyy-MM-dd")).first()[0]


def days(start: str, end: str) -> list[str]:
    """The dates from ``start`` to ``end``, both included."""
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    return [str(first + timedelta(i)) for i in range((last - first).days + 1)]


def asked(dates) -> list[str]:
    """The dates named one by one (none for a condition on ``dt``)."""
    return [dates] if isinstance(dates, str) else [] if isinstance(dates, Column) or dates is None else list(dates)


def open_tables(spark: SparkSession, root: str, names: list[str], dates, key: str | None = None) -> dict[str, DataFrame]:
    """The tables' rows of the dates. With ``key``, rows of tables without that
    column get it from a hash."""
    out = {}
    for n in names:
        spec = REGISTRY.get(n)
        if spec is None:
            raise ValueError(f"Unknown table name: {n}")
        path = f"{root.rstrip('/')}/{n}"
        keyed = key is not None and has_column(spark, path, key)
        df = read_partitioned(spark, path, spec, dates, key if keyed else None)
        out[n] = df if keyed or key is None else with_row_key(df, key)
    return out


def run_report(spark: SparkSession, root: str, out: str, dates, tables: str = DEFAULT_TABLES,
               batch_size: int = 20, modes: dict[str, str] | None = None, run_id: str | None = None,
               ingest_ms: int | None = None, attempt_log: str | None = None, page_size: int = 1000,
               max_attempts: int = 3, zero_dates: Sequence[str] = ()) -> DataFrame:
    """Plan the given dates of all tables and write the outbox, members,
    dead letters and table results; with ``attempt_log`` (the transport's
    log, parquet) outcomes are accounted, otherwise requests count as unsent.
    Returns the per-date summary; dates named one by one or in ``zero_dates``
    are in it even without rows."""
    names = parse_table_list(tables)
    key = RunConfig.key
    cfg = RunConfig(run_id=run_id or "run", batch_size=batch_size, page_size=page_size, max_attempts=max_attempts,
                    mode_overrides=parse_overrides(modes or {}), ingest_ms=ingest_ms,
                    unique_key=all(has_column(spark, f"{root.rstrip('/')}/{n}", key) for n in names),
                    dates=[*asked(dates), *zero_dates])
    run = ReportRun(spark, open_tables(spark, root, names, dates, key), cfg, cache=True)
    if attempt_log:
        run.use_attempts(spark.read.parquet(attempt_log))
    run.write(out)
    return run.summary


def stats(spark: SparkSession, root: str, dates, tables: str = DEFAULT_TABLES) -> DataFrame:
    names = parse_table_list(tables)
    return audit.stats_by_date(open_tables(spark, root, names, dates), names, asked(dates))


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="relaykit")
    p.add_argument("mode", choices=["once", "retry", "backfill", "stats"])
    p.add_argument("--root", required=True)
    p.add_argument("--out")
    p.add_argument("--date")
    p.add_argument("--start")
    p.add_argument("--end")
    p.add_argument("--tables", default=None)
    p.add_argument("--batch-size", type=int, default=None)
    p.add_argument("--page-size", type=int, default=None)
    p.add_argument("--run-id", default=None)
    p.add_argument("--ingest-ms", type=int, default=None, help="processing time; default: now")
    p.add_argument("--mode-override", action="append", default=[], help="table=SINGLE|BATCH")
    p.add_argument("--attempt-log", default=None, help="parquet attempt log of a delivery")
    p.add_argument("--properties", default=None, help="key=value settings file (event.tables, ...)")
    p.add_argument("--master", default=None)
    a = p.parse_args(argv)
    spark = build_session(master=a.master) if a.master else SparkSession.builder.getOrCreate()
    ensure_conf(spark)
    if a.mode == "backfill":
        if not (a.start and a.end):
            p.error("backfill needs --start and --end")
        dates, zero = date_range(a.start, a.end), days(a.start, a.end)
    else:
        zero = []
        dates = a.date or yesterday(spark)
    if a.mode == "stats":
        for r in stats(spark, a.root, dates, a.tables or DEFAULT_TABLES).orderBy("dt", "ordinal").collect():
            print(f"{r.dt} {r.line}")
        return 0
    if not a.out:
        p.error("--out is required")
    modes = dict(x.split("=", 1) for x in a.mode_override)
    from_file = {"tables": DEFAULT_TABLES}
    if a.properties:
        from .config import load_settings
        st = load_settings(a.properties)
        from_file = {"tables": ",".join(st.tables), "batch_size": st.run.batch_size, "page_size": st.run.page_size,
                     "max_attempts": st.max_retry_count}
        modes = {**st.run.mode_overrides, **modes}
    given = {k: v for k, v in {"tables": a.tables, "batch_size": a.batch_size, "page_size": a.page_size}.items() if v is not None}
    summary = run_report(spark, a.root, a.out, dates, modes=modes, run_id=a.run_id, ingest_ms=a.ingest_ms,
                         attempt_log=a.attempt_log, zero_dates=zero, **{**from_file, **given})
    for r in summary.where(F.col("level") == "date").orderBy("dt").collect():
        print(f"{r.dt} {r.line}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
