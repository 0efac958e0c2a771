"""Named queries over the driver's test tables (Spark side).

Each entry is ``(spark, sf_dir) -> DataFrame`` and reads the whole tables it
needs. The matching DuckDB SQL lives in ``oracle_sql.py`` at the repo root.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonfn, masking
from ..functions.coercion import to_long
from ..operators import audit, dedupe, delivered, delivery, transform
from ..operators import compaction
from ..operators import status_log as sl
from ..operators.delivery import failure_rate_window as _failure_rate_window
from ..operators.delivery import partial_errors as _partial_errors
from ..operators.ordinal import with_ordinal
from ..registry import REGISTRY, Registry, TableSpec, parse_mode, validate_tables
from ..session import ensure_conf, session_key
from ..sources import footers, logs
from ..sources.tables import (EVENT_TYPE_OF, date_range, driver_table, driver_tables, events_base,
                              events_view, load, read_partitioned, tables_from_events, tracked_rows,
                              tracked_tables, with_row_key)
from ..streaming import outcomes as stream_outcomes
from ..streaming import runner
from ..streaming import status as stream_status
from . import isolated, metrics, resend
from .report_run import (DEFAULT_INGEST_MS, ReportRun, RunConfig, failed_records_file,
                         run_log)

Query = Callable[[SparkSession, str], DataFrame]
TABLES = REGISTRY.names()
SCAN_DATE = "2024-01-15"


def _tables(spark: SparkSession, sf_dir: str, gran: str = "day") -> dict[str, DataFrame]:
    ensure_conf(spark)
    return driver_tables(spark, sf_dir, gran)


_RUNS: dict[tuple, ReportRun] = {}


def _run(spark: SparkSession, sf_dir: str, gran: str = "day", **cfg) -> ReportRun:
    """The report run over the driver tables; one planned (and, once
    executed, cached) run per session, data dir and configuration, shared
    by every query that looks at a part of it."""
    reject = cfg.pop("reject_if", None)
    key = (session_key(spark), sf_dir, gran, reject is not None,
           tuple(sorted((k, str(v)) for k, v in cfg.items())))
    if key not in _RUNS:
        _RUNS[key] = ReportRun(spark, _tables(spark, sf_dir, gran), RunConfig(ingest_ms=DEFAULT_INGEST_MS, **cfg),
                               reject_if=reject, cache=True, scripted_attempts=True)
    return _RUNS[key]


# -- payloads ---------------------------------------------------------------

def payload_json_q(name: str) -> Query:
    def q(spark, sf_dir):
        spec = REGISTRY.get(name)
        df = transform.project(driver_table(spark, sf_dir, name), spec)
        return transform.to_payloads(df, spec, DEFAULT_INGEST_MS).select("event_id", "dt", "body")
    return q


def payload_q(name: str) -> Query:
    def q(spark, sf_dir):
        spec = REGISTRY.get(name)
        df = transform.project(driver_table(spark, sf_dir, name), spec)
        p = transform.to_payloads(df, spec, DEFAULT_INGEST_MS)
        ev = F.col("payload.events")[0]
        return p.select("event_id", "dt", F.col("payload.user.user_unique_id").alias("user_unique_id"),
                        ev["event"].alias("event"), ev["params"].alias("params"),
                        ev["local_time_ms"].alias("local_time_ms"))
    return q


def registry_projection(spark, sf_dir):
    spec = REGISTRY.get("pay_result")
    return transform.project(driver_table(spark, sf_dir, "pay_result"), spec)


def scan_partition(spark, sf_dir):
    """One date partition of one table, projected (A1)."""
    spec = REGISTRY.get("element_click")
    df = driver_table(spark, sf_dir, "element_click").where(F.col("dt") == SCAN_DATE)
    return transform.project(df, spec)


def event_time_fallback(spark, sf_dir):
    p = _run(spark, sf_dir).payloads
    return p.select("table_name", "event_id", "local_time_ms",
                    (F.col("local_time_ms") == F.lit(DEFAULT_INGEST_MS)).alias("used_ingest_time"))


# -- counts and statistics -------------------------------------------------

def partition_count(spark, sf_dir):
    return audit.partition_counts(_tables(spark, sf_dir))


def stats_by_date(spark, sf_dir):
    return audit.stats_by_date(_tables(spark, sf_dir), TABLES).select("dt", "table_name", "n", "ordinal")


EMPTY_DATE = "1999-12-31"


def stats_empty_date(spark, sf_dir):
    """Statistics of a date without any row, among those with rows."""
    return audit.stats_by_date(_tables(spark, sf_dir), TABLES, [EMPTY_DATE, SCAN_DATE]) \
                .select("dt", "table_name", "n", "line")


def stats_report_lines(spark, sf_dir):
    return audit.stats_by_date(_tables(spark, sf_dir), TABLES).select("dt", "ordinal", "line")


# -- batching and the outbox -------------------------------------------------

def _short_id():
    """Rows treated as failed transforms in the error-path queries."""
    return {t: ~F.col("user_unique_id").startswith("user_") for t in TABLES}


def batch_assignment(spark, sf_dir):
    a = _run(spark, sf_dir).assigned
    return a.where(F.col("mode") == "BATCH").select("table_name", "dt", "event_id", "ord",
                                                    F.col("request_no").alias("batch_no"))


def page_batch_assignment(spark, sf_dir):
    a = _run(spark, sf_dir, "month", batch_size=30).assigned
    return a.where(F.col("mode") == "BATCH").select("table_name", "dt", "event_id", "ord", "page_no",
                                                    F.col("request_no").alias("batch_no"))


def batch_after_errors(spark, sf_dir):
    a = _run(spark, sf_dir, "month", batch_size=30, reject_if=_short_id()).assigned
    return a.select("table_name", "dt", "event_id", "ord", "page_no", "mode", "request_no", "error")


def request_plan(spark, sf_dir):
    return _run(spark, sf_dir, "month", batch_size=30).plan


def mode_resolution(spark, sf_dir):
    overrides = {"pay": " batch ", "element_click": "Single", "no_such_table": "SINGLE", "user_info": "x"}
    return _run(spark, sf_dir, mode_overrides=overrides).plan.select("table_name", "dt", "mode", "best_calls")


def page_slice(spark, sf_dir):
    """The second 1000-row page (key order) of every (table, month) partition."""
    keys = _run(spark, sf_dir, "month").payloads.select("table_name", "dt", "event_id")
    o = with_ordinal(keys, ["table_name", "dt"], "event_id", "ord")
    return o.where(F.floor(F.col("ord") / 1000) == 1).select("table_name", "dt", "event_id", "ord")


def outbox_single(spark, sf_dir):
    return _run(spark, sf_dir).outbox.where(F.col("endpoint") == "/v2/event/json")


def outbox_batch(spark, sf_dir):
    return _run(spark, sf_dir).outbox.where(F.col("endpoint") == "/v2/event/list")


def outbox_all(spark, sf_dir):
    return _run(spark, sf_dir).outbox


def outbox_keyless(spark, sf_dir):
    """Tables without a row id: the bodies of every table, date and endpoint
    with their number, and the size of every request."""
    tables = {n: with_row_key(df.drop("event_id")) for n, df in _tables(spark, sf_dir).items()}
    run = ReportRun(spark, tables, RunConfig(ingest_ms=DEFAULT_INGEST_MS, unique_key=False))
    bodies = run.assigned.groupBy("table_name", "dt", "endpoint", "body").agg(F.count(F.lit(1)).alias("n"))
    sizes = run.outbox.select("table_name", "dt", "endpoint", "request_no", F.col("n_records").cast("long").alias("n"))
    return bodies.unionByName(sizes, allowMissingColumns=True).select("table_name", "dt", "endpoint", "request_no", "body", "n")


def transform_errors(spark, sf_dir):
    p = _run(spark, sf_dir, reject_if=_short_id()).payloads
    return p.where(F.col("error").isNotNull()).select("table_name", "dt", "event_id", "error")


# -- delivery and outcomes -----------------------------------------------------

def attempt_classify(spark, sf_dir):
    c = _run(spark, sf_dir).classified
    return c.select("table_name", "dt", "request_no", "attempt", "http_status", "ok", "error")


def response_parse(spark, sf_dir):
    c = _run(spark, sf_dir).classified  # without a body there are no counts
    r = F.col("response")
    return c.select("table_name", "dt", "request_no", "attempt", r["e"].alias("e"),
                    r["message"].alias("message"), r["sc"].alias("sc"), r["ec"].alias("ec"))


def _outcome_cols(df):
    return df.select("table_name", "dt", "request_no", "mode", "success", "ok_attempt",
                     "attempts_used", "duration_ms", "reason")


def single_outcome(spark, sf_dir):
    return _outcome_cols(_run(spark, sf_dir).outcome.where(F.col("mode") == "SINGLE"))


def batch_outcome(spark, sf_dir):
    return _outcome_cols(_run(spark, sf_dir).outcome.where(F.col("mode") == "BATCH"))


def interrupted_requests(spark, sf_dir):
    return _outcome_cols(_run(spark, sf_dir).outcome.where(F.col("reason") == "Retry interrupted"))


def recovered_requests(spark, sf_dir):
    return _outcome_cols(_run(spark, sf_dir).outcome.where(F.col("ok_attempt") > 1))


def record_outcomes(spark, sf_dir):
    r = _run(spark, sf_dir, reject_if=_short_id()).record_outcomes
    return r.select("table_name", "dt", "event_id", "request_no", "status", "reason", "attempts_used")


def failure_rate_window(spark, sf_dir):
    return _failure_rate_window(_run(spark, sf_dir).classified)


def partial_errors(spark, sf_dir):
    return _partial_errors(_run(spark, sf_dir).classified)


def dead_letters(spark, sf_dir):
    d = _run(spark, sf_dir, reject_if=_short_id()).dead_letters
    return d.select("run_id", "table_name", "dt", "user_masked", "reason", "record_json")


def dead_letter_counts(spark, sf_dir):
    return audit.dead_letter_counts(_run(spark, sf_dir, reject_if=_short_id()).dead_letters)


def table_result(spark, sf_dir):
    return _run(spark, sf_dir, reject_if=_short_id()).table_results


def run_summary(spark, sf_dir):
    return _run(spark, sf_dir, reject_if=_short_id()).summary


def metrics_summary(spark, sf_dir):
    run = _run(spark, sf_dir)
    return audit.metrics_summary(run.record_outcomes, run.outcome, _failure_rate_window(run.classified))


def processing_rate(spark, sf_dir):
    return audit.processing_rate(_run(spark, sf_dir).classified)


def attempt_success_rate(spark, sf_dir):
    return audit.attempt_success_rate(_run(spark, sf_dir).classified)


def retry_histogram(spark, sf_dir):
    return audit.retry_histogram(_run(spark, sf_dir).outcome)


QUERIES: dict[str, Query] = {}
for _t in TABLES:
    QUERIES[f"payload_json_{_t}"] = payload_json_q(_t)
    QUERIES[f"payload_{_t}"] = payload_q(_t)
QUERIES.update({
    "registry_projection": registry_projection,
    "scan_partition": scan_partition,
    "event_time_fallback": event_time_fallback,
    "partition_count": partition_count,
    "stats_by_date": stats_by_date,
    "stats_report_lines": stats_report_lines,
    "stats_empty_date": stats_empty_date,
    "batch_assignment": batch_assignment,
    "page_batch_assignment": page_batch_assignment,
    "batch_after_errors": batch_after_errors,
    "request_plan": request_plan,
    "mode_resolution": mode_resolution,
    "page_slice": page_slice,
    "outbox_single": outbox_single,
    "outbox_batch": outbox_batch,
    "outbox_all": outbox_all,
    "outbox_keyless": outbox_keyless,
    "transform_errors": transform_errors,
    "attempt_classify": attempt_classify,
    "response_parse": response_parse,
    "single_outcome": single_outcome,
    "batch_outcome": batch_outcome,
    "interrupted_requests": interrupted_requests,
    "recovered_requests": recovered_requests,
    "record_outcomes": record_outcomes,
    "failure_rate_window": failure_rate_window,
    "partial_errors": partial_errors,
    "dead_letters": dead_letters,
    "dead_letter_counts": dead_letter_counts,
    "table_result": table_result,
    "run_summary": run_summary,
    "metrics_summary": metrics_summary,
    "processing_rate": processing_rate,
    "attempt_success_rate": attempt_success_rate,
    "retry_histogram": retry_histogram,
})


# -- status-tracked tables (orders viewed as tracked rows) ----------------------


RUN_TIME = "2024-02-01 00:00:00"


def _tracked(spark, sf_dir):
    ensure_conf(spark)
    return tracked_rows(spark, sf_dir)


def _g1_log(spark, sf_dir):
    """One incremental pass: every pending row is marked Processing, then Success, or Failed with an error (every 7th)."""
    page = _tracked(spark, sf_dir).where((F.col("id") > 0) & (F.col("report_status") == sl.PENDING)).select("table_name", "id")
    t0 = F.to_timestamp(F.lit(RUN_TIME))
    started = sl.status_changes(page, sl.PROCESSING, 1, t0)
    ok = sl.status_changes(page.where(F.col("id") % 7 != 0), sl.SUCCESS, 2, t0 + F.expr("interval 1 minute"))
    bad = sl.status_changes(page.where(F.col("id") % 7 == 0), sl.FAILED, 2, t0 + F.expr("interval 1 minute"),
                            error=F.concat(F.lit("HTTP 503: "), F.repeat(F.lit("server busy "), 50)),
                            bump_retry=True)
    return started.unionByName(ok).unionByName(bad)


def status_decode(spark, sf_dir):
    d = sl.decode_status(_tracked(spark, sf_dir), "report_status", sl.status_dim(spark))
    return d.select("table_name", "id", "report_status", "description", "is_valid")


def status_invalid(spark, sf_dir):
    o = _tracked(spark, sf_dir).withColumn("code", ((F.col("id") % 7) - 1).cast("int"))
    d = sl.decode_status(o, "code", sl.status_dim(spark))
    return d.where(~F.col("is_valid")).select("table_name", "id", "code")


def pending_keyset_scan(spark, sf_dir):
    return sl.pending_scan(_tracked(spark, sf_dir), 1000, 500).select("table_name", "id", "user_unique_id")


def retryable_scan(spark, sf_dir):
    return sl.retryable_scan(_tracked(spark, sf_dir), 4, 500).select("table_name", "id", "retry_count")


def pending_count(spark, sf_dir):
    return sl.count_by_status(_tracked(spark, sf_dir), sl.PENDING)


def pending_counts_all(spark, sf_dir):
    return sl.counts_with_total(_tracked(spark, sf_dir), TABLES, sl.PENDING)


def pending_nonzero(spark, sf_dir):
    return sl.count_by_status(_tracked(spark, sf_dir), sl.PENDING).where(F.col("n") > 0)


def status_histogram(spark, sf_dir):
    return sl.status_histogram(_tracked(spark, sf_dir))


def batch_record_ids(spark, sf_dir):
    b = sl.batches_of_ids(_tracked(spark, sf_dir).where(F.col("report_status") == sl.PENDING))
    return b.select("table_name", "batch_no", F.array_join(F.transform("record_ids", lambda x: x.cast("string")),
                                                           ",").alias("record_ids"))


def max_record_id(spark, sf_dir):
    b = sl.batches_of_ids(_tracked(spark, sf_dir).where(F.col("report_status") == sl.PENDING))
    return b.select("table_name", "batch_no", "max_record_id")


def _applied(spark, sf_dir):
    return sl.apply_status(_tracked(spark, sf_dir), _g1_log(spark, sf_dir))


def status_apply(spark, sf_dir):
    return _applied(spark, sf_dir).select("table_name", "id", "report_status", "retry_count")


def status_with_error(spark, sf_dir):
    a = _applied(spark, sf_dir).where(F.col("error_msg").isNotNull())
    return a.select("table_name", "id", "report_status", "retry_count", "error_msg",
                    F.length("error_msg").alias("error_len"))


def latest_status(spark, sf_dir):
    return sl.latest_status(_g1_log(spark, sf_dir)).select("table_name", "id", "seq", "status", "error_msg")


def retry_exhausted(spark, sf_dir):
    a = _applied(spark, sf_dir)
    return a.where((F.col("report_status") == sl.FAILED) & (F.col("retry_count") >= 3)) \
            .select("table_name", "id", "retry_count")


def task_progress(spark, sf_dir):
    p = sl.task_progress(_g1_log(spark, sf_dir))
    fmt = "yyyy-MM-dd HH:mm:ss"
    return p.select("task_id", "status", "error_msg", "table_name", "task_type", "last_processed_id", "processed_count", "success_count",
                    "fail_count", F.date_format("start_time", fmt).alias("start_time"),
                    F.date_format("end_time", fmt).alias("end_time"))


def incremental_pending(spark, sf_dir):
    """Pending rows after the checkpoint of a pass that stopped half way."""
    t = _tracked(spark, sf_dir)
    half = t.agg(F.max("id")).first()[0] // 2
    p = sl.task_progress(_g1_log(spark, sf_dir).where(F.col("id") <= half))
    return sl.incremental_pending(t, p).select("table_name", "id")


def status_after_relock(spark, sf_dir):
    """Rows marked Processing again after the pass: the last error stays."""
    log = _g1_log(spark, sf_dir)
    failed = sl.latest_status(log).where(F.col("status") == sl.FAILED).select("table_name", "id")
    again = sl.status_changes(sl.next_seq(failed, log), sl.PROCESSING, F.col("next_seq"),
                              F.to_timestamp(F.lit(RUN_TIME)) + F.expr("interval 1 hour"))
    a = sl.apply_status(_tracked(spark, sf_dir), log.unionByName(again))
    return a.select("table_name", "id", "report_status", "retry_count", "error_msg")


def ids_membership(spark, sf_dir):
    """Rows whose id is among the pending ones that end in 3 (C5, JN3)."""
    t = _tracked(spark, sf_dir)
    ids = t.where((F.col("report_status") == sl.PENDING) & (F.col("id") % 10 == 3))
    return sl.rows_with_ids(t, ids).select("table_name", "id", "user_unique_id")


def stale_processing(spark, sf_dir):
    now = F.to_timestamp(F.lit("2000-01-01 00:00:00"))
    return sl.stale_processing(_tracked(spark, sf_dir), now).select("table_name", "id")


# -- masking, JSON, coercion, parsing -----------------------------------------


def mask_user_id(spark, sf_dir):
    b = events_base(spark, sf_dir)
    return b.select("event_id", "user_unique_id", masking.mask_user_id(F.col("user_unique_id")).alias("masked"))


def _secret_docs(spark, sf_dir):
    d = load(spark, sf_dir, "documents")
    sp = F.when(F.col("doc_id") % 2 == 0, F.lit(" : ")).otherwise(F.lit(":"))
    s = F.col("doc_id").cast("string")
    doc = F.concat(F.lit('{"doc_id":'), s, F.lit(',"password"'), sp, F.lit('"pw'), s,
                   F.lit('","lang":"'), F.col("lang"), F.lit('","appKey":"ak-'), F.col("n_chars").cast("string"),
                   F.lit('","token"'), sp, F.lit('"tok'), s, F.lit('","secret":"'), F.col("lang"),
                   F.lit('-s","apiKey":"k'), s, F.lit('","api_key":"x","n_chars":'),
                   F.col("n_chars").cast("string"), F.lit(',"secretCount":3}'))
    return d.select("doc_id", doc.alias("doc"))


def mask_json(spark, sf_dir):
    d = _secret_docs(spark, sf_dir)
    return d.select("doc_id", masking.mask_json(F.col("doc")).alias("masked"))


def mask_json_documents(spark, sf_dir):
    """Redaction over whole documents: each becomes a JSON body carrying its
    full text and, when the text holds a ``token = "..."`` line, that token
    as a field; the body is then masked."""
    d = load(spark, sf_dir, "documents")
    tok = F.nullif(F.regexp_extract("text", r'token = "([0-9a-f]+)"', 1), F.lit(""))
    body = F.to_json(F.struct("doc_id", "lang", tok.alias("token"), "text"))
    b = d.select("doc_id", body.alias("body"))
    m = masking.mask_json(F.col("body"))
    return b.select("doc_id", m.alias("masked"), (m != F.col("body")).alias("redacted"))


def mask_url(spark, sf_dir):
    p = load(spark, sf_dir, "pages")
    url = F.when((F.col("page_id") % 3 == 0) & F.col("url").contains("?"),
                 F.concat(F.col("url"), F.lit("&token=abc"))).otherwise(F.col("url"))
    return p.select("page_id", url.alias("url")).select(
        "page_id", "url", masking.mask_url(F.col("url")).alias("masked_url"))


def _records(spark, sf_dir, name):
    spec = REGISTRY.get(name)
    df = driver_table(spark, sf_dir, name)
    return df.select("event_id", jsonfn.record_json(*spec.select_fields()).alias("record_json"))


def record_json(spark, sf_dir):
    return _records(spark, sf_dir, "pay_result")


def pretty_json(spark, sf_dir):
    """Indented JSON of each pay record, checked through its line count and
    its compacted form (newline + indent and the `` : `` separator removed)."""
    spec = REGISTRY.get("pay")
    df = driver_table(spark, sf_dir, "pay")
    pretty = jsonfn.pretty_json(F.struct(*spec.select_fields()))
    compact = F.regexp_replace(F.regexp_replace(pretty, r"\n\s*", ""), '" : ', '":')
    return df.select("event_id", F.size(F.split(pretty, "\n")).alias("n_lines"), compact.alias("compact"))


def json_typed_parse(spark, sf_dir):
    r = _records(spark, sf_dir, "pay")
    schema = "user_unique_id string, et bigint, pay_amount decimal(10,2), is_ai int, package_type string"
    p = r.select("event_id", jsonfn.parse_typed(F.col("record_json"), schema).alias("p"))
    return p.select("event_id", "p.user_unique_id", "p.et", "p.pay_amount", "p.is_ai", "p.package_type")


def json_map_parse(spark, sf_dir):
    r = _records(spark, sf_dir, "element_click")
    m = r.select("event_id", jsonfn.parse_map(F.col("record_json")).alias("m"))
    return m.select("event_id", F.explode("m").alias("key", "value"))


def map_to_json(spark, sf_dir):
    df = driver_table(spark, sf_dir, "element_click")
    m = F.create_map(F.lit("click_type"), F.col("click_type"), F.lit("click_area"), F.col("click_area"))
    return df.select("event_id", jsonfn.map_json(m).alias("json"))


def _coercion_text():
    k = F.col("k").cast("string")
    r = F.col("event_id") % 7
    return (F.when(r == 0, k).when(r == 1, F.concat(F.lit("+"), k))
            .when(r == 2, F.concat(F.lit(" "), k, F.lit(" "))).when(r == 3, F.concat(k, F.lit(".9")))
            .when(r == 4, F.concat(F.lit("x"), k)).when(r == 5, F.lit("99999999999999999999"))
            .otherwise(F.concat(F.lit("-"), k)))


def long_coercion(spark, sf_dir):
    b = events_base(spark, sf_dir).select("event_id", _coercion_text().alias("text"), "amount")
    return b.select("event_id", "text", to_long(F.col("text")).alias("as_long"),
                    to_long(F.col("amount"), b.schema["amount"].dataType).alias("amount_long"))


def mode_parse(spark, sf_dir):
    r = F.col("event_id") % 6
    text = (F.when(r == 0, F.lit("single")).when(r == 1, F.lit(" SINGLE ")).when(r == 2, F.lit("BATCH"))
            .when(r == 3, F.lit("")).when(r == 4, F.lit(None).cast("string")).otherwise(F.lit("x")))
    b = load(spark, sf_dir, "events").select("event_id", text.alias("mode_text"))
    return b.select("event_id", "mode_text", parse_mode(F.col("mode_text")).alias("mode"))


def table_validation(spark, sf_dir):
    ev = load(spark, sf_dir, "events").select(F.col("event_type").alias("table_name"))
    mapping = F.create_map(*[x for t, e in EVENT_TYPE_OF.items() for x in (F.lit(e), F.lit(t))])
    mapped = load(spark, sf_dir, "events").select(F.element_at(mapping, F.col("event_type")).alias("table_name"))
    names = ev.unionByName(mapped).distinct()
    return validate_tables(names, REGISTRY.to_df(spark))


QUERIES.update({
    "status_decode": status_decode,
    "status_invalid": status_invalid,
    "pending_keyset_scan": pending_keyset_scan,
    "retryable_scan": retryable_scan,
    "pending_count": pending_count,
    "pending_counts_all": pending_counts_all,
    "pending_nonzero": pending_nonzero,
    "status_histogram": status_histogram,
    "batch_record_ids": batch_record_ids,
    "max_record_id": max_record_id,
    "status_apply": status_apply,
    "status_with_error": status_with_error,
    "latest_status": latest_status,
    "retry_exhausted": retry_exhausted,
    "task_progress": task_progress,
    "incremental_pending": incremental_pending,
    "stale_processing": stale_processing,
    "status_after_relock": status_after_relock,
    "ids_membership": ids_membership,
    "mask_user_id": mask_user_id,
    "mask_json": mask_json,
    "mask_url": mask_url,
    "mask_json_documents": mask_json_documents,
    "record_json": record_json,
    "pretty_json": pretty_json,
    "json_typed_parse": json_typed_parse,
    "json_map_parse": json_map_parse,
    "map_to_json": map_to_json,
    "long_coercion": long_coercion,
    "mode_parse": mode_parse,
    "table_validation": table_validation,
})


# -- logs, backfill, duplicates ---------------------------------------------------


BACKFILL = ("2024-01-05", "2024-01-20")


# what a sender's failure leaves below its line
TRACE = "\njava.io.IOException: not delivered\n\tat relay.Sender.send(Sender.java:42)\n\n\t... 3 more"


def _written(spark, lines: DataFrame, name: str) -> str:
    """``lines`` as a text log; the folder."""
    path = runner.scratch_path(spark, name)
    lines.write.text(path)
    return path


def failed_log_parse(spark, sf_dir):
    """The failed-records file written as text and read back."""
    path = _written(spark, failed_records_file(_run(spark, sf_dir, reject_if=_short_id())), "failed-records")
    return logs.parse_failed(logs.read_lines(spark, path)).select("table_name", "dt", "user_masked", "reason", "record_json")


def summary_log_parse(spark, sf_dir):
    lines = run_log(_run(spark, sf_dir, reject_if=_short_id()))
    return logs.parse_summary(logs.parse_main(lines)).select("total", "success", "fail")


def log_error_filter(spark, sf_dir):
    """Errors of the main log, read from text files, with their stack traces."""
    lines = run_log(_run(spark, sf_dir, reject_if=_short_id()))
    error = F.substring("value", 26, 11) == "main] ERROR"
    lines = lines.select(F.when(error, F.concat("value", F.lit(TRACE))).otherwise(F.col("value")).alias("value"))
    events = logs.read_events(spark, _written(spark, lines, "main-log"))
    return logs.errors_only(logs.parse_main(events)).select("level", "logger", "msg")


def backfill_range(spark, sf_dir):
    """All dates of an inclusive range in one job; per-date totals."""
    tables = {n: df.where(date_range(*BACKFILL)) for n, df in _tables(spark, sf_dir).items()}
    run = ReportRun(spark, tables, RunConfig(ingest_ms=DEFAULT_INGEST_MS), reject_if=_short_id(), scripted_attempts=True)
    return run.summary.where(F.col("level") == "date").select("dt", "total", "success", "fail")


def failed_dates(spark, sf_dir):
    s = _run(spark, sf_dir).summary
    return s.where((F.col("level") == "date") & (F.col("fail") > 0)).select("dt", "fail")


def _replayed(spark, sf_dir):
    """Payloads of the tables, every tenth event read a second time."""
    p = _run(spark, sf_dir).payloads.select("event_id", "table_name", "dt", "user_unique_id", "et", "params")
    return p.unionByName(p.where(F.col("event_id") % 10 == 3))


def duplicate_report(spark, sf_dir):
    return dedupe.duplicate_groups(_replayed(spark, sf_dir))


def not_delivered(spark, sf_dir):
    """Rows of a replayed run whose key no earlier run has delivered; two
    earlier runs have delivered three tenths of the events."""
    rows = _replayed(spark, sf_dir)
    store = delivered.DeliveredKeys(spark, runner.scratch_path(spark, "delivered"), buckets=16, capacity=1_000_000)
    for part in (F.col("event_id") % 10 == 3, (F.col("event_id") % 10).isin(5, 8)):
        store.add(rows.where(part))
    return store.not_delivered(rows).select("event_id", "table_name", "dt", "delivery_key")


QUERIES.update({
    "failed_log_parse": failed_log_parse,
    "summary_log_parse": summary_log_parse,
    "log_error_filter": log_error_filter,
    "backfill_range": backfill_range,
    "failed_dates": failed_dates,
    "duplicate_report": duplicate_report,
    "not_delivered": not_delivered,
})


# -- streaming -----------------------------------------------------------------


def _events_stream(spark, sf_dir):
    schema = load(spark, sf_dir, "events").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
            .option("maxFilesPerTrigger", 1).parquet(sf_dir))


def stream_outbox(spark, sf_dir):
    """The outbox built incrementally: availableNow over the events files,
    each micro-batch through the batch plan, outputs keyed by epoch."""
    out = runner.scratch_path(spark, "stream-out")
    q = runner.start_report_stream(_events_stream(spark, sf_dir),
                                   lambda b: tables_from_events(events_view(b)), out,
                                   runner.scratch_path(spark, "stream-ckpt"), RunConfig(ingest_ms=DEFAULT_INGEST_MS))
    q.awaitTermination()
    return spark.read.parquet(f"{out}/outbox").drop("epoch")


def stream_rate_metrics(spark, sf_dir):
    """Minute rates on a streamed attempt log, all minutes, open ones too."""
    log_dir = runner.scratch_path(spark, "attempt-log")
    att = _run(spark, sf_dir).attempts
    att.write.parquet(log_dir)
    out = runner.scratch_path(spark, "rates")
    q = runner.start_rate_stream(spark.readStream.schema(att.schema).parquet(log_dir), out,
                                 runner.scratch_path(spark, "rates-ckpt"))
    q.awaitTermination()
    return runner.latest_rates(spark, out)


QUERIES.update({
    "stream_outbox": stream_outbox,
    "stream_rate_metrics": stream_rate_metrics,
})


# -- failed records sent again -----------------------------------------------------

RESEND_RETRIES = 6


def _resend(spark, sf_dir):
    """The resend job over all tracked rows; answers differ from round to round."""
    ensure_conf(spark)
    job = resend.Resend(spark, tracked_tables(spark, sf_dir), runner.scratch_path(spark, "resend"),
                        lambda outbox, n: delivery.scripted_attempts(outbox, f"resend-{n}", shift=2 * n), DEFAULT_INGEST_MS,
                        config=resend.ResendConfig(max_retry=RESEND_RETRIES))
    return job.run()


def resend_failed(spark, sf_dir):
    """Every record that was sent again: rounds, last status, retries, error."""
    return resend.resend_result(_resend(spark, sf_dir), RESEND_RETRIES, _tracked(spark, sf_dir))


def resend_rounds(spark, sf_dir):
    return resend.round_summary(_resend(spark, sf_dir))


QUERIES.update({
    "resend_failed": resend_failed,
    "resend_rounds": resend_rounds,
})


# -- a table that fails -------------------------------------------------------------


def isolated_summary(spark, sf_dir):
    """The summary of a run in which one table cannot be read to its end."""
    tables = _tables(spark, sf_dir)
    bad = F.when(F.col("event_id") % 50 == 0, F.raise_error(F.lit("[DAMAGED] page cannot be read"))).otherwise(F.col("user_unique_id"))
    tables["user_info"] = tables["user_info"].withColumn("user_unique_id", bad)
    run = isolated.IsolatedRun(spark, tables, RunConfig(ingest_ms=DEFAULT_INGEST_MS),
                               attempts=lambda r: delivery.scripted_attempts(r.outbox, r.cfg.run_id))
    error = F.regexp_extract("error", r"\[DAMAGED\] page cannot be read", 0)
    return run.run().select("dt", "table_name", "level", "total", "success", "fail", error.alias("error"))


QUERIES.update({
    "isolated_summary": isolated_summary,
})


# -- the status log folded into its base -----------------------------------------------


def status_compacted(spark, sf_dir):
    """Tracked rows after two compactions of the pass's log (marks, then results)."""
    rows = _tracked(spark, sf_dir).withColumn("updated_at", F.col("updated_at").cast("timestamp")) \
        .withColumn("error_msg", F.lit(None).cast("string"))
    table = compaction.StatusTable(spark, runner.scratch_path(spark, "status"), runner.scratch_path(spark, "status-log"),
                                   rows.schema, block=compaction.block_for(rows))
    table.create(rows)
    log = _g1_log(spark, sf_dir)
    for part in (log.where("seq = 1"), log.where("seq > 1")):
        table.append(part)
        table.compact()
    return table.rows().select("table_name", "id", "report_status", "retry_count", "error_msg")


QUERIES.update({
    "status_compacted": status_compacted,
})


# -- outcomes while a run is delivered ---------------------------------------------------


def _in_parts(df: DataFrame, time_col: str, path: str, parts: int, delay: str = "0 seconds"):
    """Append ``df`` in ``parts`` parts in the order of time, as a live log would
    be written; ``delay`` moves the borders. The caller runs between them."""
    t = F.unix_micros(F.col(time_col) - F.expr(f"interval {delay}"))
    low, high = df.agg(F.min(t), F.max(t)).first()
    number = F.least(F.floor((t - low) * parts / (high - low + 1)), F.lit(parts - 1))
    numbered = df.withColumn("_part", F.greatest(number, F.lit(0))).persist()
    for k in range(parts):
        numbered.where(F.col("_part") == k).drop("_part").write.mode("append").parquet(path)
        yield k
    numbered.unpersist()


def stream_record_outcomes(spark, sf_dir):
    """Record outcomes from members and attempts that arrive in three parts each."""
    run = _run(spark, sf_dir, reject_if=_short_id())
    start = F.timestamp_seconds(F.lit(delivery.RUN_START_EPOCH_S) + F.coalesce("request_no", F.lit(0)) * 3)
    members = run.members.withColumn("sent_at", start).select(*stream_outcomes.MEMBER)
    attempts = run.attempts.select(*delivery.REQ, *stream_outcomes.ATTEMPT)
    paths = [runner.scratch_path(spark, n) for n in ("members", "attempts", "outcomes", "outcomes-ckpt")]

    def deliver() -> None:
        streams = [spark.readStream.schema(df.schema).parquet(p) for df, p in zip((members, attempts), paths)]
        stream_outcomes.start_outcome_stream(*streams, paths[2], paths[3], horizon="1 minute").awaitTermination()

    for _ in zip(_in_parts(members, "sent_at", paths[0], 3), _in_parts(attempts, "started_at", paths[1], 3, "2 seconds"), strict=True):
        deliver()
    for df, col, path in ((members, "sent_at", paths[0]), (attempts, "started_at", paths[1])):
        stream_outcomes.end_log(df, col, path, "2100-01-01 00:00:00")
    deliver()
    got = stream_outcomes.read_outcomes(spark, paths[2], run.modes)
    return got.select("table_name", "dt", "event_id", "request_no", "status", "reason", "attempts_used")


QUERIES.update({
    "stream_record_outcomes": stream_record_outcomes,
})


# -- streams over several files ------------------------------------------------------


def _arrivals(rows, path: str, parts):
    """Append the rows of each condition of ``parts``, one after the other; the
    caller runs its stream between them, which takes one arrival as one epoch."""
    for part in parts:
        rows.where(part).write.mode("append").parquet(path)
        yield part


def _thirds():
    return [F.col("event_id") % 3 == n for n in range(3)]


def stream_epochs(spark, sf_dir):
    """Requests and records of every epoch: a stream that ends after the first
    third and goes on from its checkpoint when the next one has come."""
    ev = load(spark, sf_dir, "events")
    src, out, ckpt = (runner.scratch_path(spark, n) for n in ("files-in", "files-out", "files-ckpt"))
    for _ in _arrivals(ev, src, _thirds()):
        stream = spark.readStream.schema(ev.schema).parquet(src)
        runner.start_report_stream(stream, lambda b: tables_from_events(events_view(b)), out, ckpt,
                                   RunConfig(ingest_ms=DEFAULT_INGEST_MS)).awaitTermination()
    sent = spark.read.parquet(f"{out}/outbox")
    return sent.groupBy("run_id", "table_name", "dt", "endpoint").agg(
        F.count(F.lit(1)).alias("n_requests"), F.sum("n_records").cast("long").alias("n_records"))


def stream_dedupe(spark, sf_dir):
    """Delivery keys of a stream of three arrivals in which every tenth event comes twice."""
    rows = _replayed(spark, sf_dir).withColumn("day", F.col("dt").cast("timestamp"))
    src, out, ckpt = (runner.scratch_path(spark, n) for n in ("keys-in", "keys-out", "keys-ckpt"))
    again = F.col("event_id") % 10 == 3  # once more, in an epoch of their own
    for _ in _arrivals(rows, src, [F.col("event_id") % 2 == 1, F.col("event_id") % 4 == 0, F.col("event_id") % 4 == 2, again]):
        stream = spark.readStream.schema(rows.schema).parquet(src)
        with runner.state_on_disk(spark):
            q = (runner.dedupe_stream(stream, "day", "1000 days").select("table_name", "dt", "delivery_key").writeStream.outputMode("append")
                 .option("checkpointLocation", ckpt).trigger(availableNow=True).start(out, format="parquet"))
        q.awaitTermination()
    return spark.read.schema("table_name string, dt string, delivery_key string").parquet(out)


def _status_stream(spark, log, parts, end: str) -> str:
    """The status log streamed an arrival at a time; the folder of what it yields."""
    src, out, ckpt = (runner.scratch_path(spark, n) for n in ("status-in", "status-out", "status-ckpt"))

    def run() -> None:
        stream_status.start_status_stream(spark.readStream.schema(log.schema).parquet(src), out, ckpt).awaitTermination()

    for _ in _arrivals(log, src, parts):
        run()
    stream_status.end_changes(log, src, end)
    run()
    return out


def stream_latest_status(spark, sf_dir):
    """Latest status of every record of a pass, over four epochs."""
    log = _g1_log(spark, sf_dir)
    parts = [F.col("seq") == 1, (F.col("seq") == 2) & (F.col("status") == sl.SUCCESS), (F.col("seq") == 2) & (F.col("status") == sl.FAILED)]
    out = _status_stream(spark, log, parts, "2024-02-01 00:30:00")
    return stream_status.read_latest(spark, out).select("table_name", "id", "seq", "status", "error_msg")


def stream_stale_processing(spark, sf_dir):
    """Records stuck in process, found by their timers, over four epochs."""
    rows = _tracked(spark, sf_dir)
    log = rows.select("table_name", F.col("id").cast("long"), F.lit(1).cast("long").alias("seq"), F.col("report_status").cast("int").alias("status"),
                      F.lit(None).cast("string").alias("error_msg"), F.col("updated_at").cast("timestamp").alias("updated_at"), F.lit(False).alias("bump_retry"))
    year = F.year("updated_at")
    out = _status_stream(spark, log, [year < 1994, year.between(1994, 1996), year > 1996], "2030-01-01 00:10:00")
    return stream_status.read_stale(spark, out).select("table_name", "id")


QUERIES.update({
    "stream_epochs": stream_epochs,
    "stream_dedupe": stream_dedupe,
    "stream_latest_status": stream_latest_status,
    "stream_stale_processing": stream_stale_processing,
})


# -- footers, observed metrics, variants, tables of one's own ------------------------


def partition_count_footers(spark, sf_dir):
    """Rows of every stored (table, date), from the files' footers."""
    base = runner.scratch_path(spark, "stored")
    paths = {}
    for name, df in _tables(spark, sf_dir, "month").items():
        paths[REGISTRY.get(name)] = f"{base}/{name}"
        df.repartition("dt").write.partitionBy("dt").parquet(f"{base}/{name}")
    return footers.partition_counts(spark, paths)


def metrics_observed(spark, sf_dir):
    """Metrics from the writes of a run; the wall time of its jobs only as found (1)."""
    got = metrics.write_observed(_run(spark, sf_dir), runner.scratch_path(spark, "accounting"))
    wall = F.col("metric") == "avg_query_ms"
    return got.select("metric", F.when(wall, (F.col("value") > 0).cast("double")).otherwise(F.col("value")).alias("value"))


def json_variant_parse(spark, sf_dir):
    """Request bodies as VARIANT: nested, numeric and missing values."""
    rows = _run(spark, sf_dir).payloads.select("table_name", "event_id", jsonfn.parse_variant(F.col("body")).alias("v"))
    event = "$.events[0]"
    rows = rows.withColumn("p", jsonfn.parse_variant(jsonfn.variant_field(F.col("v"), f"{event}.params")))
    at = jsonfn.variant_field(F.col("v"), f"{event}.local_time_ms", "variant")
    return rows.select(
        "table_name", "event_id", jsonfn.variant_field(F.col("v"), f"{event}.event").alias("event"),
        jsonfn.variant_field(F.col("v"), f"{event}.local_time_ms", "bigint").alias("local_time_ms"), jsonfn.variant_kind(at).alias("time_kind"),
        jsonfn.variant_field(F.col("v"), "$.user.user_unique_id").alias("user_unique_id"),
        jsonfn.variant_field(F.col("v"), "$.user.device_id").alias("device_id"),
        jsonfn.variant_field(F.col("p"), "$.pay_amount", "decimal(10,2)").alias("pay_amount"),
        jsonfn.variant_field(F.col("p"), "$.is_ai", "int").alias("is_ai"),
        jsonfn.variant_field(F.col("p"), "$.page_id").alias("page_id"))


def unknown_table_rows(spark, sf_dir):
    """Dead letters of a run that was given a table outside the registry."""
    views = events_base(spark, sf_dir).where(F.col("event_type") == "view")
    tables = {"element_click": driver_table(spark, sf_dir, "element_click"),
              "promo_view": views.select("event_id", "dt", "user_unique_id", "et", "k")}
    run = ReportRun(spark, tables, RunConfig(ingest_ms=DEFAULT_INGEST_MS, reject_unknown=True))
    return run.dead_letters.select("table_name", "dt", "user_masked", "reason")


LINE_SOLD = TableSpec("line_sold", "line_sold", ("order_id", "line_no", "quantity", "price", "returned", "ship_mode"), has_et=False,
                      field_types=(("order_id", "bigint"), ("line_no", "int"), ("quantity", "decimal(12,2)"), ("price", "decimal(12,2)"),
                                   ("returned", "boolean")))


def custom_table_payloads(spark, sf_dir):
    """A table registered with typed fields, stored by month and read by its registry schema."""
    ensure_conf(spark)
    own = Registry()
    own.register(LINE_SOLD)
    lines = load(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("event_id"), F.concat(F.lit("part_"), F.col("l_partkey")).alias("user_unique_id"),
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").cast("int").alias("line_no"),
        F.col("l_quantity").cast("decimal(12,2)").alias("quantity"), F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        (F.col("l_returnflag") == "R").alias("returned"), F.nullif(F.col("l_linestatus"), F.lit("O")).alias("ship_mode"),
        F.date_format("l_shipdate", "yyyy-MM").alias("dt"))
    path = runner.scratch_path(spark, "line-sold")
    lines.repartition("dt").write.partitionBy("dt").parquet(path)
    stored = read_partitioned(spark, path, LINE_SOLD)
    return transform.payloads_all({"line_sold": stored}, DEFAULT_INGEST_MS, own).select("event_id", "dt", "user_unique_id", "params")


QUERIES.update({
    "partition_count_footers": partition_count_footers,
    "metrics_observed": metrics_observed,
    "json_variant_parse": json_variant_parse,
    "unknown_table_rows": unknown_table_rows,
    "custom_table_payloads": custom_table_payloads,
})
