"""Delivery accounting: attempt log → classified attempts → request outcomes.

The network call is the caller's: :func:`deliver` runs a ``transport``
callable over outbox partitions with ``mapInPandas`` and writes one attempt
log row per try. Everything after that is aggregation over the attempt log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.jsonfn import RESPONSE_SCHEMA
from ..registry import SINGLE
from .ordinal import with_ordinal

MAX_ATTEMPTS = 3
REQ = ("run_id", "table_name", "dt", "request_no")

# Failure reason texts of the report run.
REASON_MAX_RETRIES = "Max retries exceeded"
REASON_BATCH_PREFIX = "Batch report failed: "
REASON_INTERRUPTED = "Retry interrupted"
CONNECTION_PREFIX = "Connection error: "
BREAKER_PREFIX = "Circuit breaker: "

ATTEMPT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("dt", T.StringType()),
    T.StructField("request_no", T.LongType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("body", T.StringType()),
    T.StructField("transport_error", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("duration_ms", T.LongType()),
])

RUN_START_EPOCH_S = 1706745600  # 2024-02-01T00:00:00Z, start of the scripted run


def scripted_attempts(outbox: DataFrame, run_id: str = "run", shift: int = 0) -> DataFrame:
    """A deterministic attempt log for an outbox (test fixture, no network).

    Three tries per request (two for every 23rd: an interrupted run); status
    cycles through 503, 0 (I/O error), 429, 500, 200 by
    ``(request_no*7 + attempt*3 + shift) % 5``; tries after a success are present
    on purpose. 200 bodies: every 17th is not JSON, every 7th reports ``ec=1``.
    The three tries come from ``explode`` of a literal array — no join.
    """
    r = F.col("request_no")
    a = F.col("attempt")
    tries = F.when(r % 23 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1), F.lit(2), F.lit(3)))
    x = outbox.select("table_name", "dt", "request_no", "n_records", F.explode(tries).alias("attempt"))
    code = (r * 7 + a * 3 + shift) % 5
    status = (F.when(code == 0, 503).when(code == 1, 0).when(code == 2, 429)
              .when(code == 3, 500).otherwise(200)).cast("int")
    n = F.col("n_records").cast("string")
    ok_body = (F.when(r % 17 == 0, F.lit("not json"))
               .when(r % 7 == 0, F.concat(F.lit('{"e":0,"message":"partial","sc":'),
                                          (F.col("n_records") - 1).cast("string"), F.lit(',"ec":1}')))
               .otherwise(F.concat(F.lit('{"e":0,"message":"success","sc":'), n, F.lit(',"ec":0}'))))
    body = (F.when(status == 200, ok_body).when(status == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit('{"e":'), status.cast("string"), F.lit(',"message":"server busy"}'))))
    return x.select(
        F.lit(run_id).alias("run_id"), "table_name", "dt", "request_no", a.cast("int").alias("attempt"),
        status.alias("http_status"), body.alias("body"),
        F.when(status == 0, F.lit("Read timed out")).alias("transport_error"),
        F.timestamp_seconds(F.lit(RUN_START_EPOCH_S) + r * 3 + a).alias("started_at"),
        (F.lit(10) + (r * 13 + a) % 90).cast("long").alias("duration_ms"))


def deliver(outbox: DataFrame, transport: Callable[[str, str], tuple[int, str]],
            max_attempts: int = MAX_ATTEMPTS, run_id: str = "run",
            retry_delay_ms: int = 0) -> DataFrame:
    """Send every outbox request with up to ``max_attempts`` tries.

    ``transport(endpoint, body) -> (http_status, response_body)``; raising
    ``OSError`` records an I/O failure (status 0). Runs per partition with
    ``mapInPandas``: the request rate equals the number of outbox partitions
    (``repartition(n)`` is the limiter). ``retry_delay_ms`` waits between a
    failed try and the next one. Returns the attempt log.
    """
    import time

    import pandas as pd

    def run(batches):
        for pdf in batches:
            rows = []
            for rec in pdf.itertuples(index=False):
                for attempt in range(1, max_attempts + 1):
                    t0 = time.time()
                    status, resp, err = 0, None, None
                    try:
                        status, resp = transport(rec.endpoint, rec.body)
                    except OSError as e:
                        err = str(e)
                    except Exception as e:  # noqa: BLE001 — wrapper failure
                        err = BREAKER_PREFIX + str(e)
                    rows.append((run_id, rec.table_name, rec.dt, rec.request_no, attempt, int(status),
                                 resp, err, pd.Timestamp(int(t0 * 1e6), unit="us"), int((time.time() - t0) * 1000)))
                    if status == 200:
                        break
                    if retry_delay_ms and attempt < max_attempts:
                        time.sleep(retry_delay_ms / 1000.0)
            yield pd.DataFrame(rows, columns=ATTEMPT_SCHEMA.fieldNames())

    return outbox.select("table_name", "dt", "request_no", "endpoint", "body").mapInPandas(run, ATTEMPT_SCHEMA)


def classify(attempts: DataFrame) -> DataFrame:
    """Per attempt: ok flag, error text, parsed response.

    200 is success whatever the body says (also when it does not parse);
    other codes fail with ``HTTP <code>: <body>``; status 0 is an I/O error.
    """
    st = F.col("http_status")
    ok = st == 200
    err = (F.when(ok, F.lit(None).cast("string"))
           .when((st == 0) & F.col("transport_error").startswith(BREAKER_PREFIX), F.col("transport_error"))
           .when(st == 0, F.concat(F.lit(CONNECTION_PREFIX), F.coalesce(F.col("transport_error"), F.lit(""))))
           .otherwise(F.concat(F.lit("HTTP "), st.cast("string"), F.lit(": "), F.coalesce(F.col("body"), F.lit("")))))
    resp = F.when(F.coalesce(F.length("body"), F.lit(0)) > 0, F.from_json("body", RESPONSE_SCHEMA))
    return attempts.select("*", ok.alias("ok"), err.alias("error"), resp.alias("response"))


def outcomes(classified: DataFrame, modes: DataFrame | None = None,
             max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """One row per request: success, winning attempt, tries used, reason.

    Tries after the first success and beyond ``max_attempts`` are ignored.
    A failed request with fewer tries than allowed was interrupted.
    Grouping is by request key, so groups are tiny (≤ attempts per request).
    The key has the run's id where the log has one.
    """
    c = classified.where(F.col("attempt") <= max_attempts)
    req = [x for x in REQ if x in classified.columns]
    agg = c.groupBy(*req).agg(
        F.min(F.when(F.col("ok"), F.col("attempt"))).alias("ok_attempt"),
        F.max("attempt").alias("max_attempt"),
        F.max_by("error", F.when(~F.col("ok"), F.col("attempt"))).alias("last_error"),
        F.collect_list(F.struct("attempt", "duration_ms")).alias("_durs"))
    used = F.coalesce(F.col("ok_attempt"), F.col("max_attempt"))
    dur = F.aggregate(F.filter("_durs", lambda s: s["attempt"] <= used), F.lit(0).cast("long"),
                      lambda acc, s: acc + s["duration_ms"])
    out = agg.select(*req, F.col("ok_attempt").isNotNull().alias("success"), "ok_attempt",
                     used.cast("int").alias("attempts_used"), "last_error", dur.alias("duration_ms"))
    if modes is not None:
        out = out.join(F.broadcast(modes.select("table_name", "mode")), "table_name", "left")
    else:
        out = out.withColumn("mode", F.lit(None).cast("string"))
    reason = (F.when(F.col("success"), F.lit(None).cast("string"))
              .when(F.col("attempts_used") < max_attempts, F.lit(REASON_INTERRUPTED))
              .when(F.col("mode") == SINGLE, F.lit(REASON_MAX_RETRIES))
              .otherwise(F.concat(F.lit(REASON_BATCH_PREFIX), F.coalesce("last_error", F.lit("")))))
    return out.withColumn("reason", reason)


def record_outcomes(members: DataFrame, outcome: DataFrame, key: str = "event_id") -> DataFrame:
    """Outcome of every source row: its request's, or its transform error.

    Rows of requests never tried are ``unsent``. Joined on the request key
    (a null dt is a key like any other); a request has at most 50 members.
    Rejected rows have no request and pass the join by, so they meet in no task.
    """
    req = [c for c in REQ if c in outcome.columns and c in members.columns]
    o = outcome.select(*[F.col(c).alias(f"_o_{c}") for c in req], "success", "reason", "attempts_used")
    same = F.lit(True)
    for c in req:
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    sent = members.where(F.col("request_no").isNotNull()).join(o, same, "left").drop(*[f"_o_{c}" for c in req])
    kinds = {c: outcome.schema[c].dataType for c in ("success", "reason", "attempts_used")}
    j = sent.unionByName(members.where(F.col("request_no").isNull()).withColumns({c: F.lit(None).cast(t) for c, t in kinds.items()}))
    status = (F.when(F.col("error").isNotNull(), F.lit("failed"))
              .when(F.col("success").isNull(), F.lit("unsent"))
              .when(F.col("success"), F.lit("success")).otherwise(F.lit("failed")))
    reason = F.when(F.col("error").isNotNull(), F.col("error")).otherwise(F.col("reason"))
    cols = ["table_name", "dt", key, "request_no", "user_unique_id",
            status.alias("status"), reason.alias("reason"), "attempts_used"]
    if "record_json" in members.columns:
        cols.append("record_json")
    return j.select(*cols)


def failure_rate_window(classified: DataFrame, window: int = 10, min_calls: int = 5,
                        threshold: float = 0.5, block_rows: int = 1 << 16) -> DataFrame:
    """Trailing failure rate over the last ``window`` calls per (endpoint
    stream = table, dt), null until ``min_calls`` calls, flag at ≥ threshold,
    and breaker opens (flag turning on).

    Skew-safe: calls get an exact sequence number (:func:`with_ordinal`), are
    cut into blocks of ``block_rows`` and each block also receives the last
    ``window`` calls of the previous one (halo), so every window task sorts
    one block instead of a whole (table, dt).
    """
    seq_key = (F.unix_micros(F.col("started_at").cast("timestamp")))
    base = classified.select("table_name", "dt", "request_no", "attempt", "started_at",
                             F.col("ok"), seq_key.alias("_t"))
    s = with_ordinal(base, ["table_name", "dt"], "_t", "seq", tiebreak=("request_no", "attempt"))
    blk = F.floor(F.col("seq") / F.lit(block_rows)).cast("long")
    own = s.withColumn("_blk", blk).withColumn("_halo", F.lit(False))
    halo = (s.where(F.pmod(F.col("seq"), F.lit(block_rows)) >= block_rows - window)
            .withColumn("_blk", blk + 1).withColumn("_halo", F.lit(True)))
    both = own.unionByName(halo)
    w = Window.partitionBy("table_name", "dt", "_blk").orderBy("seq")
    trail = w.rowsBetween(-(window - 1), 0)
    fail = F.when(F.col("ok"), 0).otherwise(1)
    n = F.count(F.lit(1)).over(trail)
    rate = F.when(n >= min_calls, F.sum(fail).over(trail) / n)
    flagged = both.withColumn("n_calls", n).withColumn("failure_rate", rate) \
                  .withColumn("breaker_open", F.coalesce(F.col("failure_rate") >= F.lit(threshold), F.lit(False)))
    prev = F.lag("breaker_open").over(w)
    out = flagged.withColumn("opened", F.col("breaker_open") & ~F.coalesce(prev, F.lit(False)))
    return out.where(~F.col("_halo")).select(
        "table_name", "dt", "request_no", "attempt", "seq", "n_calls",
        F.round("failure_rate", 6).alias("failure_rate"), "breaker_open", "opened")


def partial_errors(classified: DataFrame) -> DataFrame:
    """HTTP 200 answers whose body reports ``ec > 0`` (counted as full
    success by the run); totals per (table, dt)."""
    r = F.col("response")
    p = classified.where((F.col("http_status") == 200) & (r["ec"] > 0))
    return p.groupBy("table_name", "dt").agg(
        F.count(F.lit(1)).alias("n_responses"),
        F.sum(r["sc"]).cast("long").alias("sum_sc"),
        F.sum(r["ec"]).cast("long").alias("sum_ec"))
