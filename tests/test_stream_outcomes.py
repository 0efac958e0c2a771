"""Outcomes of a run on two streams: equal to the batch rules, members without an answer, restarts."""
from pyspark.sql import functions as F

from relaykit.operators import delivery
from relaykit.registry import REGISTRY, resolve_modes
from relaykit.streaming import outcomes, runner

MEMBER = "run_id string, table_name string, dt string, request_no long, event_id long, user_unique_id string, error string, sent_at timestamp"
ATTEMPT = ("run_id string, table_name string, dt string, request_no long, attempt int, http_status int, body string, "
           "transport_error string, started_at timestamp, duration_ms long")


def at(second):
    return f"2024-02-01 {second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}"


def member(n, second, event=None, dt="d", error=None):
    return ("r", "page_vidw", dt, n, n * 10 if event is None else event, "u", error, at(second))


def attempt(n, k, status, second, dt="d"):
    return ("r", "page_vidw", dt, n, k, status, "x", None, at(second), 5)


def frame(spark, rows, schema, time_col):
    cols = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame(rows, schema.replace("timestamp", "string")).withColumn(time_col, F.col(time_col).cast("timestamp")).select(*cols)


def test_members_meet_their_attempts_over_restarts(spark):
    paths = [runner.scratch_path(spark, n) for n in ("t-members", "t-attempts", "t-pairs", "t-pairs-ckpt")]
    members = [[member(1, 0), member(1, 0, 11), member(2, 5), member(None, 0, 99, error="Transform failed"), member(7, 20, dt=None)], [member(3, 3000), member(4, 3010)]]
    attempts = [[attempt(1, 1, 500, 1)],
                [attempt(1, 2, 200, 30), attempt(1, 3, 500, 40), attempt(2, 1, 500, 6), attempt(2, 2, 500, 7), attempt(3, 1, 200, 3001),
                 attempt(7, 1, 200, 21, dt=None), attempt(4, 1, 200, 3010 + 7200)]]  # beyond the horizon

    def run():
        streams = [spark.readStream.schema(s).option("maxFilesPerTrigger", 1).parquet(p) for s, p in zip((MEMBER, ATTEMPT), paths)]
        outcomes.start_outcome_stream(*streams, paths[2], paths[3], horizon="10 minutes", watermark="2 hours").awaitTermination()

    for m, a in zip(members, attempts):  # the job is started again for each arrival
        frame(spark, m, MEMBER, "sent_at").coalesce(1).write.mode("append").parquet(paths[0])
        frame(spark, a, ATTEMPT, "started_at").coalesce(1).write.mode("append").parquet(paths[1])
        run()
    for path, schema, col in ((paths[0], MEMBER, "sent_at"), (paths[1], ATTEMPT, "started_at")):
        outcomes.end_log(spark.read.schema(schema).parquet(path), col, path, "2100-01-01")
    run()
    got = outcomes.read_outcomes(spark, paths[2], resolve_modes(REGISTRY.to_df(spark)))
    assert {(r.event_id, r.status, r.reason, r.attempts_used) for r in got.collect()} == {
        (10, "success", None, 2), (11, "success", None, 2), (20, "failed", "Retry interrupted", 2), (99, "failed", "Transform failed", None),
        (70, "success", None, 1), (30, "success", None, 1), (40, "unsent", None, None)}
    # as the batch rules give it, but for the answer beyond the horizon
    whole = frame(spark, sum(members, []), MEMBER, "sent_at")
    log = frame(spark, [a for a in sum(attempts, []) if a[3] != 4], ATTEMPT, "started_at")
    batch = delivery.record_outcomes(whole, delivery.outcomes(delivery.classify(log), resolve_modes(REGISTRY.to_df(spark))))
    assert sorted(map(str, batch.collect())) == sorted(map(str, got.select(*batch.columns).collect()))
