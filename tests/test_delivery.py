from relaykit.operators import delivery
from relaykit.registry import BATCH, SINGLE


def attempts_df(spark, rows):
    # (request_no, attempt, http_status, body, transport_error)
    full = [("run", "t", "d", r, a, s, b, e, None, 10) for r, a, s, b, e in rows]
    return spark.createDataFrame(full, delivery.ATTEMPT_SCHEMA)


def modes(spark, mode):
    return spark.createDataFrame([("t", mode)], "table_name string, mode string")


def test_outcomes(spark):
    rows = [
        (1, 1, 200, '{"e":0,"sc":1,"ec":0}', None),                       # ok at 1
        (2, 1, 500, "boom", None), (2, 2, 200, "", None),                  # ok at 2
        (3, 1, 0, None, "Read timed out"), (3, 2, 429, "", None), (3, 3, 200, "not json", None),
        (4, 1, 500, "x", None), (4, 2, 503, "y", None), (4, 3, 500, "z", None),  # never
        (5, 1, 500, "x", None), (5, 2, 500, "x", None),                    # interrupted
        (6, 1, 500, "a", None), (6, 2, 500, "b", None), (6, 3, 500, "c", None), (6, 4, 200, "", None),
        (7, 1, 200, '{"e":0,"sc":3,"ec":2}', None),                        # 200 with ec > 0
    ]
    c = delivery.classify(attempts_df(spark, rows))
    out = {r.request_no: r for r in delivery.outcomes(c, modes(spark, SINGLE)).collect()}
    assert out[1].success and out[1].ok_attempt == 1
    assert out[2].success and out[2].ok_attempt == 2 and out[2].attempts_used == 2
    assert out[3].success and out[3].ok_attempt == 3
    assert not out[4].success and out[4].reason == "Max retries exceeded"
    assert not out[5].success and out[5].reason == "Retry interrupted"
    assert not out[6].success and out[6].attempts_used == 3  # success after attempt 3 ignored
    assert out[7].success
    errs = {(r.request_no, r.attempt): r.error for r in c.collect()}
    assert errs[(3, 1)] == "Connection error: Read timed out"
    assert errs[(4, 3)] == "HTTP 500: z"
    b = {r.request_no: r for r in delivery.outcomes(c, modes(spark, BATCH)).collect()}
    assert b[4].reason == "Batch report failed: HTTP 500: z"
    pe = delivery.partial_errors(c).first()
    assert pe.n_responses == 1 and pe.sum_ec == 2 and pe.sum_sc == 3


def test_failure_rate_window_matches_plain_window(spark):
    rows = [(r, 1, 200 if r % 3 == 0 else 500, "", None) for r in range(300)]
    c = delivery.classify(attempts_df(spark, rows).withColumn(
        "started_at", __import__("pyspark.sql.functions", fromlist=["x"]).timestamp_seconds("request_no")))
    got = {r.request_no: (r.n_calls, r.failure_rate, r.opened) for r in
           delivery.failure_rate_window(c, block_rows=64).collect()}
    # brute force
    fails = [0 if r % 3 == 0 else 1 for r in range(300)]
    prev = False
    for i in range(300):
        win = fails[max(0, i - 9): i + 1]
        rate = round(sum(win) / len(win), 6) if len(win) >= 5 else None
        flag = rate is not None and sum(win) / len(win) >= 0.5
        assert got[i][0] == len(win) and got[i][1] == rate and got[i][2] == (flag and not prev)
        prev = flag


def test_deliver_with_transport(spark):
    from pyspark.sql import functions as F
    ob = spark.createDataFrame([("run", "t", "d", i, "/v2/event/json", 1, "{}") for i in range(6)],
                               "run_id string, table_name string, dt string, request_no long, endpoint string, "
                               "n_records int, body string")

    def transport(endpoint, body):
        return 200, '{"e":0,"sc":1,"ec":0}'

    log = delivery.deliver(ob.repartition(2), transport)
    assert log.count() == 6
    assert log.where(F.col("http_status") != 200).count() == 0
