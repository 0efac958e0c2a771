"""Delivered keys: equal to the plain anti-join, without a shuffle of the keys."""
import random

from pyspark.sql import functions as F

from relaykit.operators import dedupe, delivered
from relaykit.streaming import runner

SCHEMA = "n long, table_name string, dt string, user_unique_id string, et long, params string"


def events(spark, n=3000, seed=1):
    rnd = random.Random(seed)
    rows = [(k, rnd.choice(["pay", None]), f"2024-01-{rnd.randint(1, 9):02d}", rnd.choice([f"u{rnd.randint(1, 300)}", None, ""]),
             rnd.choice([None, rnd.randint(1, 50)]), rnd.choice(["{}", None, '{"a":1}'])) for k in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def store(spark, **kw):
    return delivered.DeliveredKeys(spark, runner.scratch_path(spark, "t-delivered"), **{"buckets": 4, "capacity": 10_000} | kw)


def test_equals_the_plain_anti_join_over_runs(spark):
    ev, keys = events(spark), store(spark)
    assert keys.not_delivered(ev).count() == 3000  # nothing delivered yet
    for part in ("n % 5 = 0", "n % 5 = 1", "n % 5 = 1"):  # one run's keys are added twice
        keys.add(ev.where(part))
    got = keys.not_delivered(ev)
    plain = dedupe.not_yet_delivered(ev, ev.where("n % 5 < 2").select(dedupe.delivery_key().alias("delivery_key")))
    assert sorted(r.n for r in got.collect()) == sorted(r.n for r in plain.collect())
    assert got.columns == [*ev.columns, "delivery_key"]
    assert keys.not_delivered(ev.where("false")).collect() == []


def test_filter_knows_every_key_and_few_others(spark):
    ev, keys = events(spark, 4000, 2).dropDuplicates(["table_name", "dt", "user_unique_id", "et", "params"]), store(spark, capacity=4000)
    keys.add(ev.where("n % 2 = 0"))
    f = keys.flagged(ev).groupBy((F.col("n") % 2).alias("odd")).agg(F.avg(F.col("maybe").cast("int")).alias("share")).collect()
    share = {r.odd: r.share for r in f}
    assert share[0] == 1.0 and share[1] < 0.05
    full = store(spark, capacity=10)  # far beyond its capacity: still exact
    full.add(ev.where("n % 2 = 0"))
    assert {r.n % 2 for r in full.not_delivered(ev).collect()} == {1}


def test_keys_are_not_shuffled(spark, capsys):
    ev, keys = events(spark, 100), store(spark, buckets=16)
    keys.add(ev.where("n < 50"))
    keys.not_delivered(ev).explain()
    plan = capsys.readouterr().out
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "FileScan" in line and ("delivered_keys" in line or "delivered_blocks" in line):
            assert "Bucketed: true" in line, line
            depth = len(line) - len(line.lstrip(" :+-"))
            over = []
            for up in reversed(lines[:i]):  # the scan's parents up to the join
                d = len(up) - len(up.lstrip(" :+-"))
                if d < depth:
                    depth = d
                    over.append(up)
                    if "Join" in up:
                        break
            assert not any("Exchange" in x for x in over), over
    assert plan.count("Bucketed: true") >= 2


def test_key_does_not_depend_on_the_processing_time(spark):
    from relaykit.operators import transform
    from relaykit.registry import REGISTRY
    df = spark.createDataFrame([(1, "u", None, "p", None, "d")], "event_id long, user_unique_id string, et long, refer_page_id string, page_id string, dt string")
    keys = {transform.to_payloads(df, REGISTRY.get("page_vidw"), ms).select(dedupe.delivery_key().alias("k")).first().k for ms in (1, 2)}
    assert len(keys) == 1
