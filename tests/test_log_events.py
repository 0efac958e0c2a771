"""Multi-line log events over blocks, against reading each file whole."""
import random
import re

import pytest

from relaykit.sources import logs

HEAD = re.compile(logs.ANY_HEADER)


def log_text(seed, n=300):
    rnd, lines = random.Random(seed), []
    for k in range(n):
        level = rnd.choice(["INFO ", "WARN ", "ERROR"])
        if rnd.random() < 0.1:
            lines.append(f"2024-02-01 00:00:0{k % 10}.{k % 1000:03d} - FAILED: table=pay, dt=d, user=u, reason=r{k}, record=null")
        else:
            lines.append(f"2024-02-01 00:00:0{k % 10}.{k % 1000:03d} [main] {level} [a.B] - message {k} é")
        for t in range(rnd.choice([0, 0, 0, 1, 3, 40])):
            lines.append(rnd.choice(["", "\tat x.Y.z(Y.java:1)", f"java.lang.Error: {t}", "2024-02-01 no header"]))
    return lines


def brute(lines):
    events = []
    for line in lines:
        if HEAD.match(line) or not events:
            events.append(line)
        else:
            events[-1] += "\n" + line
    return events


@pytest.mark.parametrize("block", [200, 1500, 128 << 20])
def test_events_over_block_borders(spark, tmp_path, block):
    files = {"a.log": log_text(1), "b.log": ["trace of an older file", "\tat q"] + log_text(2, 60), "c.log": ["only", "loose", "lines"] * 40,
             "d.log": log_text(3, 5) + ["\tat long.Trace(T.java:9)"] * 400 + log_text(4, 5), "e.log": []}
    for name, lines in files.items():
        (tmp_path / name).write_text("".join(f"{x}\n" for x in lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        got = [r.value for r in logs.read_events(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got) == sorted(e for lines in files.values() for e in brute(lines))


def test_errors_keep_their_traces(spark, tmp_path):
    (tmp_path / "x.log").write_text("2024-02-01 00:00:00.000 [main] ERROR [a.B] - boom\n\tat a.B.c\n\tat a.B.d\n"
                                    "2024-02-01 00:00:00.001 [main] INFO  [a.B] - fine\n\tnote\n")
    got = logs.errors_only(logs.parse_main(logs.read_events(spark, str(tmp_path)))).collect()
    assert [tuple(r) for r in got] == [("2024-02-01 00:00:00.000", "main", "ERROR", "a.B", "boom\n\tat a.B.c\n\tat a.B.d")]


def test_parts_of_failed_lines(spark):
    rows = ["FAILED: table=a, dt=, user=, reason=x, dt=y, record=z, record={}", "FAILED: table=a, dt=b, user=c, reason=d",
            "FAILED: table=a, dt=b, user=c, reason=, record=null", "FAILED: table=, dt=d, user=u, reason=a, record=null, record={\"k\":1", "other"]
    pattern = re.compile(r"^FAILED: table=(.*?), dt=(.*?), user=(.*?), reason=(.*?), record=(\{.*|null)$", re.S)
    got = logs.parse_failed(spark.createDataFrame([(r,) for r in rows], "value string")).drop("log_ts").collect()
    assert [tuple(r) for r in got] == [pattern.match(r).groups() for r in rows if pattern.match(r)]
