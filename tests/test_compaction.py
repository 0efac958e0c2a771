"""Folding the status log in: only touched partitions change, no change counts twice."""
import os

import pytest
from pyspark.sql import functions as F

from relaykit.operators import compaction
from relaykit.operators import status_log as sl
from relaykit.plans import catalog

T0 = "2024-02-01 00:00:00"


def base(spark):
    df = spark.range(1, 101).select(F.when(F.col("id") % 2 == 0, "pay").otherwise("user_info").alias("table_name"), "id",
                                    F.lit(3).alias("report_status"), F.lit(1).alias("retry_count"))
    return df.withColumn("updated_at", F.lit("2024-01-01").cast("timestamp")).withColumn("error_msg", F.lit(None).cast("string"))


def table(spark, tmp_path):
    t = compaction.StatusTable(spark, str(tmp_path / "base"), str(tmp_path / "log"), base(spark).schema, block=10)
    t.create(base(spark))
    return t


def change(spark, ids, seq, status, error=None):
    rows = base(spark).where(F.col("id").isin(ids))
    return sl.status_changes(rows, status, seq, F.lit(T0).cast("timestamp"), F.lit(error) if error else None, bump_retry=error is not None)


def files(t):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{t.base}/rows") for f in names if f.endswith(".parquet")}


def rows(df):
    return sorted(tuple(r) for r in df.select("table_name", "id", "report_status", "retry_count", "updated_at", F.coalesce("error_msg", F.lit("-"))).collect())


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    t = table(spark, tmp_path)
    before = files(t)
    t.append(change(spark, [3, 4, 5], 1, sl.SUCCESS))
    t.append(change(spark, [4, 41], 2, sl.FAILED, "again").unionByName(change(spark, [999], 1, sl.SUCCESS)))
    want = rows(sl.apply_status(base(spark), t.changes(0).drop("batch")))
    assert rows(t.current()) == want and files(t) == before
    assert t.compact() == 2 and t.folded() == 2
    after = files(t)
    touched = {p for p in before | after if any(f"table_name={n}/id_block={b}/" in p for n, b in (("user_info", 0), ("pay", 0), ("user_info", 4)))}
    assert before - touched == after - touched and not (before & after & touched)
    assert rows(t.rows()) == rows(t.current()) == want
    assert t.compact() == 2 and files(t) == after  # nothing new, nothing written


def test_touched_partitions_reach_the_scan(spark, tmp_path, capsys):
    t = table(spark, tmp_path)
    t.append(change(spark, [3], 1, sl.SUCCESS))
    t._pruned(t.changes(0)).explain("formatted")
    assert "dynamicpruning" in capsys.readouterr().out


def test_compaction_that_died_is_finished_or_dropped_once(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    t.append(change(spark, [3, 4], 1, sl.FAILED, "boom"))
    want = rows(sl.apply_status(base(spark), t.changes(0).drop("batch")))
    real = compaction.StatusTable.recover

    # staged in full, then killed before anything was replaced
    calls = []
    monkeypatch.setattr(compaction.StatusTable, "recover", lambda self: calls.append(1) or (real(self) if len(calls) == 1 else (_ for _ in ()).throw(RuntimeError("killed"))))
    with pytest.raises(RuntimeError):
        t.compact()
    monkeypatch.setattr(compaction.StatusTable, "recover", real)
    assert t.folded() == 0 and rows(t.rows()) == rows(base(spark))
    assert rows(t.current()) == want and t.folded() == 1 and rows(t.rows()) == want

    # killed after the rows were replaced, before that was recorded: the same rows again
    t.append(change(spark, [4], 3, sl.FAILED, "boom two"))
    want = rows(t.current())
    monkeypatch.setattr(compaction.StatusTable, "_delete", lambda self, path: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        t.compact()
    monkeypatch.undo()
    t._delete(f"{t.base}/folded/batch=2")
    assert t.recover() == 2 and rows(t.rows()) == want  # retry_count grew once

    # staging without _SUCCESS is dropped
    t.rows().limit(3).drop("error_msg").write.parquet(f"{t.base}/staged/batch=9")
    os.remove(f"{t.base}/staged/batch=9/_SUCCESS")
    assert t.recover() == 2 and rows(t.rows()) == want and not os.path.exists(f"{t.base}/staged/batch=9")


def test_empty_log_and_unfinished_batches(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.compact() == 0 and rows(t.current()) == rows(base(spark))
    n = t.append(change(spark, [3], 1, sl.SUCCESS))
    os.remove(f"{t.log}/batch={n}/_SUCCESS")  # still being written
    assert t.compact() == 0 and t.append(change(spark, [4], 1, sl.SUCCESS)) == n + 1


def test_partitions_follow_the_rows_not_the_ids(spark, monkeypatch):
    for step in (1, 1000, 10 ** 12):
        ids = spark.range(0, 10_000 * step, step).unionByName(spark.createDataFrame([(-10 ** 17,), (10 ** 17,), (None,)], "id long"))
        block = compaction.block_for(ids, 1000)
        sizes = [r["count"] for r in ids.where("id is not null").groupBy(compaction.id_block(block)).count().collect()]
        assert len(sizes) <= 15 and max(sizes) <= 1500
    assert compaction.block_for(spark.range(0)) == compaction.BLOCK_IDS

    # the query's table too: five tables, a block of ids each
    paths, real = {}, catalog.runner.scratch_path
    monkeypatch.setattr(catalog.runner, "scratch_path", lambda s, name: paths.setdefault(name, real(s, name)))
    n = catalog.QUERIES["status_compacted"](spark, "/root/testdata/sf0.001").count()
    found = [d for d, _, names in os.walk(f"{paths['status']}/rows") if any(f.endswith(".parquet") for f in names)]
    assert n == 1500 and len(found) <= 10
