"""Log files as a source: main log, failed-records file, run summaries.

``read_lines`` gives one row per line. ``read_events`` gives one row per event:
a line that does not open an event (a stack trace) belongs to the one that the
line before it belongs to. Files are read in blocks; a block's events are put
together where it is read, in the order of its lines, and only its edges are
looked at across blocks: the lines before its first header go to the last event
of the nearest block before it that has one. A task holds one event at a time, a
file's window one row per block.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# Layouts of the main log and the failed-records file, and the
# message shapes read back from them.
LOG_TIME = r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{3}"
MAIN_HEADER = rf"^({LOG_TIME}) \[([^\]]*)\] (\S+)\s+\[([^\]]*)\] - "
FAILED_FILE_HEADER = rf"^({LOG_TIME}) - "
ANY_HEADER = rf"^{LOG_TIME} (\[[^\]]*\] \S+\s+\[[^\]]*\] )?- "
FAILED_PARTS = ("FAILED: table=", ", dt=", ", user=", ", reason=", ", record=")
SUMMARY_MSG = r"Summary: total=(\d+), success=(\d+), fail=(\d+)"
ERROR_LEVELS = ("ERROR",)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


PIECES = "file long, block long, piece long, value string, last boolean"


def _pieces(spark: SparkSession, path: str, header: str) -> DataFrame:
    """Events of each block: ``piece`` 0 are the lines before its first header,
    ``last`` marks the one that may go on in the next block."""
    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []  # lines of the event that is open
        where = None               # its (file, block, piece)

        def closed(last: bool) -> pa.RecordBatch:
            text = "\n".join(line for part in held for line in part.to_pylist())
            return pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in where), pa.array([text]), pa.array([last])],
                                              names=["file", "block", "piece", "value", "last"])

        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            lines, file, block = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            opens = pc.match_substring_regex(lines, header).to_numpy(zero_copy_only=False)
            new = (np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1).tolist()
            # runs of one block: the first line of a run goes on with the open event or starts a piece
            for low, high in zip([0, *new], [*new, n]):
                at = (int(file[low]), int(block[low]))
                if where is None or where[:2] != at:
                    if where is not None:
                        yield closed(True)
                    held, where = [], (*at, 1 if opens[low] else 0)
                    first = low + 1
                else:
                    first = low
                heads = (np.flatnonzero(opens[first:high]) + first).tolist()
                held.append(lines.slice(low, (heads[0] if heads else high) - low))
                if not heads:
                    continue
                if sum(map(len, held)):
                    yield closed(False)
                whole, tail = heads[:-1], heads[-1]
                if whole:
                    bounds = pa.array(np.array(heads) - whole[0], pa.int32())
                    texts = pc.binary_join(pa.ListArray.from_arrays(bounds, lines.slice(whole[0], tail - whole[0])), "\n")
                    piece = pa.array(range(where[2] + 1, where[2] + 1 + len(whole)), pa.int64())
                    same = [pa.array([x] * len(whole), pa.int64()) for x in at]
                    yield pa.RecordBatch.from_arrays([*same, piece, texts, pa.array([False] * len(whole))],
                                                     names=["file", "block", "piece", "value", "last"])
                held, where = [lines.slice(tail, high - tail)], (*at, where[2] + len(heads))
        if where is not None:
            yield closed(True)

    lines = spark.read.text(path).select("value", F.xxhash64("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("block"))
    return lines.mapInArrow(put_together, PIECES)


def read_events(spark: SparkSession, path: str, header: str = ANY_HEADER) -> DataFrame:
    """One row per log event of ``path`` in ``value``: its header line and the
    lines up to the next header, joined by line breaks. Lines before a file's
    first header are an event of their own.

    The events of all blocks are written once to the checkpoint folder."""
    kept = f"{checkpoint_dir(spark).rstrip('/')}/log-events-{uuid.uuid4().hex}"
    _pieces(spark, path, header).write.parquet(kept)
    pieces = spark.read.schema(PIECES).parquet(kept)
    # one row per block: the last event so far, of this block or one before it
    edges = pieces.where("last").select("file", "block", F.when(F.col("piece") > 0, F.struct("block", "piece")).alias("open"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    owners = edges.select("file", "block", F.last("open", ignorenulls=True).over(before).alias("owner")).where("owner is not null")
    loose = pieces.where("piece = 0").join(owners, ["file", "block"])
    tails = (loose.groupBy("file", F.col("owner.block").alias("_block"), F.col("owner.piece").alias("_piece"))
             .agg(F.array_sort(F.collect_list(F.struct("block", "value"))).alias("more"))
             .select(F.col("file").alias("_file"), "_block", "_piece", F.transform("more", lambda x: x["value"]).alias("more")))
    # only last pieces go on elsewhere; the others pass the joins by
    whole = pieces.where("piece > 0 and not last").select("value")
    ends = pieces.where("piece > 0 and last")
    ends = ends.join(tails, (ends["file"] == F.col("_file")) & (ends["block"] == F.col("_block")) & (ends["piece"] == F.col("_piece")), "left")
    ends = ends.select(F.when(F.col("more").isNull(), F.col("value")).otherwise(F.concat_ws("\n", "value", "more")).alias("value"))
    headless = (pieces.where("piece = 0").join(owners, ["file", "block"], "left_anti").groupBy("file")
                .agg(F.array_sort(F.collect_list(F.struct("block", "value"))).alias("more"))
                .select(F.array_join(F.transform("more", lambda x: x["value"]), "\n").alias("value")))
    return whole.unionByName(ends).unionByName(headless)


def _after(v: Column, header: Column) -> Column:
    return F.substring(v, F.length(header) + 1, F.length(v))


def parse_main(lines: DataFrame, col: str = "value") -> DataFrame:
    """``<ts> [<thread>] <LEVEL> [<logger>] - <msg>`` → columns, of lines or whole
    events; a text that has no such header keeps only ``msg``."""
    head = lines.select(F.col(col).alias("_v"), F.regexp_extract(col, MAIN_HEADER, 0).alias("_h"))
    names = ["log_ts", "thread", "level", "logger"]
    parts = [F.when(F.col("_h") != "", F.regexp_extract("_h", MAIN_HEADER, i)).alias(n) for i, n in enumerate(names, 1)]
    return head.select(*parts, _after(F.col("_v"), F.col("_h")).alias("msg"))


def errors_only(parsed: DataFrame) -> DataFrame:
    """The error-file routing: ERROR and above. Over :func:`read_events` an
    event keeps its stack trace."""
    return parsed.where(F.col("level").isin(*ERROR_LEVELS))


def parse_failed(lines: DataFrame, col: str = "value") -> DataFrame:
    """Failed-record lines (file layout ``<ts> - FAILED: ...`` or main-log
    layout) → log_ts, table_name, dt, user_masked, reason, record_json. A reason
    may hold newlines; the record starts at the first ``, record={``."""
    v = F.col(col)
    head = F.regexp_extract(v, ANY_HEADER, 0)
    m = lines.select(v.alias("_v"), head.alias("_h")).select(
        F.when(F.col("_h") != "", F.substring("_h", 1, 23)).alias("log_ts"), _after(F.col("_v"), F.col("_h")).alias("_m"))
    m = m.where(F.col("_m").startswith(FAILED_PARTS[0]))
    # each part starts after the first mark that follows the part before it
    at = F.lit(len(FAILED_PARTS[0]) + 1)
    for k, mark in enumerate(FAILED_PARTS[1:4]):
        m = m.withColumn(f"_p{k}", F.locate(mark, F.col("_m"), 1) if k == 0 else F.expr(f"locate('{mark}', _m, greatest(_p{k - 1}, 1))"))
    record = FAILED_PARTS[4]
    brace = F.expr(f"locate('{record}{{', _m, greatest(_p2, 1))")
    null = F.when(F.col("_m").endswith(f"{record}null"), F.length("_m") - len(f"{record}null") + 1)
    m = m.withColumn("_p3", F.least(F.nullif(brace, F.lit(0)), null))
    m = m.where("_p0 > 0 and _p1 > 0 and _p2 > 0 and _p3 >= _p2")

    def part(low: Column, mark: str, high: str) -> Column:
        return F.substring(F.col("_m"), low + len(mark), F.col(high) - low - len(mark))

    return m.select("log_ts", part(at - len(FAILED_PARTS[0]), FAILED_PARTS[0], "_p0").alias("table_name"),
                    part(F.col("_p0"), FAILED_PARTS[1], "_p1").alias("dt"), part(F.col("_p1"), FAILED_PARTS[2], "_p2").alias("user_masked"),
                    part(F.col("_p2"), FAILED_PARTS[3], "_p3").alias("reason"),
                    F.substring(F.col("_m"), F.col("_p3") + len(record), F.length("_m")).alias("record_json"))


def parse_summary(parsed: DataFrame) -> DataFrame:
    """``Summary: total=…, success=…, fail=…`` messages → bigint counts."""
    m = parsed.where(F.col("msg").rlike(SUMMARY_MSG))
    return m.select("log_ts", *[F.regexp_extract("msg", SUMMARY_MSG, i).cast("bigint").alias(n)
                                for i, n in enumerate(["total", "success", "fail"], 1)])


# -- writing logs of a run (same layouts) ---------------------------------------

def one_line(msg: Column) -> Column:
    """Line breaks as ``\\n`` and ``\\r``: a message is one line of a text file."""
    return F.replace(F.replace(msg, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def main_line(ts: Column, level: str, logger: str, msg: Column, thread: str = "main") -> Column:
    return F.format_string(f"%s [{thread}] %-5s [{logger}] - %s", ts, F.lit(level), one_line(msg))


def failed_file_line(ts: Column, msg: Column) -> Column:
    return F.format_string("%s - %s", ts, one_line(msg))
