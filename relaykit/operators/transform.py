"""Row → payload transform (projection, params JSON, payload struct/JSON).

Everything is a ``select`` of Catalyst expressions: no UDF, no per-row Python.
The output of every table has the same schema, so all tables of a run can
be unioned and processed by one job.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coercion import event_time_ms, to_long, to_string
from ..functions.jsonfn import WITH_NULLS
from ..registry import REGISTRY, REPORT_TYPE_VALUE, Registry, TableSpec

PAYLOAD_JSON_SCHEMA = "user, header, events"


def empty_header() -> Column:
    """The always-empty header map (``{}`` in JSON)."""
    return F.create_map().cast(T.MapType(T.StringType(), T.StringType()))


def project(df: DataFrame, spec: TableSpec, key_cols: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """Registry projection: keys and dt, then user id, [et,] params in order."""
    keep = [c for c in (*key_cols, "dt") if c in df.columns]
    return df.select(*keep, *spec.select_fields())


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def params_sql(spec: TableSpec, columns: list[str]) -> str:
    """SQL text of the params object (see :func:`params_json`)."""
    parts = []
    if spec.needs_report_type:
        parts.append(f"'report_type', {_text(REPORT_TYPE_VALUE)}")
    for f in spec.param_fields:
        parts.append(f"{_text(f)}, " + (_ident(f) if f in columns else "CAST(NULL AS STRING)"))
    return f"to_json(named_struct({', '.join(parts)}))" if parts else "'{}'"


def record_sql(spec: TableSpec, columns: list[str]) -> str:
    """SQL text of the source record as JSON with nulls written."""
    fields = [c for c in spec.select_fields() if c in columns]
    inner = ", ".join(f"{_text(c)}, {_ident(c)}" for c in fields)
    return f"to_json(named_struct({inner}), map('ignoreNullFields', 'false'))"


def payload_sql(event_name: str, user: str = "user_unique_id", params: str = "params",
                time_ms: str = "local_time_ms") -> str:
    """SQL text of the payload struct over already computed columns."""
    return ("named_struct("
            f"'user', named_struct('user_unique_id', CAST({_ident(user)} AS STRING), "
            "'device_id', CAST(NULL AS STRING), 'web_id', CAST(NULL AS STRING)), "
            "'header', CAST(map() AS MAP<STRING, STRING>), "
            f"'events', array(named_struct('event', {_text(event_name)}, 'params', {_ident(params)}, "
            f"'local_time_ms', CAST({_ident(time_ms)} AS BIGINT))))")


def params_json(df: DataFrame, spec: TableSpec) -> Column:
    """Ordered params object: report_type first when the table needs it, then
    the non-null fields in registry order. Numbers stay numbers; all-null
    gives ``{}`` (or only report_type). ``to_json`` drops null fields."""
    return F.expr(params_sql(spec, df.columns))


def local_time_ms(df: DataFrame, spec: TableSpec, ingest_ms: int) -> Column:
    if spec.has_et and "et" in df.columns:
        return event_time_ms(F.col("et"), ingest_ms, df.schema["et"].dataType)
    return event_time_ms(None, ingest_ms)


def raw_et(df: DataFrame, spec: TableSpec) -> Column:
    """The source's event time (ms), null where it has none."""
    if spec.has_et and "et" in df.columns:
        return to_long(F.col("et"), df.schema["et"].dataType)
    return F.lit(None).cast("long")


def payload_struct(user_id: Column, event_name: Column, params: Column, time_ms: Column) -> Column:
    user = F.struct(to_string(user_id).alias("user_unique_id"),
                    F.lit(None).cast("string").alias("device_id"),
                    F.lit(None).cast("string").alias("web_id"))
    event = F.struct(event_name.alias("event"), params.alias("params"),
                     time_ms.cast("bigint").alias("local_time_ms"))
    return F.struct(user.alias("user"), empty_header().alias("header"),
                    F.array(event).alias("events"))


def payload_json(payload: Column) -> Column:
    """Request JSON of one payload; null user fields are written as null."""
    return F.to_json(payload, WITH_NULLS)


def to_payloads(df: DataFrame, spec: TableSpec, ingest_ms: int,
                key_cols: tuple[str, ...] = ("event_id",), with_record: bool = False,
                reject_if: Column | None = None, reject_reason: str = "Transform failed") -> DataFrame:
    """One payload per source row of ``spec``'s table.

    Output: table_name, dt, key columns, user_unique_id, params, et, local_time_ms,
    payload (struct), body (JSON), error (null for good rows), and with
    ``with_record`` the full source row as JSON (for dead letters).
    ``reject_if`` marks rows as failed transforms (they are kept, with the
    reason in ``error``, so the caller splits good and bad from one plan).
    """
    keys = [c for c in key_cols if c in df.columns]
    error = F.lit(None).cast("string")
    if reject_if is not None:
        error = F.when(reject_if, F.lit(reject_reason))
    # expressions as SQL text: parsed once on the JVM side, same plan
    first = [F.lit(spec.table_name).alias("table_name"), F.col("dt").cast("string").alias("dt"),
             *[F.col(k) for k in keys],
             to_string(F.col("user_unique_id")).alias("user_unique_id"),
             F.expr(params_sql(spec, df.columns)).alias("params"),
             raw_et(df, spec).alias("et"),
             local_time_ms(df, spec, ingest_ms).alias("local_time_ms"), error.alias("error")]
    if with_record:
        first.append(F.expr(record_sql(spec, df.columns)).alias("record_json"))
    staged = df.select(*first)
    payload = F.expr(payload_sql(spec.event_name))
    rest = [c for c in staged.columns if c != "error"]
    return staged.select(*rest, payload.alias("payload"),
                         F.expr(f"to_json({payload_sql(spec.event_name)}, map('ignoreNullFields', 'false'))")
                         .alias("body"), "error")


def unknown_rows(df: DataFrame, name: str, ingest_ms: int, key_cols: tuple[str, ...] = ("event_id",),
                 with_record: bool = False) -> DataFrame:
    """Rows of a table that the registry does not know, as failed transforms:
    no payload, the reason in ``error``, all columns in the record."""
    has = set(df.columns)
    user = to_string(F.col("user_unique_id")) if "user_unique_id" in has else F.lit(None).cast("string")
    spec = TableSpec(name, name, ())
    first = [F.lit(name).alias("table_name"), (F.col("dt") if "dt" in has else F.lit(None)).cast("string").alias("dt"),
             *[F.col(k) if k in has else F.lit(None).cast("long").alias(k) for k in key_cols], user.alias("user_unique_id"),
             F.lit(None).cast("string").alias("params"), raw_et(df, spec).alias("et"), local_time_ms(df, spec, ingest_ms).alias("local_time_ms")]
    record = [F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), WITH_NULLS).alias("record_json")] if with_record else []
    payload = payload_struct(F.col("user_unique_id"), F.lit(name), F.col("params"), F.col("local_time_ms"))
    rows = df.select(*first, *record)
    typed = rows.select(payload.alias("payload")).schema["payload"].dataType
    return rows.select("*", F.lit(None).cast(typed).alias("payload"), F.lit(None).cast("string").alias("body"),
                       F.lit(f"Unknown table name: {name}").alias("error"))


def payloads_all(tables: Mapping[str, DataFrame], ingest_ms: int, registry: Registry = REGISTRY,
                 key_cols: tuple[str, ...] = ("event_id",), with_record: bool = False,
                 reject_if: Mapping[str, Column] | None = None, reject_unknown: bool = False) -> DataFrame:
    """Payloads of every registered table in ``tables``, as one DataFrame.

    Unknown names raise (``Unknown table name``) before any job runs; with
    ``reject_unknown`` their rows become failed transforms instead (see
    :func:`unknown_rows`), and the other tables go on.
    """
    parts = []
    for name, df in tables.items():
        spec = registry.get(name)
        if spec is None and reject_unknown:
            parts.append(unknown_rows(df, name, ingest_ms, key_cols, with_record))
            continue
        if spec is None:
            raise ValueError(f"Unknown table name: {name}")
        rej = (reject_if or {}).get(name)
        parts.append(to_payloads(project(df, spec, key_cols), spec, ingest_ms, key_cols,
                                 with_record, rej))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
