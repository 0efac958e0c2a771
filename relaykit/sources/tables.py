"""Table sources.

Two ways to get the reported tables:

* ``read_partitioned`` — the production layout: one Parquet (or Hive) table
  per registry entry, partitioned by a string ``dt`` column. The ``dt``
  predicate becomes a partition filter and the registry projection becomes
  the read schema, so only the needed files and columns are touched.
* ``driver_tables`` — views of the given test tables as the five reported
  tables (``events`` split by event type). The mapping is fixed so results
  can be checked against SQL on the same files.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..registry import REGISTRY, Registry, TableSpec
from ..session import session_key

# Physical types of the reported tables (after dt and user_unique_id).
FIELD_TYPES: dict[str, T.DataType] = {
    "et": T.LongType(),
    "refer_page_id": T.StringType(), "page_id": T.StringType(),
    "click_type": T.StringType(), "click_position": T.StringType(),
    "click_name": T.StringType(), "click_area": T.StringType(),
    "pay_type": T.StringType(), "pay_amount": T.DecimalType(10, 2),
    "package_type": T.StringType(), "package_id": T.StringType(),
    "package_name": T.StringType(), "is_ai": T.IntegerType(),
    "pay_result": T.StringType(), "source": T.StringType(), "device": T.StringType(),
    "device_type": T.StringType(), "sale_channel": T.StringType(), "sd_card": T.StringType(),
    "device_first_time": T.LongType(), "cloud_expire_time": T.LongType(),
    "reg_time": T.LongType(), "ys_dev_cnt": T.IntegerType(), "user_add_day": T.IntegerType(),
}


def table_schema(spec: TableSpec, key_col: str | None = "event_id") -> T.StructType:
    fields = []
    own = {n: T.DataType.fromDDL(t) for n, t in spec.field_types}
    if key_col:
        fields.append(T.StructField(key_col, T.LongType()))
    fields.append(T.StructField("user_unique_id", T.StringType()))
    for f in spec.select_fields()[1:]:
        fields.append(T.StructField(f, own.get(f, FIELD_TYPES.get(f, T.StringType()))))
    fields.append(T.StructField("dt", T.StringType()))
    return T.StructType(fields)


def read_partitioned(spark: SparkSession, path: str, spec: TableSpec,
                     dates: Iterable[str] | Column | None = None,
                     key_col: str | None = "event_id") -> DataFrame:
    """Scan ``path`` (Hive-style ``dt=...`` folders) for the given dates.

    ``dates`` is a list of ``dt`` strings or a boolean Column over ``dt``; the
    predicate reaches the scan as a partition filter. The schema is explicit,
    so no file footers are sampled and ``dt`` stays a string.
    """
    df = spark.read.schema(table_schema(spec, key_col)).parquet(path)
    return df.where(dt_predicate(dates)) if dates is not None else df


#: Copies of one row that a task numbers at a time.
COPY_BLOCK = 4096


def has_column(spark: SparkSession, path: str, col: str) -> bool:
    """Whether the files of ``path`` hold ``col`` (a path without files: yes)."""
    try:
        return col in spark.read.parquet(path).schema.names
    except AnalysisException:
        return True


def with_row_key(df: DataFrame, key_col: str = "event_id") -> DataFrame:
    """A key for rows without one: a hash of all columns and the number of the
    copy. Identical rows are counted first (map-side too), so many copies of
    one row neither meet in a task nor share a key; the counted copies are dealt
    out in blocks. Half of the hash's range is used, so that keys can be
    subtracted. Keys of different rows may, rarely, be equal."""
    cols = df.columns
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    last = F.floor((F.col("_n") - 1) / COPY_BLOCK).cast("long")
    blocks = counted.select(*cols, "_n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_block"))
    first = F.col("_block") * COPY_BLOCK
    copies = blocks.repartition(F.xxhash64(*cols, "_block")).select(
        *cols, F.explode(F.sequence(first, F.least(first + COPY_BLOCK, F.col("_n")) - 1)).alias("_copy"))
    return copies.select(F.shiftright(F.xxhash64(*cols, "_copy"), 1).alias(key_col), *cols)


def dt_predicate(dates: Iterable[str] | Column | str) -> Column:
    if isinstance(dates, Column):
        return dates
    if isinstance(dates, str):
        return F.col("dt") == F.lit(dates)
    return F.col("dt").isin([str(d) for d in dates])


def date_range(start: str, end: str) -> Column:
    """``dt`` within [start, end], both ends included, compared as text.

    For ``yyyy-MM-dd`` strings the text order is the date order, so this is a
    range partition filter without a list of dates.
    """
    return (F.col("dt") >= F.lit(start)) & (F.col("dt") <= F.lit(end))


_READS: dict[tuple, DataFrame] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; the DataFrame (plan only, no data) is reused
    within a session so footers are listed once."""
    k = (session_key(spark), f"{sf_dir}/{name}.parquet")
    if k not in _READS:
        _READS[k] = spark.read.parquet(k[1])
    return _READS[k]


# ---------------------------------------------------------------------------
# Views of the driver's test tables as the reported tables.
# Fixed mapping: event type → table.
EVENT_TYPE_OF = {
    "page_vidw": "view",
    "element_click": "click",
    "pay": "purchase",
    "pay_result": "error",
    "user_info": "signup",
}


def events_base(spark: SparkSession, sf_dir: str, dt_granularity: str = "day") -> DataFrame:
    """``events`` with dt, user id, et (ms) and the two numeric inputs.

    Every 11th row has no ``et``, every 13th a short user id.
    ``dt_granularity='month'`` uses ``yyyy-MM`` as the partition so a single
    partition has enough rows for paging to matter.
    """
    return events_view(load(spark, sf_dir, "events"), dt_granularity)


def events_view(ev: DataFrame, dt_granularity: str = "day") -> DataFrame:
    """:func:`events_base` over an events DataFrame (batch or micro-batch)."""
    day = F.col("ts").cast("date").cast("string")
    dt = day if dt_granularity == "day" else F.substring(day, 1, 7)
    uid = F.col("user_id").cast("string")
    return ev.select(
        "event_id", "event_type", dt.alias("dt"),
        F.when(F.col("event_id") % 13 == 0, F.concat(F.lit("u"), uid))
        .otherwise(F.concat(F.lit("user_"), F.lpad(uid, 8, "0"))).alias("user_unique_id"),
        F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("bigint"))
        .otherwise(F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts) div 1000"))
        .alias("et"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.col("value").cast(T.DecimalType(10, 2)).alias("amount"),
    )


def _s(c: Column) -> Column:
    return c.cast("string")


def _null(t: str) -> Column:
    return F.lit(None).cast(t)


def _view_columns(name: str) -> list[Column]:
    k, eid = F.col("k"), F.col("event_id")
    if name == "page_vidw":
        return [F.when(k % 5 == 0, _null("string")).otherwise(F.concat(F.lit("page_"), _s(k % 10))).alias("refer_page_id"),
                F.concat(F.lit("page_"), _s(k)).alias("page_id")]
    if name == "element_click":
        return [F.when(k % 2 == 0, F.lit("tap")).otherwise(F.lit("long_press")).alias("click_type"),
                F.concat(F.lit("pos_"), _s(k % 4)).alias("click_position"),
                F.concat(F.lit("btn_"), _s(k)).alias("click_name"),
                F.when(k % 7 == 0, _null("string")).otherwise(F.concat(F.lit("area_"), _s(k % 6))).alias("click_area")]
    if name == "pay":
        return [F.when(k % 2 == 0, F.lit("card")).otherwise(F.lit("wallet")).alias("pay_type"),
                F.col("amount").alias("pay_amount"),
                F.when(k % 3 == 0, _null("string")).otherwise(F.lit("cloud")).alias("package_type"),
                F.concat(F.lit("pkg_"), _s(k)).alias("package_id"),
                F.concat(F.lit("Package "), _s(k)).alias("package_name"),
                (k % 2).alias("is_ai")]
    if name == "pay_result":
        return [F.when(k % 4 == 0, F.lit("fail")).otherwise(F.lit("ok")).alias("pay_result"),
                F.when(k % 2 == 0, F.lit("card")).otherwise(F.lit("wallet")).alias("pay_type"),
                F.col("amount").alias("pay_amount"),
                F.lit("cloud").alias("package_type"),
                F.concat(F.lit("pkg_"), _s(k)).alias("package_id"),
                F.concat(F.lit("Package "), _s(k)).alias("package_name"),
                (k % 2).alias("is_ai"),
                F.when(k % 3 == 0, _null("string")).otherwise(F.lit("app")).alias("source"),
                F.concat(F.lit("dev_"), _s(eid)).alias("device"),
                F.concat(F.lit("type_"), _s(k % 3)).alias("device_type"),
                F.when(k % 5 == 0, _null("string")).otherwise(F.lit("store")).alias("sale_channel"),
                F.when(k % 2 == 0, F.lit("yes")).otherwise(_null("string")).alias("sd_card"),
                F.when(k % 6 == 0, _null("bigint")).otherwise(F.lit(1600000000000) + eid).alias("device_first_time"),
                F.when(k % 6 == 1, _null("bigint")).otherwise(F.lit(1800000000000) + eid).alias("cloud_expire_time")]
    if name == "user_info":
        return [(F.lit(1600000000000) + eid).alias("reg_time"),
                F.when(k % 5 == 0, _null("int")).otherwise(k % 5).alias("ys_dev_cnt"),
                k.alias("user_add_day")]
    raise KeyError(name)


_BASES: dict[tuple, DataFrame] = {}


def driver_table(spark: SparkSession, sf_dir: str, name: str,
                 dt_granularity: str = "day", registry: Registry = REGISTRY) -> DataFrame:
    """One reported table as a view over ``events`` (key ``event_id``)."""
    spec = registry.get(name)
    k = (session_key(spark), sf_dir, dt_granularity)
    if k not in _BASES:
        _BASES[k] = events_base(spark, sf_dir, dt_granularity)
    base = _BASES[k].where(F.col("event_type") == EVENT_TYPE_OF[name])
    keep = ["event_id", "dt", "user_unique_id"] + (["et"] if spec.has_et else [])
    return base.select(*keep, *_view_columns(name))


def tables_from_events(base: DataFrame, registry: Registry = REGISTRY) -> dict[str, DataFrame]:
    """The five views from an :func:`events_view` DataFrame."""
    out = {}
    for name, etype in EVENT_TYPE_OF.items():
        spec = registry.get(name)
        keep = ["event_id", "dt", "user_unique_id"] + (["et"] if spec.has_et else [])
        out[name] = base.where(F.col("event_type") == etype).select(*keep, *_view_columns(name))
    return out


def driver_tables(spark: SparkSession, sf_dir: str, dt_granularity: str = "day",
                  registry: Registry = REGISTRY, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    names = list(names) if names is not None else [n for n in registry.names() if n in EVENT_TYPE_OF]
    return {n: driver_table(spark, sf_dir, n, dt_granularity, registry) for n in names}


def tracked_rows(spark: SparkSession, sf_dir: str, registry: Registry = REGISTRY, extra: tuple[str, ...] = ()) -> DataFrame:
    """Status-tracked rows (table_name, id, user, report_status, retry_count,
    updated_at) from ``orders``, after its columns ``extra``.

    The order priority's leading digit picks the table (1 → first registry
    table, ...). Half pending, a tenth in flight, a fifth done, a fifth failed.
    """
    o = load(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    names = registry.names()
    digit = F.substring("o_orderpriority", 1, 1).cast("int")
    table = F.element_at(F.array(*[F.lit(n) for n in names]), digit)
    return o.select(
        *extra,
        table.alias("table_name"),
        key.alias("id"),
        F.concat(F.lit("user_"), F.lpad(F.col("o_custkey").cast("string"), 8, "0")).alias("user_unique_id"),
        F.when(key % 10 < 5, 0).when(key % 10 == 5, 1).when(key % 10 < 8, 2).otherwise(3).alias("report_status"),
        F.when(key % 10 >= 8, (key % 5).cast("int")).otherwise(F.lit(0)).alias("retry_count"),
        F.col("o_orderdate").alias("updated_at"),
    )


def tracked_tables(spark: SparkSession, sf_dir: str, registry: Registry = REGISTRY) -> dict[str, DataFrame]:
    """:func:`tracked_rows` by table, with registry fields taken from ``orders``."""
    rows = tracked_rows(spark, sf_dir, registry, ("o_totalprice", "o_orderstatus"))
    price = F.col("o_totalprice").cast(T.DecimalType(10, 2))
    fields = {
        "page_vidw": {"page_id": F.concat(F.lit("page_"), _s(F.col("id") % 100))},
        "element_click": {"click_name": F.concat(F.lit("btn_"), _s(F.col("id") % 50))},
        "pay": {"pay_amount": price, "is_ai": (F.col("id") % 2).cast("int")},
        "pay_result": {"pay_result": F.col("o_orderstatus"), "pay_amount": price},
        "user_info": {"user_add_day": (F.col("id") % 1000).cast("int")},
    }
    return {n: rows.where(F.col("table_name") == n).select("id", "user_unique_id", "report_status", "retry_count",
                                                           *[c.alias(f) for f, c in fields.get(n, {}).items()])
            for n in registry.names()}
