"""Table registry: which tables are reported, how, and with which fields.

The registry is the single user extension point: ``REGISTRY.register(TableSpec(...))``
adds a table. Lookups that run on data (validation, mode resolution, event
name mapping) are joins against ``registry_df`` — a DataFrame whose size is
the number of registered tables, so broadcasting it is always safe.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SINGLE = "SINGLE"
BATCH = "BATCH"

# Fixed values that must equal the reference for identical payloads.
REPORT_TYPE_VALUE = "poc_v1"
SINGLE_ENDPOINT = "/v2/event/json"
BATCH_ENDPOINT = "/v2/event/list"


@dataclass(frozen=True)
class TableSpec:
    table_name: str
    event_name: str
    param_fields: tuple[str, ...]
    default_mode: str = BATCH
    has_et: bool = True
    needs_report_type: bool = True
    #: Types of fields by name, as DDL (``"decimal(12,2)"``); the others keep the known ones, else text.
    field_types: tuple[tuple[str, str], ...] = ()

    def __post_init__(self):
        unknown = sorted(n for n, _ in self.field_types if n not in self.select_fields())
        if unknown:
            raise ValueError(f"types of fields that {self.table_name} does not have: {', '.join(unknown)}")

    def select_fields(self) -> list[str]:
        """Projection list: user id, optional ``et``, then params in order."""
        return ["user_unique_id", *(["et"] if self.has_et else []), *self.param_fields]


# The five reported tables, their event names, param fields in
# order, default report mode, whether they carry ``et``, and whether params
# start with report_type.
DEFAULT_SPECS = (
    TableSpec("page_vidw", "page_vidw", ("refer_page_id", "page_id"), BATCH, True, True),
    TableSpec("element_click", "element_click",
              ("click_type", "click_position", "click_name", "click_area"), BATCH, True, True),
    TableSpec("pay", "pay",
              ("pay_type", "pay_amount", "package_type", "package_id", "package_name", "is_ai"),
              SINGLE, True, True),
    TableSpec("pay_result", "pay_result",
              ("pay_result", "pay_type", "pay_amount", "package_type", "package_id",
               "package_name", "is_ai", "source", "device", "device_type", "sale_channel",
               "sd_card", "device_first_time", "cloud_expire_time"),
              SINGLE, True, True),
    TableSpec("user_info", "__profile_set", ("reg_time", "ys_dev_cnt", "user_add_day"),
              BATCH, False, False),
)

REGISTRY_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("event_name", T.StringType(), False),
    T.StructField("param_fields", T.ArrayType(T.StringType()), False),
    T.StructField("default_mode", T.StringType(), False),
    T.StructField("has_et", T.BooleanType(), False),
    T.StructField("needs_report_type", T.BooleanType(), False),
    T.StructField("ordinal", T.IntegerType(), False),
])


@dataclass
class Registry:
    specs: dict[str, TableSpec] = field(default_factory=dict)

    def register(self, spec: TableSpec) -> None:
        if spec.default_mode not in (SINGLE, BATCH):
            raise ValueError(f"bad mode {spec.default_mode!r}")
        self.specs[spec.table_name] = spec

    def get(self, table_name: str) -> TableSpec | None:
        return self.specs.get(table_name)

    def is_valid(self, table_name: str | None) -> bool:
        return table_name is not None and table_name in self.specs

    def names(self) -> list[str]:
        return list(self.specs)

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(s.table_name, s.event_name, list(s.param_fields), s.default_mode,
                 s.has_et, s.needs_report_type, i) for i, s in enumerate(self.specs.values())]
        return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def default_registry() -> Registry:
    reg = Registry()
    for s in DEFAULT_SPECS:
        reg.register(s)
    return reg


REGISTRY = default_registry()


def parse_mode(c: Column) -> Column:
    """Mode text → SINGLE/BATCH: trimmed, case-insensitive; anything else BATCH."""
    return F.when(F.upper(F.trim(c)) == F.lit(SINGLE), F.lit(SINGLE)).otherwise(F.lit(BATCH))


def parse_table_list(text: str) -> list[str]:
    """``a, b,c`` → names in order. Trimmed (the reference does not trim)."""
    return [t.strip() for t in text.split(",") if t.strip()]


def resolve_modes(registry_df: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """(table_name, mode): override for a known table, else the default.

    ``overrides`` has (table_name, mode) with raw mode text; overrides for
    unknown tables are ignored, as are duplicates beyond the last listed.
    """
    reg = registry_df.select("table_name", "default_mode", "ordinal")
    if overrides is None:
        return reg.select("table_name", F.col("default_mode").alias("mode"), "ordinal")
    ov = overrides.select("table_name", parse_mode(F.col("mode")).alias("override_mode"))
    return (reg.join(F.broadcast(ov), "table_name", "left")
            .select("table_name",
                    F.coalesce("override_mode", "default_mode", F.lit(BATCH)).alias("mode"),
                    "ordinal"))


def mode_map(registry: Registry, overrides: dict[str, str] | None = None) -> dict[str, str]:
    """Mode per registered table from configuration alone (no job):
    override for a known table (trimmed, case-insensitive; else BATCH),
    otherwise the registry default."""
    out = {}
    for name, spec in registry.specs.items():
        raw = (overrides or {}).get(name)
        if raw is None:
            out[name] = spec.default_mode
        else:
            out[name] = SINGLE if raw.strip().upper() == SINGLE else BATCH
    return out


def mode_for_names(names: DataFrame, registry_df: DataFrame,
                   overrides: DataFrame | None = None) -> DataFrame:
    """Mode per requested name; names not in the registry get BATCH."""
    modes = resolve_modes(registry_df, overrides).select("table_name", "mode")
    return (names.join(F.broadcast(modes), "table_name", "left")
            .select("table_name", F.coalesce("mode", F.lit(BATCH)).alias("mode")))


def validate_tables(names: DataFrame, registry_df: DataFrame) -> DataFrame:
    """(table_name, is_valid) for requested names; null and '' are invalid."""
    known = registry_df.select("table_name", F.lit(True).alias("_known"))
    return (names.join(F.broadcast(known), "table_name", "left")
            .select("table_name", F.coalesce("_known", F.lit(False)).alias("is_valid")))
