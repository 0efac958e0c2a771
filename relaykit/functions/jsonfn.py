"""JSON encode/decode helpers (Spark's built-in Jackson-backed functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WITH_NULLS = {"ignoreNullFields": "false"}

# API response body: error code, message, success count, error count.
RESPONSE_SCHEMA = T.StructType([
    T.StructField("e", T.IntegerType()),
    T.StructField("message", T.StringType()),
    T.StructField("sc", T.IntegerType()),
    T.StructField("ec", T.IntegerType()),
])


def record_json(*cols: Column | str) -> Column:
    """Object with every field, nulls written out (null struct → null)."""
    return F.to_json(F.struct(*cols), WITH_NULLS)


def struct_json(c: Column) -> Column:
    return F.to_json(c, WITH_NULLS)


def pretty_json(c: Column) -> Column:
    return F.to_json(c, {"pretty": "true", "ignoreNullFields": "false"})


def map_json(c: Column) -> Column:
    """Map → JSON object; null or empty map → ``{}``; null values written."""
    return F.coalesce(F.to_json(c, WITH_NULLS), F.lit("{}"))


def parse_typed(c: Column, schema: T.StructType | str, strict: bool = False) -> Column:
    """Typed parse; null/'' → null. ``strict`` raises on a malformed document,
    otherwise a malformed document becomes a struct of nulls (quarantine it
    with :func:`is_malformed`)."""
    opts = {"mode": "FAILFAST"} if strict else {"mode": "PERMISSIVE"}
    return F.when(F.coalesce(F.length(c), F.lit(0)) > 0, F.from_json(c, schema, opts))


def parse_map(c: Column) -> Column:
    """Generic object → map<string,string> (nested values kept as JSON text)."""
    return F.when(F.coalesce(F.length(c), F.lit(0)) > 0,
                  F.from_json(c, T.MapType(T.StringType(), T.StringType())))


def parse_variant(c: Column) -> Column:
    """Any JSON → VARIANT, which keeps nesting, numbers and booleans as they are;
    null, '' and malformed texts → null (see :func:`is_malformed`)."""
    return F.when(F.coalesce(F.length(c), F.lit(0)) > 0, F.try_parse_json(c))


def variant_field(v: Column, path: str, type_: str = "string") -> Column:
    """Value at a JSON path as ``type_``; null where it is missing or of another kind."""
    return F.try_variant_get(v, path, type_)


def variant_kind(v: Column) -> Column:
    """Type of a VARIANT as Spark writes it (``BIGINT``, ``ARRAY<...>``, ``OBJECT<...>``)."""
    return F.schema_of_variant(v)


def is_malformed(c: Column) -> Column:
    """True when a non-empty text is not one JSON object or array."""
    return ((F.coalesce(F.length(c), F.lit(0)) > 0)
            & F.json_object_keys(c).isNull() & F.json_array_length(c).isNull())
