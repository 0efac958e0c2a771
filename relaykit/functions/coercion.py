"""Value coercions used when a source row becomes a payload.

All are Catalyst expressions (no UDF), so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whole string must be an optionally signed run of ASCII digits; no blanks,
# no decimals. try_cast alone would accept ' 12 '.
_LONG_TEXT = r"\A[+-]?[0-9]+\z"


def to_string(c: Column) -> Column:
    """null → null, anything else its text form."""
    return c.cast(T.StringType())


def to_long(c: Column, source_type: T.DataType | None = None) -> Column:
    """Long coercion: numbers truncate toward zero, text must be a plain integer.

    ``source_type`` is the column's type when known (it picks the numeric or
    the text rule at plan time). Out-of-range values become null.
    """
    if source_type is not None and isinstance(source_type, T.NumericType):
        if isinstance(source_type, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
            return c.cast(T.LongType())
        return c.try_cast(T.LongType())
    text = c.cast(T.StringType())
    return F.when(text.rlike(_LONG_TEXT), text.try_cast(T.LongType()))


def event_time_ms(et: Column | None, ingest_ms: int, et_type: T.DataType | None = None) -> Column:
    """``et`` when present and coercible, else the run's ingest time (ms).

    ``ingest_ms`` is a job parameter, so a rerun produces identical payloads.
    """
    fallback = F.lit(int(ingest_ms)).cast(T.LongType())
    if et is None:
        return fallback
    return F.coalesce(to_long(et, et_type), fallback)
