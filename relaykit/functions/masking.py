"""Masking of user ids, JSON secrets and URLs, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The redaction marker, the id length at or below which the
# whole id is hidden, the JSON keys whose string values are redacted, and the
# URL parameter fragments that trigger query-string removal.
MASK = "***"
SHORT_ID_MAX = 8
SECRET_JSON_KEYS = ("password", "appKey", "token", "secret", "apiKey", "api_key")
SECRET_URL_MARKERS = ("key=", "token=", "password=", "secret=")

# Key, optional blanks, colon, optional blanks, opening quote; the value runs
# to the next quote. Case-sensitive, non-string values are left alone.
SECRET_JSON_PATTERN = '("(?:' + "|".join(SECRET_JSON_KEYS) + r')"\s*:\s*")[^"]*'


def mask_user_id(c: Column) -> Column:
    """Null, empty or ≤ 8 chars → ``***``; else first 4 + ``***`` + last 4."""
    return (F.when(c.isNull() | (F.char_length(c) <= SHORT_ID_MAX), F.lit(MASK))
            .otherwise(F.concat(F.substring(c, 1, 4), F.lit(MASK), F.right(c, F.lit(4)))))


def mask_json(c: Column) -> Column:
    """Redact string values of the secret keys; null and '' pass through."""
    return F.regexp_replace(c, SECRET_JSON_PATTERN, "$1" + MASK)


def mask_url(c: Column) -> Column:
    """Drop the query string when it may carry a secret.

    The marker may appear anywhere in the URL (also before ``?``), as long as
    the URL has a ``?`` at all.
    """
    hit = F.lit(False)
    for m in SECRET_URL_MARKERS:
        hit = hit | c.contains(m)
    return (F.when(c.contains("?") & hit,
                   F.concat(F.substring_index(c, "?", 1), F.lit("?" + MASK)))
            .otherwise(c))
