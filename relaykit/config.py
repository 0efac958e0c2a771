"""Job settings from a ``key=value`` properties file.

Keys (all optional): ``event.tables`` (comma list), ``report.mode.<table>``,
``batch.report.size`` (1..50), ``batch.db.size`` (page size, 1..10000),
``retry.max.times`` (0..10, the retry limit of the status-tracked path).
A malformed number falls back to its default with a warning; a malformed
boolean reads as false. Out-of-range values are rejected.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass, field

from .plans.report_run import RunConfig, parse_overrides
from .registry import REGISTRY, parse_table_list

log = logging.getLogger(__name__)

# Property names and defaults of a reporting job.
DEFAULTS = {
    "event.tables": "page_vidw,element_click,pay,pay_result,user_info",
    "batch.report.size": "20",
    "batch.db.size": "1000",
    "retry.max.times": "3",
}
RANGES = {"batch.report.size": (1, 50), "batch.db.size": (1, 10000), "retry.max.times": (0, 10)}


@dataclass
class JobSettings:
    tables: list[str]
    run: RunConfig
    max_retry_count: int = 3
    raw: dict[str, str] = field(default_factory=dict)


def read_properties(text: str) -> dict[str, str]:
    out = {}
    for line in text.splitlines():
        line = line.strip()
        if not line or line[0] in "#!" or "=" not in line:
            continue
        k, v = line.split("=", 1)
        out[k.strip()] = v.strip()
    return out


def get_int(props: Mapping[str, str], key: str) -> int:
    raw = props.get(key, DEFAULTS[key])
    try:
        value = int(raw)
    except ValueError:
        log.warning("invalid number for %s: %r, using %s", key, raw, DEFAULTS[key])
        value = int(DEFAULTS[key])
    lo, hi = RANGES[key]
    if not lo <= value <= hi:
        raise ValueError(f"{key} must be within {lo}..{hi}, got {value}")
    return value


def get_bool(props: Mapping[str, str], key: str, default: bool = False) -> bool:
    raw = props.get(key)
    return default if raw is None else raw.strip().lower() == "true"


def settings_from(props: Mapping[str, str], run_id: str = "run") -> JobSettings:
    tables = parse_table_list(props.get("event.tables", DEFAULTS["event.tables"]))
    unknown = [t for t in tables if not REGISTRY.is_valid(t)]
    if unknown:
        raise ValueError(f"Unknown table name: {', '.join(unknown)}")
    modes = {k[len("report.mode."):]: v for k, v in props.items() if k.startswith("report.mode.")}
    run = RunConfig(run_id=run_id, batch_size=get_int(props, "batch.report.size"),
                    page_size=get_int(props, "batch.db.size"), mode_overrides=parse_overrides(modes))
    return JobSettings(tables, run, get_int(props, "retry.max.times"), dict(props))


def load_settings(path: str, run_id: str = "run") -> JobSettings:
    with open(path, encoding="utf-8") as fh:
        return settings_from(read_properties(fh.read()), run_id)
