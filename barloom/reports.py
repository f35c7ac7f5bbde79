"""Reports as JSON text that is the same for the same content, and typed settings."""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
import re
from decimal import Decimal

from pyspark.sql import DataFrame, Row

_DURATION = re.compile(r"(\d+)(s|m|h|d)")


def plain(value):
    """Values as JSON has them: dates and times in ISO form, decimals as text without exponent, rows as objects."""
    if isinstance(value, Row):
        return {k: plain(v) for k, v in value.asDict().items()}
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, set, frozenset)):
        items = [plain(v) for v in value]
        return sorted(items, key=json.dumps) if isinstance(value, (set, frozenset)) else items
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    if isinstance(value, Decimal):
        return format(value, "f")
    if isinstance(value, float) and value != value:
        return None
    return value


def json_text(report: dict) -> str:
    """Sorted keys, two spaces, a line end at the end."""
    return json.dumps(plain(report), sort_keys=True, indent=2, ensure_ascii=False, allow_nan=False) + "\n"


def section(rows: DataFrame, most: int, *order: str) -> list[dict]:
    """The first ``most`` rows by ``order`` for a report."""
    return [plain(r) for r in rows.orderBy(*order).limit(most).collect()]


@dataclasses.dataclass(frozen=True)
class Setting:
    """Name, type (int, bool, str, "duration", "list") and default of a setting; ``least`` bounds numbers."""

    name: str
    kind: object
    default: object = None
    least: float | None = None


def read_settings(wanted: list[Setting], values: dict[str, str]) -> dict[str, object]:
    """Typed settings from texts, such as the environment; every error is named at once.

    Blank is the default, a setting without one is required.  Durations are
    numbers with s, m, h or d and become seconds; lists are split at commas.
    """
    out, errors = {}, []
    for s in wanted:
        text = (values.get(s.name) or "").strip()
        try:
            if not text:
                if s.default is None:
                    raise ValueError("is required")
                value = s.default
            elif s.kind is bool:
                value = {"true": True, "1": True, "yes": True, "false": False, "0": False, "no": False}.get(text.lower())
                if value is None:
                    raise ValueError("is not true or false")
            elif s.kind == "duration":
                found = _DURATION.fullmatch(text)
                if not found:
                    raise ValueError("is not a duration")
                value = int(found[1]) * {"s": 1, "m": 60, "h": 3600, "d": 86400}[found[2]]
            elif s.kind == "list":
                value = [x.strip() for x in text.split(",") if x.strip()]
            else:
                value = s.kind(text)
            if s.least is not None and value < s.least:
                raise ValueError(f"is less than {s.least}")
            out[s.name] = value
        except ValueError as e:
            errors.append(f"{s.name} {e}")
    if errors:
        raise ValueError("; ".join(errors))
    return out
