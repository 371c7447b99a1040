"""Typing of all-string rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servicerank.functions.clock import minute_floor, parse_snapshot_time
from servicerank.functions.text import safe_bool, safe_long, strict_long
from servicerank.schemas import ENTITY

# How a raw text column becomes a typed one.
KINDS = {
    "strict_long": strict_long,
    "safe_long": safe_long,
    "safe_bool": safe_bool,
    "time": parse_snapshot_time,
    "safe_time": lambda text: parse_snapshot_time(text, strict=False),
    "minute": lambda text: minute_floor(parse_snapshot_time(text)),
    "safe_minute": lambda text: minute_floor(parse_snapshot_time(text, strict=False)),
    "text": lambda text: text,
}


def queue_spec(entity: str = ENTITY, source_id: str = "id") -> dict[str, tuple[str, str]]:
    """Typing of the snapshot columns the queue fact needs."""
    return {
        entity: (source_id, "strict_long"),
        "time_format": ("time", "minute"),
        "customers_currently_waiting": ("currently_waiting", "safe_long"),
        "expected_wait_time": ("expected_wait_time", "safe_long"),
        "active_counters": ("active_counters", "safe_long"),
        "is_open": ("is_open", "safe_bool"),
    }


def stage_typed(df: DataFrame, spec: dict[str, tuple[str, str]]) -> DataFrame:
    """Typed projection: `spec` maps output column to (source column, kind).

    One narrow pass; columns outside the spec are not read. The strict kinds
    fail the query on bad text, the safe kinds give NULL.
    """
    return df.select([_typed(source, kind).alias(name) for name, (source, kind) in spec.items()])


def _typed(source: str, kind: str) -> Column:
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind!r}, expected one of {sorted(KINDS)}")
    return KINDS[kind](F.col(source))
