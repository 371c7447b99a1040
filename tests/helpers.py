"""Helpers of the tests: row sets and physical plans."""

from __future__ import annotations

import contextlib
import io
from datetime import datetime

from pyspark.sql import DataFrame


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df: DataFrame) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)
