"""Checks made while a plan is built, before any job runs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def require_columns(df: DataFrame, columns: Iterable[str], purpose: str) -> None:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"{purpose}: missing column(s) {', '.join(missing)}")
