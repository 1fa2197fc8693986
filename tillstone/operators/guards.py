"""Checks made on schemas before a job starts, and on emptiness where it matters."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame

log = logging.getLogger(__name__)


class MissingColumnsError(ValueError):
    """A step was given a DataFrame without the columns it needs."""


def require_any_column(df: DataFrame, stage: str) -> None:
    if not df.columns:
        raise ValueError(f"{stage}: the input has no columns")


def require_columns(df: DataFrame, columns: Iterable[str], stage: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"{stage}: missing columns {missing}, found {df.columns}")


def warn_if_empty(df: DataFrame, stage: str) -> bool:
    """Log a warning for an input without rows and go on; reads at most one row."""
    empty = df.isEmpty()
    if empty:
        log.warning("%s: the input has no rows, so everything built from it will be empty", stage)
    return empty
