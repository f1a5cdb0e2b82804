"""Column-name normalisation (driver-side, names only)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

_WHITESPACE_RUN = re.compile(r"\s+")


def snake_name(name: str) -> str:
    """Strip, casefold, and turn every whitespace run into one underscore."""
    return _WHITESPACE_RUN.sub("_", name.strip().casefold())


def normalise_columns(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`snake_name`; refuse colliding names."""
    new = [snake_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(f"columns {seen[n]!r} and {old!r} both normalise to {n!r}")
        seen[n] = old
    return df.toDF(*new)
