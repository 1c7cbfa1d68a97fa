"""Column naming: raw headers -> snake case."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

_NON_ALNUM = re.compile(r"[^a-z0-9]+")


def snake_case(name: str) -> str:
    """'Event distance/length' -> 'event_distance_length'."""
    return _NON_ALNUM.sub("_", name.strip().casefold()).strip("_")


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename every column to snake case; refuse names that would collide."""
    new = [snake_case(c) for c in df.columns]
    clashes = sorted({n for n in new if new.count(n) > 1})
    if clashes:
        raise ValueError(f"snake-case names collide: {clashes}")
    return df.toDF(*new)
