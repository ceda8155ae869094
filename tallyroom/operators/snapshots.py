"""Three meanings of "latest", and the row in force on a date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.functions import in_force
from tallyroom.operators.ranking import first_per


def latest_row(df: DataFrame, keys: list[str], on: str, ties: list[str] = ()) -> DataFrame:
    """One row per key: the newest by ``on``; ``ties`` settle equal dates."""
    return first_per(df, keys, [F.col(on).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in ties]])


def latest_snapshot(df: DataFrame, keys: list[str], on: str) -> DataFrame:
    """Every row that carries its key's newest snapshot date (ties stay).

    The newest dates are found by a map-side combined aggregate and joined
    back, so a key that holds much of the table is never one window.
    """
    newest = df.groupBy(*keys).agg(F.max(on).alias(on))
    return df.join(newest, [*keys, on], "left_semi")


def latest_global(df: DataFrame, on: str) -> DataFrame:
    """Every row of the single newest snapshot. The date is a scalar subquery,
    which also reaches the scan as a pushed filter."""
    return df.where(F.col(on) == df.agg(F.max(on)).scalar())


def in_force_row(df: DataFrame, keys: list[str], start: str, end: str, as_of: date,
                 ties: list[str] = ()) -> DataFrame:
    """The one row per key whose half-open validity covers ``as_of``; where
    windows overlap the newest start wins."""
    return first_per(df.where(in_force(start, end, as_of)), keys,
                     [F.col(start).desc(), *[F.col(c).desc_nulls_last() for c in ties]])
