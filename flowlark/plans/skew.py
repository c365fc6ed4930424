"""Joins whose left side may have a hot key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_hot(
    rows: DataFrame,
    other: DataFrame,
    on: dict[str, str],
    how: str = "left",
    null_safe: bool = False,
) -> DataFrame:
    """Join on ``on`` (row column to other column) and drop the other's keys.

    Adaptive execution splits a hot partition only where both join inputs come
    straight from a shuffle. An aggregated side already lies partitioned by its
    key and would block that, so the keys are compared as one struct: both
    sides are shuffled for the join and a hot key of ``rows`` is cut up at run
    time. A small other side is still broadcast, by its measured size.
    """
    left = F.struct(*[F.col(a).alias(f"k{i}") for i, a in enumerate(on)])
    names = {b: f"_on_{i}" for i, b in enumerate(on.values())}
    side = other.withColumnsRenamed(names)
    clash = sorted(set(side.columns) & set(rows.columns))
    if clash and how not in ("left_semi", "left_anti"):
        raise ValueError(f"both sides have {clash}")
    if not null_safe:  # structs of nulls would be equal
        side = side.filter(_all_given(names.values()))
    right = F.struct(*[F.col(n).alias(f"k{i}") for i, n in enumerate(names.values())])
    return rows.join(side, left == right, how).drop(*names.values())


def _all_given(columns) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
