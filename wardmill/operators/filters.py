"""Filters, projections and limits. Each is a plain predicate, so it reaches the scan."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def literal(value: Any) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def between(
    column: str | Column, low: Any, high: Any, low_closed: bool = True, high_closed: bool = True
) -> Column:
    """Range predicate with a flag for each end; a bound of None leaves that end open-ended."""
    c = F.col(column) if isinstance(column, str) else column
    parts = []
    if low is not None:
        parts.append(c >= literal(low) if low_closed else c > literal(low))
    if high is not None:
        parts.append(c <= literal(high) if high_closed else c < literal(high))
    return reduce(Column.__and__, parts, F.lit(True))


def range_filter(df: DataFrame, column: str, low: Any, high: Any, low_closed: bool = True,
                 high_closed: bool = True) -> DataFrame:
    return df.filter(between(column, low, high, low_closed, high_closed))


def eq_filter(df: DataFrame, **values: Any) -> DataFrame:
    return df.filter(reduce(Column.__and__, [F.col(k) == literal(v) for k, v in values.items()]))


def project(df: DataFrame, include: list[str] | None = None, exclude: tuple[str, ...] = ()) -> DataFrame:
    chosen = df.select(*include) if include else df
    return chosen.drop(*exclude)


def find_one(df: DataFrame, predicate: Column | None = None, order: list[str] | None = None) -> DataFrame:
    """The first matching row, or none. Pass an order where the match is not by key."""
    found = df if predicate is None else df.filter(predicate)
    return (found.orderBy(*order) if order else found).limit(1)


def regex_search(
    df: DataFrame, column: str, term: str, order: list[str], rows: int = 10
) -> DataFrame:
    """Case-insensitive regular expression search, first rows by key."""
    return df.filter(F.col(column).rlike(f"(?i){term}")).orderBy(*order).limit(rows)


def page(
    df: DataFrame, order: list[str | Column], rows: int = 10, start: int = 0, after: Any = None
) -> DataFrame:
    """One page of rows in order.

    ``start`` skips rows, which one task must gather first; ``after``, the last value of a unique
    first order column on the page before, is a filter instead and costs the same on any page.
    """
    if after is not None:
        df = df.filter(F.col(order[0]) > literal(after))
    return df.orderBy(*order).offset(start).limit(rows)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Keep the listed columns, in order, under their new names."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])
