"""Folds over one array a series, inside column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is referred to."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def scan(rows: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """``start`` and every state behind it: a fold that keeps its states, one for each row after the first.

    Each step copies the pointers to the states so far, so this is for arrays as long as a calendar.
    """
    return F.aggregate(
        rows, F.array(start), lambda states, row: F.concat(states, F.array(bound(F.element_at(states, -1), lambda s: step(s, row))))
    )
