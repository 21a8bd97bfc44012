"""Evaluating an expression once where it is used several times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), 0)


def rows_with(value: Column) -> Column:
    """Generator of one row per value that is not null.

    A ``where`` on a computed column is pushed below it and computes it a second time; this is not.
    """
    return F.explode(F.array_compact(F.array(value)))
