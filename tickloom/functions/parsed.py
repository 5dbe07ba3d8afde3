"""Expensive expressions, computed once per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column) -> Column:
    """``value`` as a generator of one row.

    A filter on a projected column is pushed below the projection with a copy of its expression,
    so a parse that several conditions look at would run once for each. Nothing is pushed through
    a generator.
    """
    return F.explode(F.array(value))


def fields_once(record: Column) -> Column:
    """The fields of a struct as columns, from one evaluation of ``record``."""
    return F.inline(F.array(record))
