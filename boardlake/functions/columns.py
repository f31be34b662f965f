"""Helpers for column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """body(value) with value computed once, also where body uses it inside lambdas."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))
