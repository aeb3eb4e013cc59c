"""Keeping an expensive expression from being repeated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(c: Column) -> Column:
    """The value as a generated row. Spark copies an expression into every later use of its column
    when it merges projections and pushes filters down; it never does that across a generator."""
    return F.explode(F.array(c))
