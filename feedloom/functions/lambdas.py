"""Values that an expression names more than once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)
