"""Evaluate an expression once and mention it often."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` mentions it.

    Catalyst copies an expression at every mention; a lambda variable is copied instead.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
