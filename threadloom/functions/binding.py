"""Name an intermediate value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once per row.

    A projected column is not enough: a filter pushed below the projection copies its expression to every place that
    refers to it, also into lambdas, where it would be computed again for each element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
