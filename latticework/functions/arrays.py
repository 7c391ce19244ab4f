"""Array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def each(array: Column | str) -> Column:
    """One row per element of an array that is never empty.

    For plain ``explode`` Spark tests the size of the array in a filter beforehand, pushes
    the test down and so computes the array twice or more; the outer form is not tested.
    """
    return F.explode_outer(array)
