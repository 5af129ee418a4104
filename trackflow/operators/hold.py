"""Keeping a costly expression from being copied."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hold(df: DataFrame, name: str, held: str) -> DataFrame:
    """Compute column ``name`` once and call it ``held``.

    The explode of a one-element array keeps the optimizer from copying a costly expression
    into the filters and lambdas that use it.
    """
    return df.withColumn(held, F.explode(F.array(name))).drop(name)
