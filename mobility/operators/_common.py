"""Small shared pieces of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_all(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def desc(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def maybe_sort(df: DataFrame, sort: bool, *keys: Column | str) -> DataFrame:
    """Global sort as the last step, only when asked for."""
    return df.orderBy(*keys) if sort else df
