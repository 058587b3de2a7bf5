"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_ROW = "_row_in_key"


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key under ``order``, which should be a total order.

    Spark turns ``row_number() = 1`` into a window group limit that runs before
    the shuffle too, so a key with any number of copies sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_ROW, F.row_number().over(window)).filter(F.col(_ROW) == 1).drop(_ROW)
