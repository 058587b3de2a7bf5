"""Left joins of facts with dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_SALT = "_salt"


def enrich(facts: DataFrame, dimension: DataFrame, key: str, salts: int = 1, salt_by: str | None = None) -> DataFrame:
    """Facts with the attributes of their dimension row; facts without one stay.

    No side is broadcast by hint: Spark does so for a dimension under its size
    threshold, and else splits the tasks of frequent keys at run time. Streams
    run without that splitting. There ``salts`` spreads each key over that many
    tasks, by a hash of ``salt_by``, against as many copies of the dimension.
    """
    if salts <= 1:
        return facts.join(dimension, key, "left")
    salt = F.pmod(F.xxhash64(salt_by or key), F.lit(salts)).cast("int")
    copies = dimension.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return facts.withColumn(_SALT, salt).join(copies, [key, _SALT], "left").drop(_SALT)
