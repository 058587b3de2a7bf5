"""Data-quality and governance checks, each a table of violations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from basketry.functions.dates import second_boundaries
from basketry.schemas import DOMAINS, FOREIGN_KEYS, PII_COLUMNS, PRIMARY_KEYS


def null_keys(tables: Mapping[str, DataFrame], keys: Mapping[str, str] = PRIMARY_KEYS) -> DataFrame:
    """Rows without their key, per table."""
    counts = [
        tables[table].agg(
            F.lit(table).alias("table_name"),
            F.count_if(F.col(key).isNull()).alias("null_keys"),
        )
        for table, key in keys.items()
        if table in tables
    ]
    return reduce(DataFrame.unionByName, counts)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    counts = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("copies"))
    return counts.filter((F.col("copies") > 1) & F.col("key").isNotNull())


def duplicate_summary(
    tables: Mapping[str, DataFrame], keys: Mapping[str, str] = PRIMARY_KEYS
) -> DataFrame:
    """Duplicated keys and surplus rows, per table."""
    counts = [
        duplicate_keys(tables[table], key).agg(
            F.lit(table).alias("table_name"),
            F.count(F.lit(1)).alias("duplicated_keys"),
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0).cast("long")).alias("surplus_rows"),
        )
        for table, key in keys.items()
        if table in tables
    ]
    return reduce(DataFrame.unionByName, counts)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign-key values without a parent, with their number of rows; nulls refer to nothing.

    The child is counted per value first, so the join is not skewed by a
    frequent value. It is an outer join with a test for no match because Spark
    would run an anti join before the counting, on all rows.
    """
    used = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("key"))
    used = used.agg(F.count(F.lit(1)).alias("rows"))
    known = parent.select(F.col(parent_key).alias("key"), F.lit(True).alias("known"))
    return used.join(known, "key", "left").filter(F.col("known").isNull()).drop("known")


def orphan_summary(
    tables: Mapping[str, DataFrame],
    foreign_keys: Sequence[tuple[str, str, str, str]] = tuple(FOREIGN_KEYS),
) -> DataFrame:
    """Orphaned values and rows, per foreign key."""
    counts = [
        orphans(tables[child], column, tables[parent], key).agg(
            F.lit(f"{child}.{column}").alias("foreign_key"),
            F.count(F.lit(1)).alias("orphan_keys"),
            F.coalesce(F.sum("rows"), F.lit(0).cast("long")).alias("orphan_rows"),
        )
        for child, column, parent, key in foreign_keys
        if child in tables and parent in tables
    ]
    return reduce(DataFrame.unionByName, counts)


def domain_violations(
    tables: Mapping[str, DataFrame],
    domains: Mapping[tuple[str, str], Sequence[str]] = DOMAINS,
) -> DataFrame:
    """Values outside their documented domain, any case accepted, with their number of rows."""
    found = []
    for (table, column), accepted in domains.items():
        if table not in tables:
            continue
        counts = tables[table].groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
        outside = counts.filter(~F.lower("value").isin(*accepted))
        found.append(outside.select(F.lit(f"{table}.{column}").alias("column_name"), "value", "rows"))
    return reduce(DataFrame.unionByName, found)


def readable(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Whether each table returns rows; reads no more than one row of each."""
    checks = [
        df.select(F.lit(1).alias("one"))
        .limit(1)
        .agg(F.lit(table).alias("table_name"), (F.count("one") > 0).alias("has_rows"))
        for table, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, checks)


def freshness(df: DataFrame, now: Column, column: str = "created_at", max_lag_seconds: int = 3600) -> DataFrame:
    """Age of the newest row against the allowed lag, in one row."""
    latest = df.agg(F.max(column).alias("latest_at"))
    lag = second_boundaries(F.col("latest_at"), now)
    return latest.select(
        "latest_at",
        lag.alias("lag_seconds"),
        F.coalesce(lag <= max_lag_seconds, F.lit(False)).alias("within_sla"),
    )


def assert_no_pii(df: DataFrame, pii: Sequence[str] = PII_COLUMNS, derived: bool = False) -> DataFrame:
    """Raise when a personal column is present; returns the table for chaining.

    With ``derived`` digests and pseudonyms count too, which are named after the column they are made of.
    """
    prefixes = tuple(f"{name}_" for name in pii) if derived else ()
    leaked = sorted(c for c in df.columns if c.lower() in pii or c.lower().startswith(prefixes))
    if leaked:
        raise ValueError(f"personal columns beyond staging: {leaked}")
    return df


def assert_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Raise unless names, order and types match exactly; returns the table for chaining."""
    actual = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    wanted = [(f.name, f.dataType.simpleString()) for f in expected.fields]
    if actual != wanted:
        raise ValueError(f"schema differs: {set(actual) ^ set(wanted) or 'column order'}")
    return df
