"""Tables in hash buckets of a key: joins and aggregations on it need no shuffle.

A bucket is read by one task, so a key with a large share of all rows must not lie in one. Keys with more rows than
an even bucket would hold, of which there are fewer than buckets, are therefore stored beside the buckets in
a table of their own, which is dealt over tasks like any other. Every key is in one of the two parts only, so results
per key of the parts need no further merge.

Buckets are known to the catalogue alone; ``attach`` tells another session's catalogue of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from basketry.functions.money import as_decimal, as_double
from basketry.sources import paths


def is_in(key: str, values: Sequence) -> Column:
    known = [v for v in values if v is not None]
    return F.coalesce(F.col(key).isin(known), F.lit(False)) | (F.col(key).isNull() if None in values else F.lit(False))


@dataclass
class BucketedTable:
    spark: SparkSession
    name: str
    path: str
    key: str
    buckets: int
    schema: T.StructType
    hot: list = field(default_factory=list)

    def regular(self) -> DataFrame:
        return self.spark.table(self.name)

    def hot_rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/hot")

    def all_rows(self) -> DataFrame:
        return self.regular().unionByName(self.hot_rows()) if self.hot else self.regular()


def hot_keys(df: DataFrame, key: str, buckets: int) -> list:
    """Keys with more than one in ``buckets`` of all rows: fewer than ``buckets``, whatever the data."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    total = df.count()
    return [row[0] for row in counts.filter(F.col("rows") * buckets > total).select(key).collect()]


def write(
    df: DataFrame, name: str, path: str, key: str, buckets: int, sort_by: Sequence[str] = (), split_hot: bool = True
) -> BucketedTable:
    """Store ``df`` as the catalogue table ``name`` below ``path``, sorted in each bucket by key and ``sort_by``.

    ``split_hot`` keeps hot keys out of the buckets. It costs a count per key, and a table with unique keys needs none.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    table = BucketedTable(spark, name, path, key, buckets, df.schema, hot_keys(df, key, buckets) if split_hot else [])
    rest = df
    if table.hot:
        rest = df.filter(~is_in(key, table.hot))
        df.filter(is_in(key, table.hot)).hint("rebalance").write.mode("overwrite").parquet(f"{path}/hot")
    # Dealt as the buckets are, so that every bucket is one file.
    writer = rest.repartition(buckets, key).write.mode("overwrite").format("parquet")
    writer.bucketBy(buckets, key).sortBy(key, *sort_by).option("path", f"{path}/buckets").saveAsTable(name)
    return table


def attach(table: BucketedTable, sort_by: Sequence[str] = ()) -> BucketedTable:
    """Enter a stored table into this session's catalogue again, hot keys and all."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
    order = ", ".join(f"`{c}`" for c in (table.key, *sort_by))
    table.spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table.name} ({columns}) USING parquet CLUSTERED BY (`{table.key}`) "
        f"SORTED BY ({order}) INTO {table.buckets} BUCKETS LOCATION '{table.path}/buckets'")
    if paths.exists(table.spark, f"{table.path}/hot"):
        table.hot = [row[0] for row in table.hot_rows().select(table.key).distinct().collect()]
    return table


def _joined(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    return facts.join(dimension.withColumnRenamed(key, "_dimension_key"), F.col(key) == F.col("_dimension_key"), "left").drop("_dimension_key")


def join(facts: BucketedTable, dimension: BucketedTable) -> list[DataFrame]:
    """Facts with their dimension (unique keys, as many buckets): one part bucket by bucket, and one of hot keys, if any.

    Hot facts meet the rows of their keys alone, which are fewer than buckets and so may be broadcast.
    """
    if (facts.key, facts.buckets) != (dimension.key, dimension.buckets):
        raise ValueError("both tables need the same key and number of buckets")
    parts = [_joined(facts.regular(), dimension.all_rows(), facts.key)]
    if facts.hot:
        few = dimension.all_rows().filter(is_in(facts.key, facts.hot))
        parts.append(_joined(facts.hot_rows(), F.broadcast(few), facts.key))
    return parts


def revenue_by_user(facts: BucketedTable, users: BucketedTable, by: Sequence[str] = ("user_plan_type", "user_country")) -> DataFrame:
    """Orders and net revenue per user, with the user's columns ``by`` (facts hold none of them)."""
    key, out = facts.key, None
    for part in join(facts, users):
        part = part.groupBy(key).agg(
            F.count("order_id").alias("orders"), as_double(F.sum(as_decimal(F.col("net_revenue")))).alias("net_revenue"),
            *(F.min(name).alias(name) for name in by))
        out = part if out is None else out.unionByName(part)
    return out
