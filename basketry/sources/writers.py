"""Views and partitioned Parquet tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

MAX_RECORDS_PER_FILE = 20_000_000
ORDER_PARTITIONS = ("order_date", "region")
MONTHLY_ORDER_PARTITIONS = ("order_month_start",)


def register_views(tables: Mapping[str, DataFrame], layer: str | None = None) -> list[str]:
    """Create or replace one temporary view per table, named ``layer_table`` when a layer is given."""
    names = []
    for table, df in tables.items():
        name = f"{layer}_{table}" if layer else table
        df.createOrReplaceTempView(name)
        names.append(name)
    return names


def drop_view(spark: SparkSession, name: str) -> bool:
    """Drop a view if it exists; tells whether it did."""
    return spark.catalog.dropTempView(name)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    cluster_by: Sequence[str] = (),
    only_written_partitions: bool = False,
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
) -> None:
    """Write a partitioned table, rows of a partition together and sorted by ``cluster_by``.

    Rows are brought together with a rebalance rather than a plain repartition:
    small partitions share a task, and a partition that holds a large share of
    all rows is split over several tasks and files. With
    ``only_written_partitions`` the other partitions of an existing table stay.
    """
    keys = [F.col(name) for name in partition_by]
    placed = df.hint("rebalance", *keys).sortWithinPartitions(*partition_by, *cluster_by)
    (
        placed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if only_written_partitions else "static")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*partition_by)
        .parquet(path)
    )


def with_order_month(fct_orders: DataFrame) -> DataFrame:
    return fct_orders.withColumn("order_month_start", F.trunc("order_date", "MM").cast("date"))


def write_fct_orders(
    fct_orders: DataFrame, path: str, partition_by: Sequence[str] = ORDER_PARTITIONS, **options
) -> None:
    """By day, then region; clustered for the user and product keys of joins and aggregations.

    A table with too few orders a day to fill files takes ``with_order_month``
    and ``MONTHLY_ORDER_PARTITIONS``.
    """
    write_table(fct_orders, path, partition_by, ["user_id", "product_id"], **options)


def write_stg_events(stg_events: DataFrame, path: str, **options) -> None:
    """By event day; clustered for event type and device filters."""
    dated = stg_events.withColumn("event_date", F.to_date("created_at"))
    write_table(dated, path, ["event_date"], ["event_type", "device_type"], **options)


def with_revenue_month(agg_daily_revenue: DataFrame) -> DataFrame:
    return agg_daily_revenue.withColumn("revenue_month", F.trunc("order_date", "MM").cast("date"))


def write_daily_revenue(agg_daily_revenue: DataFrame, path: str, **options) -> None:
    """By month: a day is only regions times plans rows, far too few for files of its own."""
    monthly = with_revenue_month(agg_daily_revenue)
    write_table(monthly, path, ["revenue_month"], ["order_date", "region", "user_plan_type"], **options)


def write_product_performance(agg_product_performance: DataFrame, path: str) -> None:
    """Full overwrite: every horizon moves with the reporting day."""
    agg_product_performance.hint("rebalance").write.mode("overwrite").parquet(path)
