"""Incremental loads of partitioned Parquet tables.

Parquet tables have no MERGE, so an upsert rewrites the partitions it touches.
The rewritten partitions are first written completely to a run folder and only
then published, so a run that dies at any point can be repeated under the same
run folder: an unfinished merge starts over from the untouched table, a
finished one is only published again. Readers may see partitions change one by
one while a run publishes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from basketry.operators.aggregates import agg_daily_revenue
from basketry.operators.dedupe import first_per_key
from basketry.operators.staging import event_copy_order
from basketry.schemas import DOMAINS
from basketry.sources import paths, writers
from basketry.streaming.directory import BUCKETS, KeyDirectory, same_key

_INCOMING, _FOLDER = "_incoming", "_folder"


def changed_since(
    orders: DataFrame, since: Column, partition_column: str | None = None
) -> DataFrame:
    """Rows created at or after a high-water mark.

    On a table partitioned by day, name the day column so that older
    partitions are not even listed for reading.
    """
    recent = orders.filter(F.col("created_at") >= since)
    if partition_column:
        recent = recent.filter(F.col(partition_column) >= F.to_date(since))
    return recent


def look_back(now: Column, hours: int = 1) -> Column:
    return now - F.make_dt_interval(hours=F.lit(hours))


def high_water_mark(df: DataFrame, column: str = "created_at") -> DataFrame:
    """Newest value of a column, in one row."""
    return df.agg(F.max(column).alias("high_water_mark"))


def is_one_of(column: str, values: Sequence) -> Column:
    """Whether a column has one of these values, null among them."""
    known = [v for v in values if v is not None]
    matched = F.col(column).isin(known) if known else F.lit(False)
    return matched | F.col(column).isNull() if None in values else matched


def touched_values(df: DataFrame, column: str) -> list:
    """Distinct values of a partition column: as many as the run touches partitions."""
    return [row[0] for row in df.select(column).distinct().collect()]


def _rewrite_partitions(
    spark: SparkSession,
    target: str,
    schema: T.StructType,
    partition_by: Sequence[str],
    run_dir: str,
    touched: Callable[[DataFrame | None], list],
    merge: Callable[[DataFrame | None], DataFrame],
    cluster_by: Sequence[str] = (),
    remember: Sequence[str] = (),
    announce: Callable[[], None] | None = None,
) -> None:
    """Replace the partitions whose first column is ``touched`` by what ``merge`` makes of their rows.

    The run folder keeps the replaced partitions' folders and distinct ``remember`` values. ``announce`` is called
    once the merged rows are complete, before any of them is published.
    """
    lead = partition_by[0]
    merged_path, before_path = f"{run_dir}/merged", f"{run_dir}/before"
    if not paths.finished(spark, merged_path):
        old = None
        if paths.exists(spark, target):
            stored = spark.read.schema(schema).parquet(target)
            old = stored.filter(is_one_of(lead, touched(stored)))
            folder = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1).alias(_FOLDER)
            noted = old.select(*dict.fromkeys([*partition_by, *remember]), folder).distinct()
            noted.write.mode("overwrite").parquet(before_path)
        # Unpartitioned: here the partition columns stay inside the files.
        merge(old).select(*schema.fieldNames()).write.mode("overwrite").parquet(merged_path)

    if announce:
        announce()
    merged = spark.read.schema(schema).parquet(merged_path)
    writers.write_table(merged, target, partition_by, cluster_by, only_written_partitions=True)
    if paths.finished(spark, before_path):
        columns = T.StructType([schema[c] for c in partition_by]).add(_FOLDER, T.StringType())
        before = spark.read.schema(columns).parquet(before_path)
        kept = merged.select(*partition_by).distinct()
        emptied = before.join(kept, same_key(before, kept, partition_by), "left_anti")
        for folder in touched_values(emptied, _FOLDER):
            paths.delete_folder_of_rows(spark, folder)


def key_directory(
    spark: SparkSession, target: str, keys: Sequence[str], lead: str, schema: T.StructType, buckets: int = BUCKETS
) -> KeyDirectory:
    """The directory beside a table. A table that has none yet gets it, from one read of its keys."""
    directory = KeyDirectory(spark, f"{target.rstrip('/')}_keys", keys, lead, schema, buckets)
    if not directory.exists and paths.exists(spark, target):
        directory.add(spark.read.schema(schema).parquet(target))
    return directory


def upsert(
    spark: SparkSession,
    incoming: DataFrame,
    target: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    run_dir: str,
    preference: Sequence[Column] = (),
    batch_preference: Sequence[Column] = (),
    cluster_by: Sequence[str] = (),
    remember: Sequence[str] = (),
    rows_move: bool = True,
    directory: KeyDirectory | None = None,
) -> None:
    """Insert new keys, replace known ones.

    ``preference`` orders the copies of one key, best first; without it incoming
    rows replace stored ones, and ``batch_preference`` only settles which of
    several copies in the batch counts. ``run_dir`` belongs to this one run and
    makes it repeatable. With ``rows_move`` a row may come back under another
    partition than it is stored in: the key directory beside the table tells
    which, and the table itself is only read there. Say ``False`` where
    partitions follow from the key or never change. A ``directory`` of the
    caller notes the batch's keys in either case.
    """
    lead, batch_path = partition_by[0], f"{run_dir}/incoming"
    if not paths.finished(spark, batch_path):
        order = [*preference, *batch_preference]
        single = first_per_key(incoming, keys, order) if order else incoming
        single.write.mode("overwrite").parquet(batch_path)
    batch = spark.read.schema(incoming.schema).parquet(batch_path)
    if rows_move and directory is None:
        directory = key_directory(spark, target, keys, lead, incoming.schema)

    def touched(stored: DataFrame) -> list:
        places = batch.select(lead)
        if rows_move:
            places = places.union(directory.find(batch, f"{run_dir}/known").select("place").distinct())
        return touched_values(places, lead)

    def merge(old: DataFrame | None) -> DataFrame:
        if old is None:
            return batch
        # Only rows whose key is in the batch compete; all others pass through
        # without a shuffle while the batch is small.
        rest = old.join(batch, same_key(old, batch, keys), "left_anti")
        if not preference:
            return rest.unionByName(batch)
        rivals = old.join(batch, same_key(old, batch, keys), "left_semi")
        contest = rivals.withColumn(_INCOMING, F.lit(0)).unionByName(batch.withColumn(_INCOMING, F.lit(1)))
        best = [*preference, F.col(_INCOMING).desc()]
        return rest.unionByName(first_per_key(contest, keys, best).drop(_INCOMING))

    _rewrite_partitions(
        spark, target, incoming.schema, partition_by, run_dir, touched, merge, cluster_by, remember,
        (lambda: directory.add(batch, unique=bool(preference or batch_preference))) if directory else None,
    )


def upsert_orders(
    spark: SparkSession,
    fct_orders: DataFrame,
    target: str,
    run_dir: str,
    rows_move: bool = True,
    partition_by: Sequence[str] = writers.ORDER_PARTITIONS,
) -> None:
    """Merge order facts on order id; of several versions in one batch one counts.

    That is the one with the newest ``updated_at``, where the fact has such a
    column, then the newest ``created_at``, then the status furthest in an
    order's life; the other columns make the order total.
    """
    newest = [name for name in ("updated_at", "created_at") if name in fct_orders.columns]
    life = F.array(*(F.lit(s.upper()) for s in DOMAINS["orders", "status"]))
    others = [name for name in fct_orders.columns if name not in newest]
    upsert(
        spark, fct_orders, target, ["order_id"], partition_by, run_dir,
        batch_preference=[
            *(F.col(name).desc_nulls_last() for name in newest),
            F.array_position(life, F.col("status_raw")).desc_nulls_last(),
            *(F.col(name).asc_nulls_last() for name in others),
        ],
        cluster_by=["user_id", "product_id"], remember=["order_date"], rows_move=rows_move,
    )


def touched_partitions(spark: SparkSession, schema: T.StructType, run_dir: str, column: str) -> list:
    """Values of a column in the partitions a finished upsert rewrote, before or after."""
    found = set(touched_values(spark.read.schema(schema).parquet(f"{run_dir}/merged"), column))
    if paths.finished(spark, f"{run_dir}/before"):
        columns = T.StructType([schema[column]])
        found |= set(touched_values(spark.read.schema(columns).parquet(f"{run_dir}/before"), column))
    return list(found)


def touched_days(spark: SparkSession, fct_schema: T.StructType, run_dir: str) -> list:
    """Order days whose aggregates a finished ``upsert_orders`` run may have changed.

    All days found in the rewritten partitions, before or after: a moved order
    may have left one of them without orders.
    """
    return touched_partitions(spark, fct_schema, run_dir, "order_date")


def replace_partitions(
    spark: SparkSession, rows: DataFrame, target: str, column: str, values: list, run_dir: str, cluster_by: Sequence[str] = ()
) -> None:
    """Put ``rows`` in place of the stored partitions of these values; those without rows go."""
    _rewrite_partitions(spark, target, rows.schema, [column], run_dir, lambda _: values, lambda _: rows, cluster_by)


def upsert_events(
    spark: SparkSession, events: DataFrame, target: str, run_dir: str, keep: str = "latest",
    rows_move: bool = True,
) -> None:
    """Merge cleaned events on event id, keeping the latest copy wherever it was stored."""
    dated = events.withColumn("event_date", F.to_date("created_at"))
    upsert(
        spark, dated, target, ["event_id"], ["event_date"], run_dir,
        preference=event_copy_order(keep), cluster_by=["event_type", "device_type"],
        rows_move=rows_move,
    )


def refresh_daily_revenue(
    spark: SparkSession, fct_orders: DataFrame, target: str, order_dates: Sequence, run_dir: str
) -> None:
    """Recompute the stored daily revenue of the given days; other days stay as they are.

    The fact is read through a filter on its day column, the stored table by
    the months of those days. A day without orders loses its stored rows.
    """
    if not order_dates:
        return
    months = list({day and day.replace(day=1) for day in order_dates})
    changed = fct_orders.filter(is_one_of("order_date", order_dates))
    if "order_month_start" in fct_orders.columns:  # the monthly layout's partitions
        changed = changed.filter(is_one_of("order_month_start", months))
    daily = writers.with_revenue_month(agg_daily_revenue(changed))

    def merge(old: DataFrame | None) -> DataFrame:
        if old is None:
            return daily
        stale = F.coalesce(is_one_of("order_date", order_dates), F.lit(False))
        return old.filter(~stale).unionByName(daily)

    _rewrite_partitions(
        spark, target, daily.schema, ["revenue_month"], run_dir, lambda _: months, merge,
        ["order_date", "region", "user_plan_type"],
    )
