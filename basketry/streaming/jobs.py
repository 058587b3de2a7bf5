"""Structured Streaming jobs over newly arrived files.

Every job takes a streaming DataFrame and a checkpoint folder and returns the
started query. ``every=None`` processes what has arrived and stops, which suits
a scheduler that runs every 15 to 30 minutes; ``every="15 minutes"`` keeps
running. Batches are written through the upserts of ``incremental`` under a run
folder named after the batch, so a batch replayed after a failure changes
nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from basketry.functions.money import as_decimal, as_double
from basketry.operators.aggregates import DAILY_KEYS
from basketry.operators.dedupe import first_per_key
from basketry.operators.facts import STEP_TIMES, device_steps, fct_orders, funnel_from_device_steps, with_step_outcomes
from basketry.operators.staging import clean_events, event_copy_order, stg_orders
from basketry.schemas import ANALYTICS, FUNNEL_STEPS
from basketry.sources import paths
from basketry.sources.writers import ORDER_PARTITIONS, with_revenue_month
from basketry.streaming import incremental


def triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def each_batch(
    stream: DataFrame,
    handle: Callable[[SparkSession, DataFrame, str], None],
    checkpoint: str,
    every: str | None,
    mode: str = "append",
) -> StreamingQuery:
    """Land each batch as files, then handle it as an ordinary table.

    Streams run without adaptive execution. Landing evaluates the batch exactly
    once and lets the merge run in the caller's session, where skewed joins and
    partitions are split at run time.
    """
    spark = stream.sparkSession

    def run(batch: DataFrame, batch_id: int) -> None:
        run_dir = f"{checkpoint}/runs/{batch_id}"
        landed = f"{run_dir}/batch"
        if not paths.finished(spark, landed):
            batch.write.mode("overwrite").parquet(landed)
        rows = spark.read.schema(batch.schema).parquet(landed)
        if not rows.isEmpty():
            handle(spark, rows, run_dir)
        # The previous batch is committed once this one runs.
        paths.delete(spark, f"{checkpoint}/runs/{batch_id - 1}")

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{checkpoint}/state")
    return triggered(writer.foreachBatch(run), every).start()


def ingest_orders(
    raw_orders: DataFrame,
    stg_products: DataFrame,
    stg_users: DataFrame,
    target: str,
    checkpoint: str,
    daily_target: str | None = None,
    every: str | None = None,
    rows_move: bool = True,
    partition_by: Sequence[str] = ORDER_PARTITIONS,
    extend: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Merge arriving orders into the stored fact, then refresh the days they touched.

    ``extend`` may add columns to the stored fact, such as a coarser partition column.
    """
    def handle(spark: SparkSession, batch: DataFrame, run_dir: str) -> None:
        facts = fct_orders(stg_orders(batch), stg_products, stg_users)
        facts = extend(facts) if extend else facts
        incremental.upsert_orders(spark, facts, target, run_dir, rows_move, partition_by)
        if daily_target:
            stored = spark.read.schema(facts.schema).parquet(target)
            days = incremental.touched_days(spark, facts.schema, run_dir)
            incremental.refresh_daily_revenue(spark, stored, daily_target, days, f"{run_dir}/daily")

    return each_batch(raw_orders, handle, checkpoint, every)


def ingest_events(
    raw_events: DataFrame,
    target: str,
    checkpoint: str,
    keep: str = "latest",
    every: str | None = None,
    rows_move: bool = True,
) -> StreamingQuery:
    """Merge arriving events into the stored staging table, one row per event id."""
    def handle(spark: SparkSession, batch: DataFrame, run_dir: str) -> None:
        incremental.upsert_events(spark, clean_events(batch), target, run_dir, keep, rows_move)

    return each_batch(raw_events, handle, checkpoint, every)


def ingest_first_arrivals(
    raw_events: DataFrame, target: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Store arriving events, keeping of each event id the copy that arrived first.

    Copies in one batch are settled by time, earliest first. Whether an id was
    stored before, and however long ago, the key directory beside the table
    says; late and undated copies are told like others, and no state grows.
    """
    def handle(spark: SparkSession, batch: DataFrame, run_dir: str) -> None:
        single = first_per_key(clean_events(batch), ["event_id"], event_copy_order("earliest"))
        dated = single.withColumn("event_date", F.to_date("created_at"))
        directory = incremental.key_directory(spark, target, ["event_id"], "event_date", dated.schema)
        fresh = f"{run_dir}/fresh"
        if not paths.finished(spark, fresh):
            known = directory.find(dated, f"{run_dir}/known")
            dated.join(known, "event_id", "left_anti").write.mode("overwrite").parquet(fresh)
        incremental.upsert(
            spark, spark.read.schema(dated.schema).parquet(fresh), target, ["event_id"], ["event_date"], run_dir,
            cluster_by=["event_type", "device_type"], rows_move=False, directory=directory,
        )

    return each_batch(raw_events, handle, checkpoint, every)


TOTALS = ("gross_total", "net_total", "priced_orders")


def with_daily_measures(totals: DataFrame) -> DataFrame:
    net = as_double(F.col("net_total"))
    return totals.withColumns({
        "total_gross_revenue": as_double(F.col("gross_total")),
        "total_net_revenue": net,
        "Avg_net_revenue": F.try_divide(net, F.col("priced_orders").cast("double")),
    })


def publish_daily_revenue(
    raw_orders: DataFrame,
    stg_users: DataFrame,
    target: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Keep a stored daily revenue table up to date from a stream that delivers each order once.

    Beside the columns of ``agg_daily_revenue`` the table holds decimal totals,
    to which a batch adds its own. No order is too late, undated ones included:
    nothing waits in a state store, and only the months a batch has orders of
    are read and rewritten. Where orders come again in new versions, use
    ``ingest_orders`` with ``daily_target``.
    """
    def handle(spark: SparkSession, batch: DataFrame, run_dir: str) -> None:
        facts = fct_orders(stg_orders(batch), stg_users=stg_users)
        gross, net = F.col("gross_revenue"), F.col("net_revenue")
        wide = lambda total: total.cast("decimal(38,10)")
        news = with_revenue_month(facts.groupBy(*DAILY_KEYS).agg(
            F.count("order_id").alias("order_count"),
            wide(F.sum(as_decimal(gross))).alias("gross_total"),
            wide(F.sum(as_decimal(net))).alias("net_total"),
            F.count(net).alias("priced_orders"),
        ))
        added = f"{run_dir}/added"
        if not paths.finished(spark, added):
            news.write.mode("overwrite").parquet(added)
        totals = spark.read.schema(news.schema).parquet(added)
        if paths.exists(spark, target):
            months = incremental.touched_values(totals, "revenue_month")
            stored = spark.read.schema(news.schema).parquet(target).filter(incremental.is_one_of("revenue_month", months))
            sums = [F.sum("order_count").alias("order_count"), *(F.sum(name).cast(news.schema[name].dataType).alias(name) for name in TOTALS)]
            totals = stored.unionByName(totals).groupBy(*DAILY_KEYS, "revenue_month").agg(*sums)
        incremental.upsert(
            spark, with_daily_measures(totals), target, list(DAILY_KEYS), ["revenue_month"], run_dir, rows_move=False,
        )

    return each_batch(raw_orders, handle, checkpoint, every)


def publish_funnel(
    raw_events: DataFrame,
    events_target: str,
    steps_target: str,
    checkpoint: str,
    steps: Sequence[str] = FUNNEL_STEPS,
    every: str | None = None,
    rows_move: bool = True,
) -> StreamingQuery:
    """Merge arriving events into the stored staging table and refresh the step times of the days they touched.

    ``stored_funnel`` rolls the step times per day, user and device up when the
    funnel is read, so a batch rewrites only its own days, and the latest copy
    of an event counts as in the batch model.
    """
    def handle(spark: SparkSession, batch: DataFrame, run_dir: str) -> None:
        clean = clean_events(batch)
        incremental.upsert_events(spark, clean, events_target, run_dir, rows_move=rows_move)
        dated = T.StructType([*clean.schema.fields, T.StructField("event_date", T.DateType())])
        days = incremental.touched_partitions(spark, dated, run_dir, "event_date")
        stored = spark.read.schema(dated).parquet(events_target)
        changed = stored.filter(incremental.is_one_of("event_date", days))
        incremental.replace_partitions(
            spark, device_steps(changed, steps, ["event_date"]), steps_target, "event_date", days, f"{run_dir}/steps", ["user_id"],
        )

    return each_batch(raw_events, handle, checkpoint, every)


def stored_funnel(steps_by_day: DataFrame, device: str = "alphabetical") -> DataFrame:
    """The funnel out of the table ``publish_funnel`` keeps; minima of minima are minima."""
    return funnel_from_device_steps(steps_by_day, device)


def merge_funnel(stored: DataFrame, new_events: DataFrame, steps: Sequence[str] = FUNNEL_STEPS) -> DataFrame:
    """A stored funnel brought up to date with further events, without a stream.

    Stored users and new events meet in one aggregation of rows per user. Step
    times no longer tell the events they came from, so a later copy of an event
    already counted can't replace it; where copies come again, use
    ``publish_funnel``.
    """
    viewed = F.when(F.col("views") > 0, F.col("device_type")).alias("device_type")
    news = device_steps(new_events, steps).select("user_id", viewed, *STEP_TIMES)
    both = stored.select("user_id", "device_type", *STEP_TIMES).unionByName(news)
    first = both.groupBy("user_id").agg(
        F.min("device_type").alias("device_type"), *(F.min(name).alias(name) for name in STEP_TIMES)
    )
    return with_step_outcomes(first).select(*ANALYTICS["fct_user_funnel"].fieldNames())
