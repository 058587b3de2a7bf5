"""Streams with bounded state: a router for late rows, deduplication and daily windows behind a watermark.

Spark drops rows that are behind a stream's watermark. So that none is lost, a first job routes arriving rows into
two tables, on time and late, by a clock of its own: the newest event time of all batches before, less the delay.
Stateful jobs read the table of rows on time as a stream with the same delay. They see its rows in the same order, so
their watermark is never ahead of the clock, and Spark drops none of them. Late and undated rows are merged back
when results are read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from basketry.functions.money import as_decimal
from basketry.operators.aggregates import DAILY_KEYS
from basketry.operators.dedupe import first_per_key
from basketry.operators.facts import fct_orders
from basketry.operators.staging import EVENT_COLUMNS, clean_events, event_copy_order, stg_orders
from basketry.sources import paths
from basketry.sources.writers import with_revenue_month
from basketry.streaming import incremental
from basketry.streaming.jobs import TOTALS, each_batch, triggered, with_daily_measures

ARRIVAL = "arrival"
_ON_TIME, _LATE, _CLOCK = "on_time", "late", "clock"


def route(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    delay: str,
    time: str = "created_at",
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    every: str | None = None,
) -> StreamingQuery:
    """Store arriving rows below ``root`` as on time or late; undated rows are late.

    ``prepare`` makes the stored rows out of a batch. A batch's rows appear at once and only once: they are written
    aside and moved, and a batch run again after a failure finds them. Rows carry the batch as ``arrival``.
    """
    def handle(spark: SparkSession, batch: DataFrame, run_dir: str) -> None:
        number = int(run_dir.rsplit("/", 1)[1])
        rows = prepare(batch)
        clock = _clock(spark, root, number)
        behind = F.col(time).isNull()
        if clock is not None:
            behind |= F.col(time) < F.lit(clock) - F.expr(f"INTERVAL {delay}")
        behind = F.coalesce(behind, F.lit(True))
        for name, part in ((_LATE, rows.filter(behind)), (_ON_TIME, rows.filter(~behind))):
            _publish(spark, part, f"{root}/{name}/{ARRIVAL}={number}", f"{run_dir}/{name}")
        newest = rows.agg(F.greatest(F.max(time), F.lit(clock).cast("timestamp")).alias("newest"))
        _publish(spark, newest.coalesce(1), f"{root}/{_CLOCK}/{number}", f"{run_dir}/{_CLOCK}")

    return each_batch(stream, handle, checkpoint, every)


def _publish(spark: SparkSession, rows: DataFrame, path: str, aside: str) -> None:
    if not paths.exists(spark, path):
        rows.write.mode("overwrite").parquet(aside)
        paths.move(spark, aside, path)


def _clock(spark: SparkSession, root: str, number: int):
    """Newest event time of the batches before; empty batches leave no clock."""
    known = [int(n) for n in paths.names(spark, f"{root}/{_CLOCK}") if n.isdigit() and int(n) < number]
    if not known:
        return None
    for old in sorted(known)[:-1]:
        paths.delete(spark, f"{root}/{_CLOCK}/{old}")
    return spark.read.schema("newest timestamp").parquet(f"{root}/{_CLOCK}/{max(known)}").first()[0]


def _with_arrival(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(ARRIVAL, T.LongType())])


def on_time(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The rows on time as a stream; nothing has to be there yet."""
    paths.make(spark, f"{root}/{_ON_TIME}")
    return spark.readStream.schema(_with_arrival(schema)).parquet(f"{root}/{_ON_TIME}")


def late(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The late and undated rows as a table."""
    paths.make(spark, f"{root}/{_LATE}")
    return spark.read.schema(_with_arrival(schema)).parquet(f"{root}/{_LATE}")


# --- events --------------------------------------------------------------------


def _arrival_order() -> list[Column]:
    return [F.col(ARRIVAL), *event_copy_order("earliest")]


def first_of_batch(raw_events: DataFrame) -> DataFrame:
    """Cleaned events of one batch, of several copies the earliest: what ``route`` stores of raw events."""
    return first_per_key(clean_events(raw_events), ["event_id"], event_copy_order("earliest"))


def deduplicate(
    events: DataFrame, target: str, checkpoint: str, delay: str, every: str | None = None
) -> StreamingQuery:
    """Store routed events of which no copy came within ``delay``; the state holds no ids older than that.

    Copies further apart both get through and are settled by ``first_arrivals``. The sink keeps its own list of
    finished files, so a batch that is run again adds nothing.
    """
    fresh = events.withWatermark("created_at", delay).dropDuplicatesWithinWatermark(["event_id"])
    dated = fresh.withColumn("event_date", F.to_date("created_at"))
    writer = dated.writeStream.format("parquet").partitionBy("event_date").outputMode("append").option("path", target)
    return triggered(writer.option("checkpointLocation", checkpoint), every).start()


def first_arrivals(stored: DataFrame, late_events: DataFrame, columns: Sequence[str] = EVENT_COLUMNS) -> DataFrame:
    """One row per event id, the copy that arrived first, out of stored, late and undated rows."""
    both = stored.select(*EVENT_COLUMNS, ARRIVAL).unionByName(late_events.select(*EVENT_COLUMNS, ARRIVAL))
    return first_per_key(both, ["event_id"], _arrival_order()).select(*columns)


# --- daily revenue ----------------------------------------------------------------


def _totals() -> list[Column]:
    gross, net = F.col("gross_revenue"), F.col("net_revenue")
    return [
        F.count("order_id").alias("order_count"),
        F.sum(as_decimal(gross)).cast("decimal(38,10)").alias("gross_total"),
        F.sum(as_decimal(net)).cast("decimal(38,10)").alias("net_total"),
        F.count(net).alias("priced_orders"),
    ]


def daily_windows(
    raw_orders: DataFrame, stg_users: DataFrame, target: str, checkpoint: str, delay: str, every: str | None = None
) -> StreamingQuery:
    """Keep totals per day, region and plan from routed orders that each come once.

    Update mode: a batch gives the whole totals of the windows it changed, which replace the stored ones. A day leaves
    the state once the watermark has passed it.
    """
    orders = stg_orders(raw_orders).withWatermark("created_at", delay)
    facts = fct_orders(orders, stg_users=stg_users)
    day = F.window("created_at", "1 day")
    windows = facts.groupBy(day.alias("day"), "region", "user_plan_type").agg(*_totals())
    totals = windows.withColumn("order_date", F.to_date("day.start")).drop("day")

    def handle(spark: SparkSession, batch: DataFrame, run_dir: str) -> None:
        rows = with_revenue_month(batch.select(*DAILY_KEYS, "order_count", *TOTALS))
        incremental.upsert(spark, rows, target, list(DAILY_KEYS), ["revenue_month"], run_dir, rows_move=False)

    return each_batch(totals, handle, checkpoint, every, mode="update")


def daily_revenue_with_late(windows: DataFrame, late_orders: DataFrame, stg_users: DataFrame) -> DataFrame:
    """Daily revenue out of the stored windows and the late and undated orders."""
    behind = fct_orders(stg_orders(late_orders), stg_users=stg_users).groupBy(*DAILY_KEYS).agg(*_totals())
    both = windows.select(*DAILY_KEYS, "order_count", *TOTALS).unionByName(behind)
    sums = [F.sum("order_count").alias("order_count"), *(F.sum(name).alias(name) for name in TOTALS)]
    return with_daily_measures(both.groupBy(*DAILY_KEYS).agg(*sums))
