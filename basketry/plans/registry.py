"""Every operator as a named query over the star-schema sample tables.

``QUERIES[name](spark, sf_dir)`` returns the result of one operator over the
whole tables in ``sf_dir``. Each query builds only the staged tables it needs.
Queries of table writers and streams first write below ``spark.checkpoint.dir``
and return what can be read back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from basketry.functions import money
from basketry.functions.labels import DOMAIN_STATUS_LABELS
from basketry.operators import aggregates, calendar, dimensions, facts, observed, quality, ranking, sketches, staging, trailing
from basketry.plans import panels, reports, warehouse
from basketry.schemas import ANALYTICS, RAW, STAGING
from basketry.session import work_dir
from basketry.sources import bucketed, checked, readers, star, writers
from basketry.streaming import incremental, jobs, watermarks
from basketry.streaming.directory import KeyDirectory

AS_OF = dt.date(2001, 8, 1)
NOW = "2001-08-01 00:30:00"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _zoneless(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, so that no reader shifts them."""
    return df.select(
        *(
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields
        )
    )


def query(name: str):
    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: _zoneless(build(Tables(spark, sf_dir)))
        return build

    return register


class Tables:
    """Staged tables and models over one data folder, built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def folder(self, name: str) -> str:
        return work_dir(self.spark, name)

    @cached_property
    def orders(self) -> DataFrame:
        return staging.stg_orders(star.raw_orders(self.spark, self.sf_dir))

    @cached_property
    def users(self) -> DataFrame:
        return staging.stg_users(star.raw_users(self.spark, self.sf_dir))

    @cached_property
    def products(self) -> DataFrame:
        return staging.stg_products(star.raw_products(self.spark, self.sf_dir))

    @cached_property
    def raw_events(self) -> DataFrame:
        return star.raw_events(self.spark, self.sf_dir)

    @cached_property
    def funnel_events(self) -> DataFrame:
        return staging.stg_events(self.raw_events, columns=staging.FUNNEL_EVENT_COLUMNS)

    @cached_property
    def order_fact(self) -> DataFrame:
        """Without dimensions."""
        return facts.fct_orders(self.orders)

    @cached_property
    def full_fact(self) -> DataFrame:
        return facts.fct_orders(self.orders, self.products, self.users)

    @cached_property
    def daily_revenue(self) -> DataFrame:
        return aggregates.agg_daily_revenue(facts.fct_orders(self.orders, stg_users=self.users))

    @cached_property
    def product_performance(self) -> DataFrame:
        return aggregates.agg_product_performance(self.order_fact, AS_OF, self.products)

    @cached_property
    def user_dimension(self) -> DataFrame:
        return dimensions.dim_users(self.users, AS_OF)

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return star.raw_tables(self.spark, self.sf_dir)


# --- sources -------------------------------------------------------------------


def _from_files(t: Tables, table: str, fmt: str) -> DataFrame:
    """A raw table written out in its delivery format and read back as declared."""
    root = t.folder(f"raw-{fmt}-{table}")
    raw = getattr(star, f"raw_{table}")(t.spark, t.sf_dir).select(*RAW[table].fieldNames())
    options = {**readers.CSV_OPTIONS, **readers.CSV_TABLE_OPTIONS[table]} if fmt == "csv" else {}
    raw.write.format(fmt).options(**options).save(readers.table_path(root, table))
    return getattr(readers, f"read_{table}")(t.spark, root, fmt)


@query("source_csv_orders")
def _(t):
    return staging.stg_orders(_from_files(t, "orders", "csv"))


@query("source_csv_users")
def _(t):
    return staging.stg_users(_from_files(t, "users", "csv"))


@query("source_csv_products")
def _(t):
    return staging.stg_products(_from_files(t, "products", "csv"))


@query("source_csv_events")
def _(t):
    return staging.stg_events(_from_files(t, "events", "csv"))


def _spoilt_orders(t) -> tuple[DataFrame, DataFrame]:
    """Good rows and rejects of raw orders of which some are delivered with values or columns that can't be read."""
    root, number = t.folder("spoilt"), F.col("order_id").cast("long")
    raw = star.raw_orders(t.spark, t.sf_dir).select(*RAW["orders"].fieldNames())
    text = raw.select(number.alias("number"), *(F.col(c).cast("string") for c in raw.columns)).withColumns({
        "quantity": F.when(number % 11 == 0, "many").otherwise(F.col("quantity").cast("string")),
        "unit_price": F.when(number % 13 == 0, "9,50").otherwise(F.col("unit_price").cast("string")),
        "created_at": F.when(number % 17 == 0, F.date_format("created_at", "dd.MM.yy")).when(number % 2 == 0, F.date_format("created_at", "yyyy-MM-dd")).otherwise(
            F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss")),
        "order_id": F.when(number % 19 != 0, F.col("order_id")),
    })
    whole, short = text.filter("number % 23 <> 0").drop("number"), text.filter("number % 23 = 0")
    path = readers.table_path(root, "orders")
    whole.write.options(**readers.CSV_OPTIONS).csv(path)
    # A line without a header would pass for one, so these files are read without.
    cut = short.select(F.concat_ws(",", F.col("number").cast("string"), "user_id", "status").alias("value"))
    cut.write.text(readers.table_path(f"{root}-cut", "orders"))
    parts = [checked.read(t.spark, root, "orders"), checked.read(t.spark, f"{root}-cut", "orders", header="false")]
    return tuple(a.unionByName(b) for a, b in zip(*parts))


@query("source_checked_orders")
def _(t):
    return staging.stg_orders(_spoilt_orders(t)[0])


@query("source_rejected_orders")
def _(t):
    """How many delivered lines were rejected for which reasons."""
    rejects = _spoilt_orders(t)[1]
    return rejects.groupBy(F.concat_ws(" ", F.array_sort("reasons")).alias("reasons")).agg(F.count(F.lit(1)).alias("lines"))


@query("source_parquet_orders")
def _(t):
    return staging.stg_orders(_from_files(t, "orders", "parquet"))


# --- staging -------------------------------------------------------------------


@query("stg_orders")
def _(t):
    return t.orders


@query("stg_users")
def _(t):
    return t.users


@query("stg_users_hashed_pii")
def _(t):
    return staging.stg_users(star.raw_users(t.spark, t.sf_dir), pii="hash")


@query("stg_users_pseudonyms")
def _(t):
    """With a fixed key; jobs take theirs from the session."""
    return staging.stg_users(star.raw_users(t.spark, t.sf_dir), pii="pseudonym", key=bytes(range(32)), key_version=7)


@query("stg_products")
def _(t):
    return t.products


@query("stg_events")
def _(t):
    return staging.stg_events(t.raw_events)


@query("stg_events_earliest")
def _(t):
    return staging.stg_events(t.raw_events, keep="earliest")


# --- analytics -----------------------------------------------------------------


@query("fct_orders")
def _(t):
    return t.full_fact


@query("fct_orders_domain_status")
def _(t):
    fact = facts.fct_orders(t.orders, status_labels=DOMAIN_STATUS_LABELS)
    return fact.select("order_id", "status_raw", "status_category")


@query("fct_orders_excluding_status")
def _(t):
    fact = facts.fct_orders(t.orders, exclude_status=("cancelled", "refunded"))
    return fact.select("order_id", "status_raw", "gross_revenue", "net_revenue")


@query("fct_orders_cohort_index")
def _(t):
    fact = facts.fct_orders(t.orders, stg_users=t.users, cohort_month_index=True)
    return fact.select("order_id", "user_signup_date", "order_date", "cohort_month_index")


@query("dim_users")
def _(t):
    return t.user_dimension


@query("dim_products")
def _(t):
    return dimensions.dim_products(t.products)


@query("agg_daily_revenue")
def _(t):
    return t.daily_revenue


@query("agg_product_performance")
def _(t):
    return t.product_performance


@query("fct_user_funnel")
def _(t):
    return facts.fct_user_funnel(t.funnel_events)


@query("fct_user_funnel_first_view")
def _(t):
    return facts.fct_user_funnel(t.funnel_events, device="first_view")


# --- reports -------------------------------------------------------------------


@query("mom_revenue_growth")
def _(t):
    return reports.mom_revenue_growth(t.order_fact, AS_OF)


@query("mom_revenue_growth_whole_months")
def _(t):
    return reports.mom_revenue_growth(t.order_fact, AS_OF, whole_months=True)


@query("cohort_retention")
def _(t):
    return reports.cohort_retention(t.user_dimension, t.order_fact, "distinct")


@query("cohort_retention_two_level")
def _(t):
    return reports.cohort_retention(t.user_dimension, t.order_fact)


@query("cohort_retention_approx")
def _(t):
    return reports.cohort_retention(t.user_dimension, t.order_fact, "approx")


def _stored_sketches(t) -> DataFrame:
    """Sketches of three loads of orders, stored one after the other and merged."""
    fact = facts.fct_orders(t.orders, stg_users=t.users).select("order_id", "user_id", "order_date", "user_signup_date")
    path = t.folder("sketches")
    for n in range(3):
        load = fact.filter(F.pmod(F.xxhash64("order_id"), F.lit(3)) == n)
        sketches.activity_sketches(load).write.mode("append").parquet(path)
    return sketches.merge(t.spark.read.parquet(path))


@query("retention_from_sketches")
def _(t):
    """Counted users per cohort and month beside whether the stored sketches agree within four standard errors."""
    fact = facts.fct_orders(t.orders, stg_users=t.users).filter("user_signup_date IS NOT NULL AND order_date IS NOT NULL")
    exact = fact.select("user_id", F.trunc("user_signup_date", "MM").alias("cohort_month"), F.trunc("order_date", "MM").alias("order_month")).distinct()
    exact = exact.groupBy(*sketches.SKETCH_KEYS).agg(F.count("user_id").alias("users"))
    found = sketches.estimate(_stored_sketches(t)).withColumnRenamed("users", "estimate")
    near = F.abs(F.col("estimate") - F.col("users")) <= F.greatest(F.lit(1.0), 4 * sketches.STANDARD_ERROR * F.col("users"))
    return exact.join(found, list(sketches.SKETCH_KEYS), "full").select(
        *sketches.SKETCH_KEYS, "users", F.coalesce(near, F.lit(False)).alias("within_bound"))


@query("sketches_rolled_up")
def _(t):
    """Whether sketches rolled up to years give the estimates of a build in one go."""
    fact = facts.fct_orders(t.orders, stg_users=t.users)
    year = (F.year("order_month").alias("order_year"),)
    merged = sketches.estimate(_stored_sketches(t), year).withColumnRenamed("users", "merged")
    whole = sketches.estimate(sketches.activity_sketches(fact), year)
    return whole.join(merged, "order_year", "full").select("order_year", (F.col("users") == F.col("merged")).alias("equal"))


@query("trailing_product_performance")
def _(t):
    """Product performance moved over ten reporting days by what enters and leaves the horizons."""
    columns = [F.trunc("order_date", "MM").alias("order_month_start"), "*"]
    path = t.folder("product-days")
    trailing.product_days(t.order_fact).select(*columns).write.partitionBy("order_month_start").parquet(path)
    days, day = t.spark.read.parquet(path).drop("order_month_start"), AS_OF - dt.timedelta(10)
    sums = trailing.start(days, day)
    for n in range(10):
        later, kept = day + dt.timedelta(1), t.folder(f"product-sums-{n}")
        trailing.advance(sums, days, day, later).write.parquet(kept)
        sums, day = t.spark.read.parquet(kept), later
    return trailing.performance(sums, t.products)


@query("top_products_by_region")
def _(t):
    return reports.top_products_by_region(t.order_fact, AS_OF, stg_products=t.products)


@query("at_risk_customers")
def _(t):
    return reports.at_risk_customers(t.user_dimension, t.order_fact, AS_OF)


@query("at_risk_customers_lifetime_revenue")
def _(t):
    return reports.at_risk_customers(t.user_dimension, t.order_fact, AS_OF, lifetime_revenue=True)


@query("funnel_dropoff")
def _(t):
    return reports.funnel_dropoff_from_events(t.funnel_events)


@query("funnel_dropoff_joined")
def _(t):
    return reports.funnel_dropoff(facts.fct_user_funnel(t.funnel_events), t.funnel_events)


@query("funnel_dropoff_own_device")
def _(t):
    return reports.funnel_dropoff(facts.fct_user_funnel(t.funnel_events), device_source="funnel")


# --- ordered views -------------------------------------------------------------


@query("latest_orders")
def _(t):
    """Ten orders first, their dimensions after."""
    return facts.fct_orders(ranking.latest_orders(t.orders), t.products, t.users)


@query("daily_revenue_small_amounts")
def _(t):
    """Amounts far below a hundredth of a unit add up."""
    small = t.order_fact.withColumn("net_revenue", F.col("net_revenue") / 1048576)
    return small.groupBy("order_date", "region").agg(money.exact_sum(F.col("net_revenue")).alias("total_net_revenue"))


@query("preview_orders")
def _(t):
    return ranking.preview(t.orders)


@query("newest_users")
def _(t):
    return ranking.newest_users(t.user_dimension)


@query("top_margin_products")
def _(t):
    return ranking.best_margins(dimensions.dim_products(t.products))


@query("latest_daily_revenue")
def _(t):
    return ranking.latest_daily_revenue(t.daily_revenue)


@query("funnel_by_latest_view")
def _(t):
    return ranking.funnel_by_latest_view(facts.fct_user_funnel(t.funnel_events))


@query("event_timeline")
def _(t):
    return ranking.event_timeline(t.funnel_events)


# --- dashboard panels ------------------------------------------------------------


@query("panel_mtd_revenue")
def _(t):
    return panels.mtd_revenue(t.daily_revenue, AS_OF)


@query("panel_daily_trend")
def _(t):
    return panels.daily_revenue_trend(t.daily_revenue, AS_OF)


@query("panel_revenue_by_region")
def _(t):
    return panels.revenue_by_region(t.order_fact)


@query("panel_revenue_by_region_filtered")
def _(t):
    chosen = panels.dashboard_filter(t.order_fact, "2000-01-01", "2000-12-31", ["NA", "EU", "APAC"])
    return panels.revenue_by_region(chosen)


@query("panel_mom_growth_filtered")
def _(t):
    return reports.mom_revenue_growth(panels.dashboard_filter(t.order_fact, regions=["NA", "EU"]), AS_OF)


@query("panel_funnel_filtered")
def _(t):
    chosen = panels.dashboard_filter(t.funnel_events, "2024-01-05", "2024-01-20", day="created_at")
    return reports.funnel_dropoff_from_events(chosen)


@query("panel_top_products")
def _(t):
    return panels.top_products(t.product_performance)


@query("panel_at_risk_by_plan")
def _(t):
    return panels.at_risk_by_plan(reports.at_risk_customers(t.user_dimension, t.order_fact, AS_OF))


@query("panel_cohort_long")
def _(t):
    return panels.cohort_heatmap(reports.cohort_retention(t.user_dimension, t.order_fact))


# --- quality -------------------------------------------------------------------


@query("dq_null_keys")
def _(t):
    return quality.null_keys(t.raw)


@query("dq_duplicate_keys")
def _(t):
    return quality.duplicate_summary(t.raw)


@query("dq_duplicate_events")
def _(t):
    return quality.duplicate_keys(t.raw_events, "event_id")


@query("dq_orphans")
def _(t):
    return quality.orphan_summary(t.raw)


@query("dq_domains")
def _(t):
    return quality.domain_violations(t.raw)


@query("dq_readable")
def _(t):
    return quality.readable(t.raw)


@query("observed_write_metrics")
def _(t):
    """Quality metrics of the raw tables, taken along by the writes that store them."""
    path = t.folder("observed")
    return observed.write(t.raw, lambda name, df: df.write.parquet(f"{path}/{name}"))


@query("freshness")
def _(t):
    return quality.freshness(t.orders, F.lit(NOW).cast("timestamp"))


# --- views and stored tables -----------------------------------------------------


@query("view_plan_revenue")
def _(t):
    writers.register_views({"fct_orders": facts.fct_orders(t.orders, stg_users=t.users)}, "analytics")
    return t.spark.sql(
        "SELECT user_plan_type, order_year, count(order_id) AS orders, max(net_revenue) AS best_order "
        "FROM analytics_fct_orders GROUP BY user_plan_type, order_year"
    )


# The sample has too few orders a day to fill day partitions.
_MONTHLY = writers.MONTHLY_ORDER_PARTITIONS


@query("layout_fct_orders")
def _(t):
    path = t.folder("fct_orders")
    writers.write_fct_orders(writers.with_order_month(t.full_fact), path, _MONTHLY)
    stored = t.spark.read.parquet(path).filter(
        (F.col("order_month_start") >= dt.date(2000, 1, 1)) & (F.col("order_date") >= dt.date(2000, 1, 15))
    )
    return stored.select("order_id", "region", "order_date", "net_revenue", "user_plan_type")


@query("calendar_weekends")
def _(t):
    """Orders of the weekends of second quarters; the calendar's months prune the fact's partitions."""
    path = t.folder("fct_orders")
    writers.write_fct_orders(writers.with_order_month(t.full_fact), path, _MONTHLY)
    days = calendar.store(calendar.build(t.spark, dt.date(1990, 1, 1), dt.date(2009, 12, 31)), t.folder("calendar"))
    chosen = F.col("is_weekend") & (F.col("quarter") == 2)
    found = calendar.on_days(t.spark.read.parquet(path), days, chosen, "order_month_start")
    return found.select("order_id", "order_date", "region", "net_revenue")


@query("layout_stg_events")
def _(t):
    path = t.folder("stg_events")
    writers.write_stg_events(staging.stg_events(t.raw_events), path)
    stored = t.spark.read.parquet(path).filter(F.col("event_date") >= dt.date(2024, 1, 15))
    return stored.groupBy("event_date", "event_type", "device_type").agg(F.count("event_id").alias("events"))


@query("materialized_daily_revenue")
def _(t):
    path = t.folder("agg_daily_revenue")
    writers.write_daily_revenue(t.daily_revenue, path)
    return t.spark.read.parquet(path).select(*ANALYTICS["agg_daily_revenue"].fieldNames())


@query("materialized_product_performance")
def _(t):
    path = t.folder("agg_product_performance")
    writers.write_product_performance(t.product_performance, path)
    return t.spark.read.parquet(path)


@query("bucketed_user_revenue")
def _(t):
    """Revenue per user out of bucketed facts and users, which share their buckets."""
    stored = []
    users = t.users.select("user_id", F.col("plan_type").alias("user_plan_type"), F.col("country").alias("user_country"))
    for name, df in (("orders", t.order_fact.select("order_id", "user_id", "net_revenue")), ("users", users)):
        path = t.folder(f"bucketed-{name}")
        table = f"bucketed_{path.rsplit('-', 1)[1]}"
        stored.append(bucketed.write(df, table, path, "user_id", 8, split_hot=name == "orders"))
    return bucketed.revenue_by_user(*stored)


# --- incremental loads -----------------------------------------------------------

# The first load holds orders up to MISSING_FROM, those from STALE_FROM on in an
# old version: pending and dated earlier. The second brings the final version of
# all orders from STALE_FROM on.
STALE_FROM, MISSING_FROM = "2001-06-15", "2001-07-15"


def _two_loads(t: Tables) -> tuple[DataFrame, DataFrame]:
    orders, created = t.orders, F.col("created_at")
    stale = created >= STALE_FROM
    first = orders.filter(created < MISSING_FROM).withColumns({
        "status": F.when(stale, "PENDING").otherwise(F.col("status")),
        "created_at": F.when(stale, created - F.expr("INTERVAL 40 DAYS")).otherwise(created),
    })
    fact = lambda stg: writers.with_order_month(facts.fct_orders(stg, t.products, t.users))
    return fact(first), fact(orders.filter(stale))


@query("incremental_recent_orders")
def _(t):
    now = F.lit(NOW).cast("timestamp")
    recent = incremental.changed_since(t.order_fact, incremental.look_back(now, 24 * 7), "order_date")
    return recent.select("order_id", "order_date", "net_revenue")


@query("high_water_mark")
def _(t):
    return incremental.high_water_mark(t.orders)


@query("incremental_upsert_equals_full")
def _(t):
    target, first, second = t.folder("fct_orders"), *_two_loads(t)
    for n, load in enumerate((first, second)):
        run = t.folder(f"upsert-{n}")
        incremental.upsert_orders(t.spark, load, target, run, partition_by=_MONTHLY)
    return t.spark.read.schema(first.schema).parquet(target).select(*ANALYTICS["fct_orders"].fieldNames())


@query("incremental_daily_refresh")
def _(t):
    target, daily = t.folder("fct_orders"), t.folder("agg_daily_revenue")
    for n, load in enumerate(_two_loads(t)):
        run = t.folder(f"upsert-{n}")
        incremental.upsert_orders(t.spark, load, target, run, partition_by=_MONTHLY)
        stored = t.spark.read.schema(load.schema).parquet(target)
        days = incremental.touched_days(t.spark, load.schema, run)
        incremental.refresh_daily_revenue(t.spark, stored, daily, days, f"{run}/daily")
    return t.spark.read.parquet(daily).select(*ANALYTICS["agg_daily_revenue"].fieldNames())


@query("key_directory_places")
def _(t):
    """Where the orders of the second load are stored after the first, by the key directory."""
    first, second = _two_loads(t)
    directory = KeyDirectory(t.spark, t.folder("keys"), ["order_id"], "order_month_start", first.schema)
    directory.add(first)
    return directory.find(second, t.folder("known"))


@query("incremental_funnel_merge")
def _(t):
    middle = "2024-01-15"
    events = staging.stg_events(t.raw_events, columns=staging.FUNNEL_EVENT_COLUMNS)
    before = facts.fct_user_funnel(events.filter(F.col("created_at") < middle))
    return jobs.merge_funnel(before, events.filter(F.col("created_at") >= middle))


# --- streams -------------------------------------------------------------------


def _finish(query) -> None:
    query.awaitTermination()


@query("stream_orders_upsert")
def _(t):
    target, daily, checkpoint = (t.folder(n) for n in ("fct_orders", "agg_daily_revenue", "orders-job"))
    _finish(jobs.ingest_orders(
        star.stream_orders(t.spark, t.sf_dir), t.products, t.users, target, checkpoint, daily,
        partition_by=_MONTHLY, extend=writers.with_order_month,
    ))
    return t.spark.read.parquet(daily).select(*ANALYTICS["agg_daily_revenue"].fieldNames())


def _arrivals(t, table: str, start: Callable[[DataFrame], object], key: str, parts: int = 3) -> None:
    """Deliver a raw table in files that arrive one after the other, each followed by a run of the job.

    Files are dealt by a hash of the key, so all later files bring rows of days that earlier ones had.
    """
    lake, dealt = t.folder(f"lake-{table}"), t.folder(f"dealt-{table}")
    raw = getattr(star, f"raw_{table}")(t.spark, t.sf_dir).select(*RAW[table].fieldNames())
    # The table is mapped once, not once per delivery.
    numbered = raw.withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
    numbered.write.partitionBy("part").parquet(dealt)
    for part in range(parts):
        arrived = t.spark.read.schema(numbered.schema).parquet(dealt).filter(F.col("part") == part).drop("part")
        arrived.write.mode("append").parquet(readers.table_path(lake, table))
        _finish(start(readers.stream_raw(t.spark, lake, table, "parquet")))


@query("stream_daily_revenue")
def _(t):
    target, checkpoint = t.folder("daily"), t.folder("daily-job")
    _arrivals(t, "orders", lambda raw: jobs.publish_daily_revenue(raw, t.users, target, checkpoint), "order_id")
    return t.spark.read.parquet(target).select(*ANALYTICS["agg_daily_revenue"].fieldNames())


@query("stream_events_latest")
def _(t):
    target, checkpoint = t.folder("events"), t.folder("events-job")
    _finish(jobs.ingest_events(star.stream_events(t.spark, t.sf_dir), target, checkpoint))
    return t.spark.read.parquet(target).select(*STAGING["stg_events"].fieldNames())


@query("stream_events_first_arrival")
def _(t):
    target, checkpoint = t.folder("events"), t.folder("dedupe-job")
    # Copies of an event arrive in different files, the earlier one first.
    lake = t.folder("lake-copies")
    raw = t.raw_events.select(*RAW["events"].fieldNames())
    firsts = staging.event_copy_order("earliest")
    numbered = raw.withColumn("copy", F.row_number().over(Window.partitionBy("event_id").orderBy(*firsts)))
    for part in (1, 2):
        numbered.filter(F.col("copy") == part).drop("copy").write.mode("append").parquet(readers.table_path(lake, "events"))
        _finish(jobs.ingest_first_arrivals(readers.stream_raw(t.spark, lake, "events", "parquet"), target, checkpoint))
    return t.spark.read.parquet(target).select(*STAGING["stg_events"].fieldNames())


def _deliver(t, table: str, parts: list[DataFrame], run: Callable[[DataFrame], None]) -> None:
    """Raw rows in files that arrive one after the other, each followed by runs of the jobs."""
    lake = t.folder(f"lake-{table}")
    for part in parts:
        part.select(*RAW[table].fieldNames()).write.mode("append").parquet(readers.table_path(lake, table))
        run(readers.stream_raw(t.spark, lake, table, "parquet"))


def _copies(t) -> DataFrame:
    firsts = staging.event_copy_order("earliest")
    return t.raw_events.withColumn("copy", F.row_number().over(Window.partitionBy("event_id").orderBy(*firsts)))


@query("stream_events_far_copies")
def _(t):
    """First arrivals whose later copies come three days on, three months back, or without a readable time."""
    target, checkpoint = t.folder("events"), t.folder("dedupe-job")
    copies, time = _copies(t), F.col("created_at").cast("timestamp")
    kind = F.pmod(F.col("event_id").cast("long"), F.lit(3))
    moved = F.when(kind == 0, time + F.expr("INTERVAL 3 DAYS")).when(kind == 1, time - F.expr("INTERVAL 90 DAYS"))
    later = copies.filter(F.col("copy") == 2).withColumn("created_at", F.coalesce(F.date_format(moved, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("?")))
    undated = copies.filter("copy = 1 AND event_id % 7 = 0").withColumn("created_at", F.lit(None).cast("string"))
    dated = copies.filter("copy = 1 AND event_id % 7 <> 0")
    _deliver(t, "events", [undated.unionByName(dated), later], lambda raw: _finish(jobs.ingest_first_arrivals(raw, target, checkpoint)))
    return t.spark.read.parquet(target).select(*STAGING["stg_events"].fieldNames())


@query("stream_events_bounded_state")
def _(t):
    """Deduplication behind a watermark; a twentieth of the events come long after their time."""
    root, target, *job = (t.folder(n) for n in ("routed", "events", "route-job", "dedupe-job"))
    copies = _copies(t)
    middle, late = F.lit("2024-01-15"), F.col("event_id").cast("long") % 20 == 0
    early = (F.col("created_at") < middle) & ~late
    parts = [copies.filter(early & (F.col("copy") == 1)), copies.filter(early & (F.col("copy") == 2)),
             copies.filter(~early & ~late), copies.filter(late)]
    schema = STAGING["stg_events"]

    def run(raw):
        _finish(watermarks.route(raw, root, job[0], "5 DAYS", prepare=watermarks.first_of_batch))
        _finish(watermarks.deduplicate(watermarks.on_time(t.spark, root, schema), target, job[1], "5 days"))

    _deliver(t, "events", parts, run)
    return watermarks.first_arrivals(t.spark.read.parquet(target), watermarks.late(t.spark, root, schema))


@query("stream_windows_with_late_orders")
def _(t):
    """Daily windows behind a watermark; some orders come long after their day, others have none."""
    root, target, *job = (t.folder(n) for n in ("routed", "windows", "route-job", "window-job"))
    raw, number = star.raw_orders(t.spark, t.sf_dir), F.col("order_id").cast("long")
    raw = raw.withColumn("created_at", F.when(number % 101 != 0, F.col("created_at")))
    late, year = number % 50 == 0, F.coalesce(F.year("created_at"), F.lit(0))
    parts = [raw.filter(~late & (year < 1995)), raw.filter(~late & (year >= 1995) & (year < 1998)), raw.filter(late | (year >= 1998))]

    def run(orders):
        _finish(watermarks.route(orders, root, job[0], "1 DAY"))
        _finish(watermarks.daily_windows(watermarks.on_time(t.spark, root, RAW["orders"]), t.users, target, job[1], "1 DAY"))

    _deliver(t, "orders", parts, run)
    late_orders = watermarks.late(t.spark, root, RAW["orders"])
    found = watermarks.daily_revenue_with_late(t.spark.read.parquet(target), late_orders, t.users)
    return found.select(*ANALYTICS["agg_daily_revenue"].fieldNames())


@query("stream_late_orders")
def _(t):
    """The rows that the router tells to be late, by the clock of three deliveries."""
    root, job = t.folder("routed"), t.folder("route-job")
    raw = star.raw_orders(t.spark, t.sf_dir)
    number = F.col("order_id").cast("long") % 3
    _deliver(t, "orders", [raw.filter((number == n) & (F.year("created_at") <= 1994 + 2 * n)) for n in range(3)],
             lambda orders: _finish(watermarks.route(orders, root, job, "400 DAYS")))
    return watermarks.late(t.spark, root, RAW["orders"]).select("order_id", "created_at")


@query("stream_funnel")
def _(t):
    events, steps, checkpoint = t.folder("events"), t.folder("steps"), t.folder("funnel-job")
    # Dealt by creation time: the later copy of an event comes in another file than the first.
    _arrivals(t, "events", lambda raw: jobs.publish_funnel(raw, events, steps, checkpoint), "created_at")
    return jobs.stored_funnel(t.spark.read.parquet(steps))


@query("warehouse_stored_reports")
def _(t):
    """Reports over stored tables: the retention matrix out of a fully materialised build."""
    staged = warehouse.build_staging(t.raw)
    tables = warehouse.materialize(t.spark, staged, t.folder("warehouse"), AS_OF, monthly=True)
    return tables["cohort_retention"]
