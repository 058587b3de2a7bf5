"""The whole build: raw tables to staging, models and reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession

from basketry.operators import aggregates, dimensions, facts, quality, staging
from basketry.plans import reports
from basketry.schemas import ANALYTICS, STAGING
from basketry.sources import readers, writers

AsOf = dt.date | str | Column | None


def build_staging(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Staged tables; from here on no personal columns."""
    staged = {
        "stg_orders": staging.stg_orders(raw["orders"]),
        "stg_users": staging.stg_users(raw["users"]),
        "stg_products": staging.stg_products(raw["products"]),
        "stg_events": staging.stg_events(raw["events"]),
    }
    for name, df in staged.items():
        quality.assert_no_pii(quality.assert_schema(df, STAGING[name]))
    return staged


def build_analytics(staged: Mapping[str, DataFrame], as_of: AsOf = None) -> dict[str, DataFrame]:
    """Models, from staged tables only."""
    orders, products, users = (staged[f"stg_{t}"] for t in ("orders", "products", "users"))
    fct = facts.fct_orders(orders, products, users)
    models = {
        "fct_orders": fct,
        "dim_users": dimensions.dim_users(users, as_of),
        "dim_products": dimensions.dim_products(products),
        "agg_daily_revenue": aggregates.agg_daily_revenue(facts.fct_orders(orders, stg_users=users)),
        "agg_product_performance": aggregates.agg_product_performance(
            facts.fct_orders(orders), as_of, products
        ),
        "fct_user_funnel": facts.fct_user_funnel(staged["stg_events"]),
    }
    for name, df in models.items():
        quality.assert_no_pii(quality.assert_schema(df, ANALYTICS[name]), derived=True)
    return models


def build_reports(
    staged: Mapping[str, DataFrame], models: Mapping[str, DataFrame], as_of: AsOf = None
) -> dict[str, DataFrame]:
    """Reports from models; ``models`` may be the lazy ones or tables read back from storage."""
    fct, users = models["fct_orders"], models["dim_users"]
    return {
        "mom_revenue_growth": reports.mom_revenue_growth(fct, as_of),
        "cohort_retention": reports.cohort_retention(users, fct),
        "top_products_by_region": reports.top_products_by_region(fct, as_of),
        "at_risk_customers": reports.at_risk_customers(users, fct, as_of),
        "funnel_dropoff": reports.funnel_dropoff(models["fct_user_funnel"], staged["stg_events"]),
    }


def build_lazy_reports(raw: Mapping[str, DataFrame], as_of: AsOf = None) -> dict[str, DataFrame]:
    """The same reports straight from raw tables, each reading and joining only what it needs."""
    fct = facts.fct_orders(staging.stg_orders(raw["orders"]))
    users = dimensions.dim_users(staging.stg_users(raw["users"]), as_of)
    events = staging.stg_events(raw["events"], columns=staging.FUNNEL_EVENT_COLUMNS)
    products = staging.stg_products(raw["products"])
    return {
        "mom_revenue_growth": reports.mom_revenue_growth(fct, as_of),
        "cohort_retention": reports.cohort_retention(users, fct),
        "top_products_by_region": reports.top_products_by_region(fct, as_of, stg_products=products),
        "at_risk_customers": reports.at_risk_customers(users, fct, as_of),
        "funnel_dropoff": reports.funnel_dropoff_from_events(events),
    }


def build_all(
    spark: SparkSession, raw_root: str, as_of: AsOf = None, fmt: str = "csv"
) -> dict[str, DataFrame]:
    """Every staged table, model and report over a raw folder, lazily."""
    raw = readers.read_all(spark, raw_root, fmt)
    staged = build_staging(raw)
    return {**staged, **build_analytics(staged, as_of), **build_lazy_reports(raw, as_of)}


def register_all(staged: Mapping[str, DataFrame], models: Mapping[str, DataFrame]) -> list[str]:
    """Temporary views ``staging_*`` and ``analytics_*`` for SQL users."""
    return writers.register_views(staged, "staging") + writers.register_views(models, "analytics")


def materialize(
    spark: SparkSession,
    staged: Mapping[str, DataFrame],
    out: str,
    as_of: AsOf = None,
    monthly: bool = False,
) -> dict[str, DataFrame]:
    """Write events, facts and aggregates once and hand back everything on top of the files.

    Reports then read the stored fact, pruned by day and column, instead of
    repeating deduplication and dimension joins. ``monthly`` stores the fact by
    month instead of by day.
    """
    def stored(name: str) -> DataFrame:
        schema = STAGING.get(name) or ANALYTICS[name]
        return spark.read.parquet(f"{out}/{name}").select(*schema.fieldNames())

    writers.write_stg_events(staged["stg_events"], f"{out}/stg_events")
    staged = {**staged, "stg_events": stored("stg_events")}
    models = build_analytics(staged, as_of)
    fct, partitions = models["fct_orders"], writers.ORDER_PARTITIONS
    if monthly:
        fct, partitions = writers.with_order_month(fct), writers.MONTHLY_ORDER_PARTITIONS
    writers.write_fct_orders(fct, f"{out}/fct_orders", partitions)
    models["fct_orders"] = stored("fct_orders")
    fct = models["fct_orders"]
    writers.write_daily_revenue(aggregates.agg_daily_revenue(fct), f"{out}/agg_daily_revenue")
    writers.write_product_performance(
        aggregates.agg_product_performance(fct, as_of), f"{out}/agg_product_performance"
    )
    models["fct_user_funnel"].write.mode("overwrite").parquet(f"{out}/fct_user_funnel")
    for name in ("agg_daily_revenue", "agg_product_performance", "fct_user_funnel"):
        models[name] = stored(name)
    # Only the reports see the column the monthly layout is partitioned by.
    by_month = {**models, "fct_orders": spark.read.parquet(f"{out}/fct_orders")} if monthly else models
    return {**staged, **models, **build_reports(staged, by_month, as_of)}
