"""The queries behind the dashboard panels."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.dates import as_of_date
from basketry.functions.money import exact_sum, percent
from basketry.plans.reports import RETENTION_MONTHS

AsOf = dt.date | str | Column | None


def dashboard_filter(
    df: DataFrame,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    regions: Sequence[str] | None = None,
    day: str = "order_date",
) -> DataFrame:
    """Global date and region filters, both ends inclusive; apply to a fact, aggregate or events before a panel.

    ``day`` names a date or time column: events take ``created_at``, and have no region.
    """
    if start is not None:
        df = df.filter(F.col(day) >= as_of_date(start))
    if end is not None:
        # Also right for times, and a plain bound that reaches the scan.
        df = df.filter(F.col(day) < F.date_add(as_of_date(end), 1))
    if regions is not None:
        df = df.filter(F.col("region").isin(*regions))
    return df


def mtd_revenue(agg_daily_revenue: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Net revenue of the month to date, of the previous month to the same day, and the change."""
    day = as_of_date(as_of)
    month, prior_day = F.trunc(day, "MM"), F.add_months(day, -1)
    prior_month = F.trunc(prior_day, "MM")
    date, net = F.col("order_date"), F.col("total_net_revenue")
    totals = agg_daily_revenue.filter(date.between(prior_month, day)).agg(
        exact_sum(F.when(date >= month, net).otherwise(0.0)).alias("mtd_revenue"),
        exact_sum(F.when(date <= prior_day, net).otherwise(0.0)).alias("prior_mtd_revenue"),
    )
    delta = F.col("mtd_revenue") - F.col("prior_mtd_revenue")
    return totals.select(
        "mtd_revenue",
        "prior_mtd_revenue",
        delta.alias("delta"),
        percent(delta, F.col("prior_mtd_revenue")).alias("delta_pct"),
    )


def daily_revenue_trend(agg_daily_revenue: DataFrame, as_of: AsOf = None, days: int = 90) -> DataFrame:
    day = as_of_date(as_of)
    recent = agg_daily_revenue.filter(F.col("order_date").between(F.date_sub(day, days), day))
    daily = recent.groupBy("order_date").agg(
        F.sum("order_count").alias("order_count"),
        exact_sum(F.col("total_net_revenue")).alias("total_net_revenue"),
    )
    return daily.orderBy("order_date")


def revenue_by_region(fct_orders: DataFrame) -> DataFrame:
    totals = fct_orders.groupBy("region").agg(
        F.count("order_id").alias("order_count"),
        exact_sum(F.col("net_revenue")).alias("total_net_revenue"),
    )
    return totals.orderBy(F.col("total_net_revenue").desc_nulls_last(), "region")


def top_products(
    agg_product_performance: DataFrame, n: int = 10, horizon: str = "all_time"
) -> DataFrame:
    """Best products by net revenue over ``last_30d``, ``last_90d`` or ``all_time``."""
    revenue = F.col(f"revenue_{horizon}")
    ordered = agg_product_performance.orderBy(revenue.desc_nulls_last(), F.col("product_id").asc_nulls_last())
    return ordered.limit(n).select("product_id", "product_name", revenue.alias("net_revenue"))


def at_risk_by_plan(at_risk_customers: DataFrame) -> DataFrame:
    counts = at_risk_customers.groupBy("plan_type").agg(F.count(F.lit(1)).alias("customers"))
    return counts.orderBy("plan_type")


def cohort_heatmap(cohort_retention: DataFrame) -> DataFrame:
    """The retention matrix in long form, one row per cohort and month."""
    months = [f"month{m}_pct" for m in RETENTION_MONTHS]
    long = cohort_retention.unpivot(
        ["cohort_month", "total_users"], months, "month_column", "retention_pct"
    )
    number = F.regexp_extract("month_column", r"(\d+)", 1).cast("int")
    return long.select(
        "cohort_month", "total_users", number.alias("months_after_signup"), "retention_pct"
    )
