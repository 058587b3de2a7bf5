"""The five business reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.functions.dates import (
    as_of_date, in_last_days, in_last_months, month_number, month_start, year_month,
)
from basketry.functions.money import as_decimal, as_double, exact_sum, percent, round_half_away
from basketry.operators.facts import user_device_outcomes
from basketry.operators.ranking import top_ranked
from basketry.schemas import FUNNEL_STEPS

AsOf = dt.date | str | Column | None


def _recent(fct_orders: DataFrame, inside: Callable[[Column], Column]) -> DataFrame:
    """Orders whose day is ``inside`` a trailing window.

    On a fact stored by month the last day of the month must be inside too,
    which follows for every such order and leaves older partitions unread.
    """
    recent = fct_orders.filter(inside(F.col("order_date")))
    if "order_month_start" in fct_orders.columns:
        recent = recent.filter(inside(F.last_day("order_month_start")))
    return recent


def monthly_revenue(fct_orders: DataFrame) -> DataFrame:
    """Net revenue per calendar month, labelled yyyy-MM."""
    by_month = fct_orders.groupBy(month_start(F.col("order_date")).alias("month_start"))
    totals = by_month.agg(exact_sum(F.col("net_revenue")).alias("total_revenue"))
    return totals.select(year_month(F.col("month_start")).alias("month"), "total_revenue")


def mom_revenue_growth(
    fct_orders: DataFrame, as_of: AsOf = None, months: int = 12, whole_months: bool = False
) -> DataFrame:
    """Monthly net revenue of the trailing months and its change on the previous month present.

    The window starts on the day ``months`` months ago, so the first bucket is
    usually a part month; ``whole_months`` starts it on the first of a month.
    The unpartitioned window sees one row per month.
    """
    recent = _recent(fct_orders, lambda day: in_last_months(day, as_of_date(as_of), months, whole_months))
    revenue, previous = F.col("total_revenue"), F.col("previous_month_revenue")
    growth = round_half_away(F.try_divide((revenue - previous) * 100.0, previous))
    return (
        monthly_revenue(recent)
        .withColumn("previous_month_revenue", F.lag("total_revenue").over(Window.orderBy("month")))
        .withColumn("mom_growth_percentage", growth)
        .orderBy("month")
    )


RETENTION_MONTHS = (0, 1, 2, 3)


def cohort_retention(
    dim_users: DataFrame,
    fct_orders: DataFrame,
    method: str = "two_level",
    rsd: float = 0.02,
) -> DataFrame:
    """Share of each signup cohort that ordered in month 0 to 3 after signup.

    Users without orders stay in the denominator. Orders shrink to one row per
    user and calendar month before they meet the users. ``two_level`` then
    flags each user once and sums the flags; ``distinct`` counts distinct users
    directly; ``approx`` estimates the distinct counts within ``rsd``.
    """
    active = fct_orders.filter(F.col("user_id").isNotNull()).select(
        "user_id", month_number(F.col("order_date")).alias("order_month")
    )
    users = dim_users.select("user_id", "cohort_month", "signup_date")
    joined = users.join(active.distinct(), "user_id", "left")
    offset = F.col("order_month") - month_number(F.col("signup_date"))

    if method == "two_level":
        per_user = joined.groupBy("user_id", "cohort_month").agg(
            *(F.max(F.when(offset == m, 1).otherwise(0)).alias(f"in_month{m}") for m in RETENTION_MONTHS)
        )
        counts = per_user.groupBy("cohort_month").agg(
            F.count("user_id").alias("total_users"),
            *(F.sum(f"in_month{m}").alias(f"users{m}") for m in RETENTION_MONTHS),
        )
    elif method in ("distinct", "approx"):
        def distinct(users: Column) -> Column:
            return F.count_distinct(users) if method == "distinct" else F.approx_count_distinct(users, rsd)

        counts = joined.groupBy("cohort_month").agg(
            distinct(F.col("user_id")).alias("total_users"),
            *(
                distinct(F.when(offset == m, F.col("user_id"))).alias(f"users{m}")
                for m in RETENTION_MONTHS
            ),
        )
    else:
        raise ValueError("method is 'two_level', 'distinct' or 'approx'")
    shares = (
        percent(F.col(f"users{m}"), F.col("total_users")).alias(f"month{m}_pct")
        for m in RETENTION_MONTHS
    )
    return counts.select("cohort_month", "total_users", *shares).orderBy("cohort_month")


def top_products_by_region(
    fct_orders: DataFrame,
    as_of: AsOf = None,
    days: int = 90,
    n: int = 5,
    stg_products: DataFrame | None = None,
) -> DataFrame:
    """Products ranked ``n`` or better by recent net revenue in each region, ties included.

    With ``stg_products`` the fact may lack product columns: names join the
    revenue per region and product, not the orders.
    """
    keys = ["region", "product_id", "product_name", "product_category"]
    recent = _recent(fct_orders, lambda day: in_last_days(day, as_of_date(as_of), days))
    units = F.sum(as_decimal(F.col("net_revenue"))).alias("units")
    if stg_products is None:
        revenue = recent.groupBy(*keys).agg(units)
    else:
        names = stg_products.select("product_id", "product_name", F.col("category").alias("product_category"))
        summed = recent.groupBy("region", "product_id").agg(units)
        revenue = summed.join(names, "product_id", "left").groupBy(*keys).agg(F.sum("units").alias("units"))
    ranked = top_ranked(
        revenue.select(*keys, as_double(F.col("units")).alias("total_revenue")),
        ["region"], "total_revenue", n, "product_rank",
    )
    return ranked.orderBy("region", "product_rank", "product_id")


def at_risk_customers(
    dim_users: DataFrame,
    fct_orders: DataFrame,
    as_of: AsOf = None,
    plans: Sequence[str] = ("pro", "enterprise"),
    min_orders: int = 3,
    idle_days: int = 60,
    lifetime_revenue: bool = False,
) -> DataFrame:
    """Paying users with enough orders and none in the last ``idle_days`` days.

    Orders are summed per user first, so the join meets one row per user.
    """
    per_user = fct_orders.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.count("order_id").alias("orders"),
        F.max("order_date").alias("last_order"),
        F.sum(as_decimal(F.col("net_revenue"))).alias("units"),
    )
    paying = dim_users.filter(F.col("plan_type").isin(*plans)).select("user_id", "plan_type")
    revenue = [as_double(F.sum("units")).alias("lifetime_revenue")] if lifetime_revenue else []
    summed = paying.join(per_user, "user_id").groupBy("user_id", "plan_type").agg(
        F.sum("orders").alias("total_orders"), F.max("last_order").alias("last_order_date"), *revenue
    )
    return summed.filter(
        (F.col("total_orders") >= min_orders)
        & (F.col("last_order_date") < F.date_sub(as_of_date(as_of), idle_days))
    )


def _dropoff_rates(outcomes: DataFrame) -> DataFrame:
    everyone = F.count(F.lit(1))
    rates = (
        percent(F.sum(f"dropped_after_{step}"), everyone).alias(f"drop_after_{step}_pct")
        for step in ("view", "cart", "checkout")
    )
    grouped = outcomes.groupBy("device_type").agg(everyone.alias("total_users"), *rates)
    return grouped.orderBy(F.col("device_type").asc_nulls_first())


def funnel_dropoff(
    fct_user_funnel: DataFrame,
    stg_events: DataFrame | None = None,
    device_source: str = "events",
) -> DataFrame:
    """Drop-off rates per device from a stored funnel.

    A user counts once under every device seen in their events, or with
    ``device_source="funnel"`` under the funnel's own device only.
    """
    if device_source == "funnel":
        return _dropoff_rates(fct_user_funnel)
    if device_source != "events" or stg_events is None:
        raise ValueError("device_source is 'funnel', or 'events' with stg_events given")
    devices = stg_events.select("user_id", "device_type").distinct()
    return _dropoff_rates(fct_user_funnel.drop("device_type").join(devices, "user_id"))


def funnel_dropoff_from_events(stg_events: DataFrame, steps: Sequence[str] = FUNNEL_STEPS) -> DataFrame:
    """The same rates straight from events: one deduplication and no join."""
    return _dropoff_rates(user_device_outcomes(stg_events, steps))
