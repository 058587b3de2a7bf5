"""Daily revenue and product performance."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.dates import as_of_date, in_last_days
from basketry.functions.money import as_decimal, as_double, exact_avg, exact_sum

DAILY_KEYS = ("order_date", "region", "user_plan_type")


def daily_measures() -> list[Column]:
    return [
        F.count("order_id").alias("order_count"),
        exact_sum(F.col("gross_revenue")).alias("total_gross_revenue"),
        exact_sum(F.col("net_revenue")).alias("total_net_revenue"),
        exact_avg(F.col("net_revenue")).alias("Avg_net_revenue"),
    ]


def agg_daily_revenue(fct_orders: DataFrame) -> DataFrame:
    """Orders, revenue and average order value per day, region and plan."""
    return fct_orders.groupBy(*DAILY_KEYS).agg(*daily_measures())


# Horizon suffix and trailing days; None is all time.
HORIZONS = (("last_30d", 30), ("last_90d", 90), ("all_time", None))


def _product_sums(as_of: Column) -> list[Column]:
    """Sums per horizon that still allow attaching the unit cost later."""
    quantity, net = F.col("quantity").cast("long"), as_decimal(F.col("net_revenue"))
    costed = F.when(F.col("net_revenue").isNotNull(), quantity)
    sums = []
    for suffix, days in HORIZONS:
        if days is None:
            inside, outside = (lambda c: c), F.lit(0)
        else:
            recent = in_last_days(F.col("order_date"), as_of, days)
            inside = lambda c, recent=recent: F.when(recent, c).otherwise(F.lit(0))
            outside = F.when(F.coalesce(recent, F.lit(False)), F.lit(0)).otherwise(F.lit(1))
        sums += [
            F.sum(inside(quantity)).alias(f"units_{suffix}"),
            F.sum(inside(net)).alias(f"net_{suffix}"),
            F.sum(inside(costed)).alias(f"costed_{suffix}"),
            F.max(outside).alias(f"outside_{suffix}"),
        ]
    return sums


def agg_product_performance(
    fct_orders: DataFrame,
    as_of: dt.date | str | Column | None = None,
    stg_products: DataFrame | None = None,
) -> DataFrame:
    """Units, revenue and profit per product over 30 days, 90 days and all time, in one pass.

    Rows outside a horizon count as 0 in it; rows later than ``as_of`` are inside.
    An order whose product has no cost adds revenue but no profit.

    Orders are summed per product before names and costs come in: with
    ``stg_products`` the join meets one row per product instead of the order
    table, whatever share of the orders one product holds. Without it the fact
    must carry the product columns.
    """
    day = as_of_date(as_of)
    if stg_products is None:
        grouped = fct_orders.groupBy("product_id", "product_name", "product_cost_price")
        per_product = grouped.agg(*_product_sums(day))
    else:
        names = stg_products.select(
            "product_id", "product_name", F.col("cost_price").alias("product_cost_price")
        )
        summed = fct_orders.groupBy("product_id").agg(*_product_sums(day))
        per_product = summed.join(names, "product_id", "left")

    return performance_measures(per_product)


def performance_measures(per_product: DataFrame) -> DataFrame:
    """Units, revenue and profit per product out of its sums, name and cost."""
    cost = F.col("product_cost_price")
    measures = []
    for suffix, _ in HORIZONS:
        known = F.col(f"net_{suffix}") - cost.cast("decimal(17,10)") * F.col(f"costed_{suffix}").cast("decimal(15,0)")
        only_outside = F.when(F.col(f"outside_{suffix}") > 0, F.lit(0).cast("long"))
        profit = F.when(cost.isNull(), only_outside).otherwise(known)
        measures += [
            F.sum(f"units_{suffix}").alias(f"units_{suffix}"),
            as_double(F.sum(f"net_{suffix}")).alias(f"revenue_{suffix}"),
            as_double(F.sum(profit)).alias(f"profit_{suffix}"),
        ]
    return per_product.groupBy("product_id", "product_name").agg(*measures)
