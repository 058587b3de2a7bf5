"""Product performance over trailing days, moved from one reporting day to the next.

Orders are reduced once to sums per day and product. The sums of a horizon on a later day are those of the earlier day,
plus the days that enter, less the days that leave it. Sums are of decimals and whole numbers, so taking away what
was added leaves nothing behind, and the result equals a build from all orders.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.money import as_decimal
from basketry.operators.aggregates import HORIZONS, performance_measures

_SUMS = ("units", "units_known", "net", "net_known", "costed", "rows")


def product_days(fct_orders: DataFrame) -> DataFrame:
    """order_date, product_id and sums: quantities, revenue, quantities with revenue, and how many orders have each."""
    quantity, net = F.col("quantity").cast("long"), F.col("net_revenue")
    whole = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    return fct_orders.groupBy("order_date", "product_id").agg(
        whole(F.sum(quantity)).alias("units"), F.count(quantity).alias("units_known"),
        F.coalesce(F.sum(as_decimal(net)).cast("decimal(38,10)"), F.lit(0).cast("decimal(38,10)")).alias("net"), F.count(net).alias("net_known"),
        whole(F.sum(F.when(net.isNotNull(), quantity))).alias("costed"), F.count(F.lit(1)).alias("rows"))


def _inside(day: Column, as_of: dt.date, days: int | None) -> Column:
    return F.lit(True) if days is None else F.coalesce(day >= F.lit(as_of - dt.timedelta(days)), F.lit(False))


def _sums(weights: dict[str, Column]) -> list[Column]:
    """Sums per horizon, each row weighted with 1, 0 or -1; not multiplied, which would cost decimals their last digits."""
    def signed(name: str, weight: Column) -> Column:
        return F.when(weight > 0, F.col(name)).when(weight < 0, -F.col(name)).otherwise(F.lit(0))

    return [F.sum(signed(name, weight)).cast("decimal(38,10)" if name == "net" else "long").alias(f"{name}_{suffix}")
            for suffix, weight in weights.items() for name in _SUMS]


def start(days: DataFrame, as_of: dt.date) -> DataFrame:
    """Sums per product and horizon on a reporting day, out of all days up to it and rows without a day."""
    known = days.filter(F.col("order_date").isNull() | (F.col("order_date") <= F.lit(as_of)))
    return known.groupBy("product_id").agg(*_sums({s: _inside(F.col("order_date"), as_of, d).cast("int") for s, d in HORIZONS}))


def moving_days(before: dt.date, as_of: dt.date) -> Column:
    """Which days enter or leave a horizon between two reporting days; on a table partitioned by day the others are not read."""
    day, found = F.col("order_date"), (F.col("order_date") > F.lit(before)) & (F.col("order_date") <= F.lit(as_of))
    for _, days in HORIZONS:
        if days is not None:
            found |= (day >= F.lit(before - dt.timedelta(days))) & (day < F.lit(as_of - dt.timedelta(days)))
    return found


def advance(sums: DataFrame, days: DataFrame, before: dt.date, as_of: dt.date, late: DataFrame | None = None) -> DataFrame:
    """``sums`` of the reporting day ``before``, moved on to ``as_of``.

    ``late`` has product days of orders that came after ``before`` was reported, but are of that day or
    earlier; ``days`` may hold them too from the next move on. Products whose last order leaves stay, with sums of 0.
    """
    if as_of < before:
        raise ValueError("reporting days only move forward")
    day, new = F.col("order_date"), F.col("order_date") > F.lit(before)
    moved = days.filter(moving_days(before, as_of))
    weights = {s: F.when(new, _inside(day, as_of, d).cast("int")).otherwise(
        F.lit(0) if d is None else -(_inside(day, before, d) & ~_inside(day, as_of, d)).cast("int")) for s, d in HORIZONS}
    parts = [sums, moved.groupBy("product_id").agg(*_sums(weights))]
    if late is not None:
        parts.append(late.groupBy("product_id").agg(*_sums({s: _inside(day, as_of, d).cast("int") for s, d in HORIZONS})))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    names = [c for c in sums.columns if c != "product_id"]
    return every.groupBy("product_id").agg(*(F.sum(c).cast(sums.schema[c].dataType).alias(c) for c in names))


def performance(sums: DataFrame, stg_products: DataFrame) -> DataFrame:
    """``agg_product_performance`` out of the sums: no measure is known of a product whose orders all lack it."""
    total = F.col("rows_all_time")
    columns = []
    for suffix, _ in HORIZONS:
        outside = total > F.col(f"rows_{suffix}")
        columns += [
            F.when(outside | (F.col(f"units_known_{suffix}") > 0), F.col(f"units_{suffix}")).alias(f"units_{suffix}"),
            F.when(outside | (F.col(f"net_known_{suffix}") > 0), F.col(f"net_{suffix}").cast("decimal(34,10)")).alias(f"net_{suffix}"),
            F.when(outside | (F.col(f"net_known_{suffix}") > 0), F.col(f"costed_{suffix}")).alias(f"costed_{suffix}"),
            outside.cast("int").alias(f"outside_{suffix}"),
        ]
    names = stg_products.select("product_id", "product_name", F.col("cost_price").alias("product_cost_price"))
    return performance_measures(sums.select("product_id", *columns).join(names, "product_id", "left"))
