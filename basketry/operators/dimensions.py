"""User and product dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.dates import as_of_date, month_start
from basketry.functions.labels import PLAN_TIERS, label, margin_class


def dim_users(stg_users: DataFrame, as_of: dt.date | str | Column | None = None) -> DataFrame:
    signup = F.col("signup_date")
    return stg_users.select(
        "user_id",
        "country",
        "plan_type",
        "signup_date",
        "is_active",
        F.datediff(as_of_date(as_of), signup).alias("customer_age_days"),
        month_start(signup).alias("cohort_month"),
        label(F.col("plan_type"), PLAN_TIERS).alias("plan_tier_segment"),
    )


def dim_products(stg_products: DataFrame) -> DataFrame:
    """A zero base price gives a null ratio and the lowest class."""
    base, cost = F.col("base_price"), F.col("cost_price")
    ratio = F.try_divide(base - cost, base)
    return stg_products.select(
        "product_id",
        "product_name",
        "category",
        "subcategory",
        ratio.alias("margin_ratio"),
        margin_class(ratio).alias("margin_class"),
    )
