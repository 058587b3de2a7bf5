"""The order fact and the per-user conversion funnel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from basketry.functions.dates import month_boundaries, second_boundaries, weekday_name
from basketry.functions.labels import STATUS_LABELS, label
from basketry.functions.money import round_half_away
from basketry.operators.joins import enrich
from basketry.schemas import FUNNEL_STEPS

_PRODUCT_ATTRIBUTES = {
    "product_name": "product_name",
    "category": "product_category",
    "subcategory": "product_subcategory",
    "base_price": "product_base_price",
    "cost_price": "product_cost_price",
}
_USER_ATTRIBUTES = {
    "plan_type": "user_plan_type",
    "country": "user_country",
    "signup_date": "user_signup_date",
    "is_active": "user_is_active",
}


def _renamed(dimension: DataFrame, key: str, names: Mapping[str, str]) -> DataFrame:
    return dimension.select(key, *(F.col(old).alias(new) for old, new in names.items()))


def with_product(orders: DataFrame, stg_products: DataFrame, salts: int = 1) -> DataFrame:
    """Orders with product attributes; those without a matching product stay."""
    products = _renamed(stg_products, "product_id", _PRODUCT_ATTRIBUTES)
    return enrich(orders, products, "product_id", salts, "order_id")


def with_user(orders: DataFrame, stg_users: DataFrame, salts: int = 1) -> DataFrame:
    """Orders with user attributes; those without a matching user stay."""
    return enrich(orders, _renamed(stg_users, "user_id", _USER_ATTRIBUTES), "user_id", salts, "order_id")


def fct_orders(
    stg_orders: DataFrame,
    stg_products: DataFrame | None = None,
    stg_users: DataFrame | None = None,
    status_labels: Mapping[str, str] = STATUS_LABELS,
    exclude_status: Sequence[str] = (),
    cohort_month_index: bool = False,
) -> DataFrame:
    """One row per order with revenue, status label, dimensions and calendar columns.

    A dimension that is left out takes its columns with it (and, for products,
    the margin that needs their cost). Reports that need no attribute, or that
    can attach it after aggregating, start from such a narrow fact and save a
    shuffle of the whole order table per dimension. This assumes what the model
    documents: dimension keys are unique (``quality.duplicate_keys`` checks it).

    ``cohort_month_index`` adds the months between signup and order.
    """
    orders = stg_orders
    if exclude_status:
        dropped = F.col("status").isin([s.upper() for s in exclude_status])
        orders = orders.filter(~F.coalesce(dropped, F.lit(False)))
    if stg_products is not None:
        orders = with_product(orders, stg_products)
    if stg_users is not None:
        orders = with_user(orders, stg_users)

    gross = (F.col("quantity") * F.col("unit_price")).cast("double")
    net = gross - F.col("discount_amount")
    created = F.col("created_at")
    product, user = [], []
    margin = []
    if stg_products is not None:
        cost = F.col("quantity") * F.col("product_cost_price")
        share = F.try_divide(net - cost, net) * 100
        margin = [F.when(net == 0, F.lit(0.0)).otherwise(round_half_away(share)).alias("profit_margin")]
        product = list(_PRODUCT_ATTRIBUTES.values())
    if stg_users is not None:
        user = list(_USER_ATTRIBUTES.values())
    index = []
    if cohort_month_index:
        months = month_boundaries(F.col("user_signup_date"), F.to_date(created))
        index = [months.alias("cohort_month_index")]
    return orders.select(
        "order_id",
        "user_id",
        "product_id",
        "quantity",
        "unit_price",
        "discount_amount",
        gross.alias("gross_revenue"),
        net.alias("net_revenue"),
        *margin,
        F.col("status").alias("status_raw"),
        label(F.col("status"), status_labels).alias("status_category"),
        *product,
        *user,
        "created_at",
        F.to_date(created).alias("order_date"),
        F.year(created).alias("order_year"),
        F.month(created).alias("order_month"),
        F.dayofmonth(created).alias("order_day"),
        weekday_name(created).alias("order_day_name"),
        F.quarter(created).alias("order_quarter"),
        "region",
        *index,
    )


STEP_TIMES = ("first_view_time", "first_cart_time", "first_checkout_time", "first_purchase_time")
_STEP_FLAGS = ("dropped_after_view", "dropped_after_cart", "dropped_after_checkout")
_STEP_SECONDS = ("seconds_view_to_cart", "seconds_cart_to_checkout", "seconds_checkout_to_purchase")


def step_minima(steps: Sequence[str] = FUNNEL_STEPS) -> list:
    """First time of each step, as aggregates over events."""
    return [
        F.min(F.when(F.col("event_type") == step, F.col("created_at"))).alias(name)
        for step, name in zip(steps, STEP_TIMES)
    ]


def device_steps(stg_events: DataFrame, steps: Sequence[str] = FUNNEL_STEPS, within: Sequence[str] = ()) -> DataFrame:
    """First step times per user and device (and columns ``within``), with the number of views.

    Strings are grouping keys only, so the pass over the events is a hash
    aggregation with map-side combine; everything per user works on its output.
    """
    views = F.count(F.when(F.col("event_type") == steps[0], F.lit(1))).alias("views")
    return stg_events.groupBy(*within, "user_id", "device_type").agg(*step_minima(steps), views)


def with_step_outcomes(first_steps: DataFrame) -> DataFrame:
    """Add seconds between the steps and drop-off flags to first step times."""
    pairs = list(zip(STEP_TIMES, STEP_TIMES[1:]))
    seconds = {
        name: second_boundaries(F.col(a), F.col(b)) for name, (a, b) in zip(_STEP_SECONDS, pairs)
    }
    flags = {
        name: F.when(F.col(a).isNotNull() & F.col(b).isNull(), 1).otherwise(0)
        for name, (a, b) in zip(_STEP_FLAGS, pairs)
    }
    return first_steps.withColumns({**seconds, **flags})


def funnel_from_device_steps(steps_by_device: DataFrame, device: str = "alphabetical") -> DataFrame:
    """Roll ``device_steps`` up to the funnel, one row per user."""
    viewed = F.col("views") > 0
    if device == "alphabetical":
        chosen = F.min(F.when(viewed, F.col("device_type")))
    elif device == "first_view":
        view = F.struct("first_view_time", "device_type")
        chosen = F.min(F.when(viewed & F.col("first_view_time").isNotNull(), view))["device_type"]
    else:
        raise ValueError("device is 'alphabetical' or 'first_view'")
    first = steps_by_device.groupBy("user_id").agg(
        chosen.alias("device_type"), *(F.min(name).alias(name) for name in STEP_TIMES)
    )
    return with_step_outcomes(first).select(
        "user_id", "device_type", *STEP_TIMES, *_STEP_SECONDS, *_STEP_FLAGS
    )


def fct_user_funnel(
    stg_events: DataFrame, steps: Sequence[str] = FUNNEL_STEPS, device: str = "alphabetical"
) -> DataFrame:
    """First occurrence of each step per user, seconds between steps, drop-off flags.

    Steps need not follow each other in time, so seconds can be negative. The
    device is the alphabetically first one among the user's views, or with
    ``device="first_view"`` the one of the earliest view.
    """
    return funnel_from_device_steps(device_steps(stg_events, steps), device)


def user_device_outcomes(stg_events: DataFrame, steps: Sequence[str] = FUNNEL_STEPS) -> DataFrame:
    """Drop-off flags of the user on each (user, device) pair, in one pass over the events."""
    per_user = Window.partitionBy("user_id")
    by_device = device_steps(stg_events.filter(F.col("user_id").isNotNull()), steps)
    spread = by_device.select(
        "user_id", "device_type", *(F.min(name).over(per_user).alias(name) for name in STEP_TIMES)
    )
    return with_step_outcomes(spread).select("user_id", "device_type", *_STEP_FLAGS)
