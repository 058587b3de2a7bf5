"""Declared schemas, keys and value domains of every layer."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
DATE, TS, BOOL = T.DateType(), T.TimestampType(), T.BooleanType()

# --- raw ---------------------------------------------------------------------

RAW = {
    "orders": _struct(
        order_id=STRING, user_id=STRING, product_id=STRING, status=STRING, quantity=INT,
        unit_price=DOUBLE, discount_amount=DOUBLE, created_at=TS, region=STRING,
    ),
    "users": _struct(
        user_id=STRING, email=STRING, name=STRING, plan_type=STRING, signup_date=DATE,
        country=STRING, created_at=TS, is_active=STRING,
    ),
    "products": _struct(
        product_id=STRING, name=STRING, category=STRING, subcategory=STRING,
        base_price=DOUBLE, cost_price=DOUBLE, created_at=TS, is_active=STRING,
    ),
    "events": _struct(
        event_id=STRING, user_id=STRING, session_id=STRING, event_type=STRING,
        product_id=STRING, page=STRING, referrer=STRING, device_type=STRING,
        created_at=STRING,
    ),
}

PRIMARY_KEYS = {"orders": "order_id", "users": "user_id", "products": "product_id", "events": "event_id"}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("orders", "user_id", "users", "user_id"),
    ("orders", "product_id", "products", "product_id"),
    ("events", "user_id", "users", "user_id"),
    ("events", "product_id", "products", "product_id"),
]

PII_COLUMNS = ("email", "name")

# The accepted domains, compared in lower case.
DOMAINS = {
    ("orders", "status"): ("pending", "confirmed", "shipped", "delivered", "cancelled", "refunded"),
    ("orders", "region"): ("na", "eu", "apac", "latam"),
    ("users", "plan_type"): ("free", "starter", "pro", "enterprise"),
    ("events", "event_type"): ("productview", "addtocart", "checkoutstart", "purchase", "search"),
    ("events", "device_type"): ("mobile", "tablet", "desktop"),
}

# Event names of the four funnel steps, in order.
FUNNEL_STEPS = ("productview", "addtocart", "checkoutstart", "purchase")
UNDERSCORED_FUNNEL_STEPS = ("product_view", "add_to_cart", "checkout_start", "purchase")

# --- staging -----------------------------------------------------------------

STAGING = {
    "stg_orders": _struct(
        order_id=STRING, user_id=STRING, product_id=STRING, status=STRING, quantity=INT,
        unit_price=DOUBLE, discount_amount=DOUBLE, created_at=TS, region=STRING,
    ),
    "stg_users": _struct(
        user_id=STRING, plan_type=STRING, signup_date=DATE, country=STRING, created_at=TS,
        is_active=BOOL,
    ),
    "stg_products": _struct(
        product_id=STRING, product_name=STRING, category=STRING, subcategory=STRING,
        base_price=DOUBLE, cost_price=DOUBLE, created_at=TS, is_active=INT,
    ),
    "stg_events": _struct(
        event_id=STRING, user_id=STRING, session_id=STRING, event_type=STRING,
        product_id=STRING, page=STRING, referrer=STRING, device_type=STRING, created_at=TS,
    ),
}

# --- analytics ---------------------------------------------------------------

ANALYTICS = {
    "fct_orders": _struct(
        order_id=STRING, user_id=STRING, product_id=STRING, quantity=INT, unit_price=DOUBLE,
        discount_amount=DOUBLE, gross_revenue=DOUBLE, net_revenue=DOUBLE, profit_margin=DOUBLE,
        status_raw=STRING, status_category=STRING, product_name=STRING, product_category=STRING,
        product_subcategory=STRING, product_base_price=DOUBLE, product_cost_price=DOUBLE,
        user_plan_type=STRING, user_country=STRING, user_signup_date=DATE, user_is_active=BOOL,
        created_at=TS, order_date=DATE, order_year=INT, order_month=INT, order_day=INT,
        order_day_name=STRING, order_quarter=INT, region=STRING,
    ),
    "dim_users": _struct(
        user_id=STRING, country=STRING, plan_type=STRING, signup_date=DATE, is_active=BOOL,
        customer_age_days=INT, cohort_month=DATE, plan_tier_segment=STRING,
    ),
    "dim_products": _struct(
        product_id=STRING, product_name=STRING, category=STRING, subcategory=STRING,
        margin_ratio=DOUBLE, margin_class=STRING,
    ),
    "agg_daily_revenue": _struct(
        order_date=DATE, region=STRING, user_plan_type=STRING, order_count=LONG,
        total_gross_revenue=DOUBLE, total_net_revenue=DOUBLE, Avg_net_revenue=DOUBLE,
    ),
    "agg_product_performance": _struct(
        product_id=STRING, product_name=STRING,
        units_last_30d=LONG, revenue_last_30d=DOUBLE, profit_last_30d=DOUBLE,
        units_last_90d=LONG, revenue_last_90d=DOUBLE, profit_last_90d=DOUBLE,
        units_all_time=LONG, revenue_all_time=DOUBLE, profit_all_time=DOUBLE,
    ),
    "fct_user_funnel": _struct(
        user_id=STRING, device_type=STRING, first_view_time=TS, first_cart_time=TS,
        first_checkout_time=TS, first_purchase_time=TS, seconds_view_to_cart=LONG,
        seconds_cart_to_checkout=LONG, seconds_checkout_to_purchase=LONG,
        dropped_after_view=INT, dropped_after_cart=INT, dropped_after_checkout=INT,
    ),
}

REPORTS = {
    "mom_revenue_growth": _struct(
        month=STRING, total_revenue=DOUBLE, previous_month_revenue=DOUBLE,
        mom_growth_percentage=DOUBLE,
    ),
    "cohort_retention": _struct(
        cohort_month=DATE, total_users=LONG, month0_pct=DOUBLE, month1_pct=DOUBLE,
        month2_pct=DOUBLE, month3_pct=DOUBLE,
    ),
    "top_products_by_region": _struct(
        region=STRING, product_id=STRING, product_name=STRING, product_category=STRING,
        total_revenue=DOUBLE, product_rank=INT,
    ),
    "at_risk_customers": _struct(
        user_id=STRING, plan_type=STRING, total_orders=LONG, last_order_date=DATE,
    ),
    "funnel_dropoff": _struct(
        device_type=STRING, total_users=LONG, drop_after_view_pct=DOUBLE,
        drop_after_cart_pct=DOUBLE, drop_after_checkout_pct=DOUBLE,
    ),
}
