"""Previews, ordered top n, and ranks within groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)


def top_n(df: DataFrame, order: Sequence[Column], n: int = 10) -> DataFrame:
    """The first ``n`` rows under ``order``; each task keeps only its own first ``n``."""
    return df.orderBy(*order).limit(n)


def top_ranked(
    df: DataFrame, within: Sequence[str], by: str, n: int, rank_column: str = "rank"
) -> DataFrame:
    """Rows ranked ``n`` or better in their group, highest ``by`` first.

    Ties share a rank and leave a gap, so a group can return more than ``n``
    rows. The rank limit is applied per task before the shuffle as well.
    """
    window = Window.partitionBy(*within).orderBy(F.col(by).desc_nulls_last())
    return df.withColumn(rank_column, F.rank().over(window)).filter(F.col(rank_column) <= n)


def latest_orders(fct_orders: DataFrame, n: int = 10) -> DataFrame:
    return top_n(fct_orders, [F.col("created_at").desc_nulls_last(), F.col("order_id")], n)


def newest_users(dim_users: DataFrame, n: int = 10) -> DataFrame:
    return top_n(dim_users, [F.col("signup_date").desc_nulls_last(), F.col("user_id")], n)


def best_margins(dim_products: DataFrame, n: int = 10) -> DataFrame:
    return top_n(dim_products, [F.col("margin_ratio").desc_nulls_last(), F.col("product_id")], n)


def latest_daily_revenue(agg_daily_revenue: DataFrame, n: int = 10) -> DataFrame:
    order = [
        F.col("order_date").desc_nulls_last(),
        F.col("total_gross_revenue").desc_nulls_last(),
        F.col("region").asc_nulls_last(),
        F.col("user_plan_type").asc_nulls_last(),
    ]
    return top_n(agg_daily_revenue, order, n)


def funnel_by_latest_view(fct_user_funnel: DataFrame) -> DataFrame:
    """The whole funnel, latest first view on top; the user id splits equal and missing times."""
    return fct_user_funnel.orderBy(F.col("first_view_time").desc_nulls_last(), F.col("user_id"))


def event_timeline(stg_events: DataFrame) -> DataFrame:
    """Who did what, in time order; the event id splits equal times over tasks."""
    ordered = stg_events.orderBy(F.col("created_at").asc_nulls_first(), F.col("event_id"))
    return ordered.select("user_id", "event_type", "created_at")
