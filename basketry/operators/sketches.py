"""Distinct users as mergeable sketches: retention without counting users again.

A HyperLogLog sketch per signup cohort and order month is some kilobytes, whatever the number of users. Stored sketches
of different loads, months or regions merge into the sketch of the whole, in any order and also when a load is merged
twice, so distinct counts are kept up to date without reading old orders. Estimates always go through
a merge, so merged and directly built sketches of the same users give the same number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.dates import month_number, month_start
from basketry.functions.money import percent

# Fixed value: 2**14 registers, a standard error of 0.8 %.
LG_K = 14
STANDARD_ERROR = 1.04 / 2 ** (LG_K / 2)
SKETCH_KEYS = ("cohort_month", "order_month")


def activity_sketches(fct_orders: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """cohort_month, order_month, users: a sketch of who ordered, out of facts that carry the signup date.

    One aggregation and no join; a task sends one sketch per group, however many orders a user or month has. Orders of
    unknown users, and without a day, belong to no cohort or month and are left out.
    """
    known = fct_orders.filter(F.col("user_id").isNotNull() & F.col("user_signup_date").isNotNull() & F.col("order_date").isNotNull())
    return known.groupBy(
        month_start(F.col("user_signup_date")).alias("cohort_month"), month_start(F.col("order_date")).alias("order_month"),
    ).agg(F.hll_sketch_agg("user_id", lg_k).alias("users"))


def merge(*sketches: DataFrame, by: tuple[str | Column, ...] = SKETCH_KEYS) -> DataFrame:
    """One sketch per group of ``by``: of several loads, or of coarser groups of one."""
    every = sketches[0]
    for more in sketches[1:]:
        every = every.unionByName(more)
    return every.groupBy(*by).agg(F.hll_union_agg("users").alias("users"))


def estimate(sketches: DataFrame, by: tuple[str | Column, ...] = SKETCH_KEYS) -> DataFrame:
    """The groups of ``by`` with ``users``, the estimated number of different users."""
    return merge(sketches, by=by).withColumn("users", F.hll_sketch_estimate("users"))


def cohort_retention(dim_users: DataFrame, sketches: DataFrame, months: tuple[int, ...] = (0, 1, 2, 3)) -> DataFrame:
    """Retention as ``reports.cohort_retention`` gives it, with sketched numerators; cohort sizes are counted."""
    offset = month_number(F.col("order_month")) - month_number(F.col("cohort_month"))
    active = estimate(sketches.filter(offset.isin(list(months)))).groupBy("cohort_month").agg(
        *(F.max(F.when(offset == m, F.col("users"))).alias(f"users{m}") for m in months))
    sizes = dim_users.groupBy("cohort_month").agg(F.count("user_id").alias("total_users"))
    both = sizes.join(active, sizes["cohort_month"].eqNullSafe(active["cohort_month"]), "left").drop(active["cohort_month"])
    shares = (percent(F.coalesce(F.col(f"users{m}"), F.lit(0)), F.col("total_users")).alias(f"month{m}_pct") for m in months)
    return both.select("cohort_month", "total_users", *shares).orderBy("cohort_month")
