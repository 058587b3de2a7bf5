"""Relations between models over the sample tables."""

import os

import pytest
from pyspark.sql import functions as F

from basketry.functions.money import as_decimal
from basketry.plans import reports
from basketry.plans.registry import AS_OF, QUERIES, Tables
from tests.test_registry import DATA

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no sample tables")


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, DATA)


def units(df, column):
    return df.agg(F.sum(as_decimal(F.col(column)))).first()[0]


def test_daily_revenue_adds_up_to_the_fact(tables):
    daily, fact = tables.daily_revenue, tables.order_fact
    # A stored total is a double; the sum of totals keeps its digits up to that.
    assert abs(units(daily, "total_net_revenue") - units(fact, "net_revenue")) < 1e-6
    # A stored total is a double; the sum of totals keeps its digits up to that.
    assert abs(units(daily, "total_gross_revenue") - units(fact, "gross_revenue")) < 1e-6
    assert daily.agg(F.sum("order_count")).first()[0] == fact.count()


def test_dimensions_do_not_multiply_orders(tables):
    assert tables.full_fact.count() == tables.orders.count()


def test_shorter_horizons_hold_no_more_units(tables):
    broken = "units_last_30d > units_last_90d OR units_last_90d > units_all_time"
    assert tables.product_performance.filter(broken).isEmpty()


def test_retention_is_a_percentage(tables):
    retention = reports.cohort_retention(tables.user_dimension, tables.order_fact)
    assert retention.filter(" OR ".join(f"month{m}_pct NOT BETWEEN 0 AND 100" for m in range(4))).isEmpty()
    assert retention.agg(F.sum("total_users")).first()[0] == tables.users.count()


def test_approximate_retention_is_close(tables):
    exact = {r["cohort_month"]: r for r in reports.cohort_retention(tables.user_dimension, tables.order_fact).collect()}
    for row in reports.cohort_retention(tables.user_dimension, tables.order_fact, "approx", rsd=0.01).collect():
        assert abs(row["total_users"] - exact[row["cohort_month"]]["total_users"]) <= 1


def test_a_user_drops_off_at_one_step_at_most_when_steps_are_complete(tables, spark):
    funnel = QUERIES["fct_user_funnel"](spark, DATA)
    ordered = funnel.filter("first_purchase_time IS NOT NULL AND first_checkout_time IS NOT NULL AND first_cart_time IS NOT NULL")
    assert ordered.filter("dropped_after_view + dropped_after_cart + dropped_after_checkout > 0").isEmpty()


def test_no_python_and_no_personal_columns_in_plans(spark):
    for name in ("fct_orders", "fct_user_funnel", "agg_product_performance", "cohort_retention", "stg_events"):
        frame = QUERIES[name](spark, DATA)
        plan = frame._jdf.queryExecution().toString()
        assert "Python" not in plan and "ArrowEval" not in plan
        assert not {"email", "name"} & set(frame.columns)
