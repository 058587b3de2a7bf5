import datetime as dt

import pytest

from basketry.operators import dimensions, facts, ranking, staging
from basketry.operators.quality import assert_schema
from basketry.plans import panels, reports
from basketry.operators.aggregates import agg_daily_revenue, agg_product_performance
from basketry.schemas import REPORTS
from tests.conftest import AS_OF, by_key, event, final_plan, order, product, rows, user


def fact_of(make, orders):
    return facts.fct_orders(staging.stg_orders(make.orders(orders)))


def users_of(make, users):
    return dimensions.dim_users(staging.stg_users(make.users(users)), AS_OF)


def test_growth_compares_with_the_previous_month_present(make):
    fact = fact_of(make, [
        order("a", day="2024-01-10", unit_price=100.0), order("b", day="2024-01-20", unit_price=50.0),
        order("c", day="2024-03-05", unit_price=200.0), order("free", day="2024-04-05", discount_amount=10.0),
        order("after free", day="2024-05-05", unit_price=40.0),
        order("too old", day="2023-06-29"), order("on edge", day="2023-06-30", unit_price=1.0),
    ])
    growth = reports.mom_revenue_growth(fact, AS_OF)
    assert_schema(growth, REPORTS["mom_revenue_growth"])
    assert [tuple(r) for r in growth.collect()] == [
        ("2023-06", 1.0, None, None),
        ("2024-01", 150.0, 1.0, 14900.0),
        ("2024-03", 200.0, 150.0, 33.33),
        ("2024-04", 0.0, 200.0, -100.0),
        ("2024-05", 40.0, 0.0, None),
    ]


def test_growth_over_whole_months(make):
    fact = fact_of(make, [order("a", day="2023-06-30"), order("b", day="2023-07-01"), order("c", day="2024-06-01")])
    growth = reports.mom_revenue_growth(fact, AS_OF, whole_months=True)
    assert [r["month"] for r in growth.collect()] == ["2023-07", "2024-06"]


RETENTION_USERS = [user("u1", signup="2024-01-31"), user("u2", signup="2024-01-05"), user("u3", signup="2024-01-20"), user("u4", signup="2024-02-01")]
RETENTION_ORDERS = [
    order("1", "u1", day="2024-02-01"), order("2", "u1", day="2024-02-02"), order("3", "u1", day="2024-04-30"),
    order("4", "u2", day="2024-01-04"), order("5", "u2", day="2024-05-01"), order("6", "u2", day="2024-03-01"),
    order("7", "stranger"), order("8", None), order("9", "u4", day="2024-01-31"),
]


@pytest.mark.parametrize("method", ["two_level", "distinct", "approx"])
def test_cohort_retention(make, method):
    users = users_of(make, RETENTION_USERS)
    retention = reports.cohort_retention(users, fact_of(make, RETENTION_ORDERS), method)
    assert_schema(retention, REPORTS["cohort_retention"])
    third = 100.0 / 3
    assert [tuple(r) for r in retention.collect()] == [
        (dt.date(2024, 1, 1), 3, third, third, third, third),
        (dt.date(2024, 2, 1), 1, 0.0, 0.0, 0.0, 0.0),
    ]


def test_retention_counts_a_repeated_user_once(make):
    users = users_of(make, [*RETENTION_USERS, user("u1", signup="2024-01-02")])
    fact = fact_of(make, RETENTION_ORDERS)
    assert rows(reports.cohort_retention(users, fact)) == rows(reports.cohort_retention(users, fact, "distinct"))


def test_retention_rejects_unknown_methods(make):
    with pytest.raises(ValueError):
        reports.cohort_retention(users_of(make, RETENTION_USERS), fact_of(make, RETENTION_ORDERS), "guess")


TIES = [
    *(order(f"top{i}", product_id=f"t{i}", unit_price=90.0) for i in range(2)),
    *(order(f"mid{i}", product_id=f"m{i}", unit_price=80.0 - i) for i in range(2)),
    *(order(f"tie{i}", product_id=f"z{i}", unit_price=0.1, quantity=3) for i in range(2)),
    order("tie2a", product_id="z2", unit_price=0.1), order("tie2b", product_id="z2", unit_price=0.2),
    order("worse", product_id="w", unit_price=0.05),
    order("old", product_id="old", unit_price=999.0, day="2024-03-31"),
    order("edge", product_id="edge", unit_price=95.0, day="2024-04-01", region="NA"),
]


def test_top_products_keep_ties(make):
    names = staging.stg_products(make.products([product(p) for p in ("t0", "t1", "m0")]))
    orders = staging.stg_orders(make.orders(TIES))
    direct = reports.top_products_by_region(facts.fct_orders(orders, names), AS_OF)
    assert_schema(direct, REPORTS["top_products_by_region"])
    assert [(r["region"], r["product_id"], r["product_rank"]) for r in direct.collect()] == [
        ("EU", "t0", 1), ("EU", "t1", 1), ("EU", "m0", 3), ("EU", "m1", 4),
        ("EU", "z0", 5), ("EU", "z1", 5), ("EU", "z2", 5), ("NA", "edge", 1),
    ]
    late = reports.top_products_by_region(facts.fct_orders(orders), AS_OF, stg_products=names)
    assert rows(late) == rows(direct)


def test_rank_limit_runs_before_the_shuffle(make, spark, tmp_path):
    fact_of(make, TIES).write.parquet(str(tmp_path / "fct"))
    names = staging.stg_products(make.products([product("t0")]))
    plan = final_plan(reports.top_products_by_region(spark.read.parquet(str(tmp_path / "fct")), AS_OF, stg_products=names))
    assert plan.count("WindowGroupLimit") >= 2
    assert "GreaterThanOrEqual(order_date,2024-04-01)" in plan


def test_at_risk_edges(make):
    users = users_of(make, [user("enough"), user("few"), user("active", "enterprise"), user("idle", "enterprise"), user("free", "free")])
    day = lambda n: (AS_OF - dt.timedelta(days=n)).isoformat()
    orders = []
    for who, last, count in (("enough", 61, 3), ("few", 200, 2), ("active", 60, 4), ("idle", 61, 4), ("free", 100, 5)):
        orders += [order(f"{who}{i}", who, day=day(last + 10 * i), unit_price=1.1) for i in range(count)]
    risk = reports.at_risk_customers(users, fact_of(make, orders), AS_OF)
    assert_schema(risk, REPORTS["at_risk_customers"])
    last = AS_OF - dt.timedelta(days=61)
    assert rows(risk) == [("enough", "pro", 3, last), ("idle", "enterprise", 4, last)]
    revenue = reports.at_risk_customers(users, fact_of(make, orders), AS_OF, lifetime_revenue=True)
    assert rows(revenue, "user_id", "lifetime_revenue") == [("enough", 3.3), ("idle", 4.4)]
    assert rows(panels.at_risk_by_plan(risk)) == [("enterprise", 1), ("pro", 1)]


DROPOFF_EVENTS = [
    event("1", "u1", "productview", device_type="mobile"), event("2", "u1", "search", device_type="desktop"),
    event("3", "u2", "productview", device_type="mobile"), event("4", "u2", "addtocart", device_type="mobile"),
    event("5", "u3", "search", device_type=None), event("6", None, "productview", device_type="mobile"),
    event("7", "u4", "addtocart", device_type="mobile"), event("8", "u4", "checkoutstart", device_type="mobile"),
]


def test_dropoff_counts_users_under_each_device(make):
    events = staging.stg_events(make.events(DROPOFF_EVENTS))
    rates = reports.funnel_dropoff_from_events(events)
    assert_schema(rates, REPORTS["funnel_dropoff"])
    third = 100.0 / 3
    expected = [
        (None, 1, 0.0, 0.0, 0.0), ("desktop", 1, 100.0, 0.0, 0.0), ("mobile", 3, third, third, third),
    ]
    assert [tuple(r) for r in rates.collect()] == expected
    funnel = facts.fct_user_funnel(events)
    assert rows(reports.funnel_dropoff(funnel, events)) == rows(rates)
    own = by_key(reports.funnel_dropoff(funnel, device_source="funnel"), "device_type")
    assert (own["mobile"]["total_users"], own[None]["total_users"]) == (3, 2)
    with pytest.raises(ValueError):
        reports.funnel_dropoff(funnel)


def test_dropoff_deduplicates_events_once(make, spark, tmp_path):
    make.events(DROPOFF_EVENTS).write.parquet(str(tmp_path / "e"))
    events = staging.stg_events(spark.read.parquet(str(tmp_path / "e")), columns=staging.FUNNEL_EVENT_COLUMNS)
    plan = final_plan(reports.funnel_dropoff_from_events(events))
    assert plan.count("ReadSchema") == 1 and "Join" not in plan


def test_panels(make):
    orders = [
        order("a", day="2024-06-01", unit_price=30.0), order("b", day="2024-06-30", unit_price=5.0, region="NA"),
        order("c", day="2024-05-30", unit_price=20.0), order("d", day="2024-05-31", unit_price=7.0),
        order("e", day="2024-04-01", unit_price=1.0), order("f", day="2024-07-01", unit_price=100.0),
        order("g", day="2024-04-30", unit_price=3.0, product_id="p2"),
    ]
    staged = staging.stg_orders(make.orders(orders))
    fact = facts.fct_orders(staged, stg_users=staging.stg_users(make.users([user("u1")])))
    daily = agg_daily_revenue(fact)
    assert tuple(panels.mtd_revenue(daily, AS_OF).first()) == (35.0, 20.0, 15.0, 75.0)
    assert rows(panels.mtd_revenue(daily.limit(0), AS_OF)) == [(None, None, None, None)]
    trend = panels.daily_revenue_trend(daily, AS_OF, 31).collect()
    assert [(r["order_date"].isoformat(), r["order_count"], r["total_net_revenue"]) for r in trend] == [
        ("2024-05-30", 1, 20.0), ("2024-05-31", 1, 7.0), ("2024-06-01", 1, 30.0), ("2024-06-30", 1, 5.0),
    ]
    regions = [tuple(r) for r in panels.revenue_by_region(fact).collect()]
    assert regions == [("EU", 6, 161.0), ("NA", 1, 5.0)]
    chosen = panels.dashboard_filter(fact, "2024-05-01", "2024-06-30", ["EU"])
    assert rows(chosen, "order_id") == [("a",), ("c",), ("d",)]
    performance = agg_product_performance(facts.fct_orders(staged), AS_OF, staging.stg_products(make.products([product("p1"), product("p2")])))
    assert [tuple(r) for r in panels.top_products(performance, 1).collect()] == [("p1", "Thing p1", 163.0)]


def test_heatmap_is_long(make):
    retention = reports.cohort_retention(users_of(make, RETENTION_USERS), fact_of(make, RETENTION_ORDERS))
    long = panels.cohort_heatmap(retention)
    assert long.count() == 8
    assert {r["months_after_signup"] for r in long.collect()} == {0, 1, 2, 3}


def test_ordered_views(make):
    fact = fact_of(make, [order(f"o{i:02}", day=f"2024-06-{i + 1:02}") for i in range(15)])
    assert [r["order_id"] for r in ranking.latest_orders(fact).collect()] == [f"o{i:02}" for i in range(14, 4, -1)]
    assert "TakeOrderedAndProject" in final_plan(ranking.latest_orders(fact))
    assert ranking.preview(fact, 3).count() == 3
    users = users_of(make, [user("b", signup="2024-01-01"), user("a", signup="2024-01-01"), user("c", signup="2024-02-01")])
    assert [r["user_id"] for r in ranking.newest_users(users, 2).collect()] == ["c", "a"]
    products = dimensions.dim_products(staging.stg_products(make.products([product("x", 10.0, 9.0), product("y", 10.0, 1.0), product("z", 0.0, 1.0)])))
    assert [r["product_id"] for r in ranking.best_margins(products, 2).collect()] == ["y", "x"]
    events = staging.stg_events(make.events(DROPOFF_EVENTS))
    assert ranking.event_timeline(events).columns == ["user_id", "event_type", "created_at"]
    views = [r["first_view_time"] for r in ranking.funnel_by_latest_view(facts.fct_user_funnel(events)).collect()]
    assert views[-1] is None and views[0] is not None
