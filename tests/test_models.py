import datetime as dt

import pytest

from basketry.functions.labels import DOMAIN_STATUS_LABELS
from basketry.operators import aggregates, dimensions, facts, staging
from basketry.operators.quality import assert_schema
from basketry.schemas import ANALYTICS, UNDERSCORED_FUNNEL_STEPS
from tests.conftest import AS_OF, by_key, event, final_plan, order, product, rows, ts, user


@pytest.fixture()
def build(make):
    def fact(orders, products=(), users=(), **options):
        return facts.fct_orders(
            staging.stg_orders(make.orders(orders)), staging.stg_products(make.products(list(products))),
            staging.stg_users(make.users(list(users))), **options,
        )

    return fact


def test_fact_computes_revenue_and_margin(build):
    fact = build(
        [
            order("o1", quantity=3, unit_price=20.0, discount_amount=10.0, day="2024-02-29"),
            order("zero", quantity=1, unit_price=10.0, discount_amount=10.0),
            order("no discount", discount_amount=None),
            order("orphan", user_id="nobody", product_id="nothing"),
        ],
        [product("p1", cost=4.0)], [user("u1")],
    )
    assert_schema(fact, ANALYTICS["fct_orders"])
    got = by_key(fact, "order_id")
    first = got["o1"]
    assert (first["gross_revenue"], first["net_revenue"], first["profit_margin"]) == (60.0, 50.0, 76.0)
    assert (first["order_date"], first["order_year"], first["order_month"], first["order_day"]) == (
        dt.date(2024, 2, 29), 2024, 2, 29,
    )
    assert (first["order_day_name"], first["order_quarter"]) == ("Thursday", 1)
    assert (first["product_name"], first["user_plan_type"], first["user_is_active"]) == ("Thing p1", "pro", True)
    assert got["zero"]["profit_margin"] == 0.0
    assert (got["no discount"]["net_revenue"], got["no discount"]["profit_margin"]) == (None, None)
    orphan = got["orphan"]
    assert (orphan["net_revenue"], orphan["profit_margin"], orphan["product_name"], orphan["user_country"]) == (
        10.0, None, None, None,
    )


def test_status_categories(build):
    names = ["pending", "confirmed", "shipped", "delivered", "cancelled", "refunded", "processing", "returned", None]
    orders = [order(str(i), status=s) for i, s in enumerate(names)]
    got = by_key(build(orders), "order_id")
    assert [got[str(i)]["status_category"] for i in range(9)] == [
        "Unknown", "Unknown", "In Transit", "Completed", "Cancelled", "Unknown", "Pending", "Returned", "Unknown",
    ]
    full = by_key(build(orders, status_labels=DOMAIN_STATUS_LABELS), "order_id")
    assert "Unknown" not in [full[str(i)]["status_category"] for i in range(6)]


def test_statuses_can_be_left_out(build):
    orders = [order("a"), order("b", status="Cancelled"), order("c", status=None)]
    assert rows(build(orders, exclude_status=["cancelled"]), "order_id") == [("a",), ("c",)]


def test_cohort_index_column(build):
    orders = [order("o1", day="2024-02-01"), order("o2", day="2024-01-31"), order("o3", day="2023-12-31")]
    got = by_key(build(orders, users=[user("u1", signup="2024-01-31")], cohort_month_index=True), "order_id")
    assert [got[o]["cohort_month_index"] for o in ("o1", "o2", "o3")] == [1, 0, -1]


def test_narrow_fact_has_no_joins(make):
    fact = facts.fct_orders(staging.stg_orders(make.orders([order("o1")])))
    assert "Join" not in final_plan(fact)
    assert not set(fact.columns) & {"product_name", "profit_margin", "user_plan_type"}


def test_duplicate_dimension_keys_multiply_orders(build):
    assert build([order("o1")], [product("p1"), product("p1")]).count() == 2


def test_user_dimension(make):
    users = [user("u1", "enterprise"), user("u2", "PRO"), user("u3", "starter"), user("u4", "free"), user("u5", "trial"), user("u6", None)]
    dim = dimensions.dim_users(staging.stg_users(make.users(users)), AS_OF)
    assert_schema(dim, ANALYTICS["dim_users"])
    assert rows(dim, "user_id", "plan_tier_segment") == [
        ("u1", "Enterprise"), ("u2", "Premium"), ("u3", "Basic"), ("u4", "Free"), ("u5", "Unknown"), ("u6", "Unknown"),
    ]
    first = dim.first()
    assert (first["customer_age_days"], first["cohort_month"]) == (172, dt.date(2024, 1, 1))


def test_product_dimension(make):
    products = [product("half", 10.0, 5.0), product("quarter", 100.0, 75.0), product("low", 100.0, 76.0), product("free", 0.0, 1.0)]
    dim = dimensions.dim_products(staging.stg_products(make.products(products)))
    assert_schema(dim, ANALYTICS["dim_products"])
    assert rows(dim, "product_id", "margin_ratio", "margin_class") == [
        ("free", None, "Low"), ("half", 0.5, "High"), ("low", 0.24, "Low"), ("quarter", 0.25, "Medium"),
    ]


def test_daily_revenue(build):
    fact = build(
        [
            order("a", unit_price=10.1), order("b", unit_price=20.2), order("c", discount_amount=None),
            order("d", user_id="nobody"), order("e", day="2024-06-02", region="NA"),
        ],
        users=[user("u1")],
    )
    daily = aggregates.agg_daily_revenue(fact)
    assert_schema(daily, ANALYTICS["agg_daily_revenue"])
    june = dt.date(2024, 6, 1)
    assert rows(daily) == [
        (june, "EU", None, 1, 10.0, 10.0, 10.0),
        (june, "EU", "pro", 3, 40.3, 30.3, 15.15),
        (dt.date(2024, 6, 2), "NA", "pro", 1, 10.0, 10.0, 10.0),
    ]


PERFORMANCE_ORDERS = [
    order("in30", quantity=2, day="2024-05-31"),
    order("before30", quantity=3, day="2024-05-30"),
    order("in90", quantity=4, day="2024-04-01"),
    order("before90", quantity=5, day="2024-03-31"),
    order("future", quantity=6, day="2024-07-01"),
    order("no discount", quantity=7, day="2024-06-01", discount_amount=None),
    order("orphan old", product_id="p9", day="2024-01-01"),
    order("orphan new", product_id="p9", day="2024-06-02"),
    order("only new", product_id="p8", day="2024-06-02"),
    order("third", product_id="p7", quantity=3, unit_price=0.333333, day="2024-06-02"),
    order("null product", product_id=None),
]


def test_product_performance(build):
    fact = build(PERFORMANCE_ORDERS, [product("p1"), product("p7", cost=0.1111)])
    performance = aggregates.agg_product_performance(fact, AS_OF)
    assert_schema(performance, ANALYTICS["agg_product_performance"])
    got = by_key(performance, "product_id")
    p1 = got["p1"]
    assert [p1[f"units_{h}"] for h in ("last_30d", "last_90d", "all_time")] == [15, 22, 27]
    assert [p1[f"revenue_{h}"] for h in ("last_30d", "last_90d", "all_time")] == [80.0, 150.0, 200.0]
    assert [p1[f"profit_{h}"] for h in ("last_30d", "last_90d", "all_time")] == [48.0, 90.0, 120.0]
    # No cost: rows outside a horizon still count as 0 in it.
    assert [got["p9"][f"profit_{h}"] for h in ("last_30d", "last_90d", "all_time")] == [0.0, 0.0, None]
    assert [got["p8"][f"profit_{h}"] for h in ("last_30d", "last_90d", "all_time")] == [None, None, None]
    assert got["p8"]["revenue_last_30d"] == 10.0
    # Amounts keep their digits.
    assert got["p7"]["revenue_all_time"] == 0.999999 and round(got["p7"]["profit_all_time"], 4) == 0.6667
    assert None in got


def test_product_performance_joins_after_aggregating(build, make):
    products = [product("p1"), product("p7", cost=0.1111), product("p8", cost=None)]
    direct = aggregates.agg_product_performance(build(PERFORMANCE_ORDERS, products), AS_OF)
    narrow = facts.fct_orders(staging.stg_orders(make.orders(PERFORMANCE_ORDERS)))
    late = aggregates.agg_product_performance(narrow, AS_OF, staging.stg_products(make.products(products)))
    assert rows(direct) == rows(late)


def test_late_join_multiplies_duplicate_products_alike(build, make):
    products = [product("p1"), product("p1"), product("p1", name="Other")]
    direct = aggregates.agg_product_performance(build(PERFORMANCE_ORDERS, products), AS_OF)
    narrow = facts.fct_orders(staging.stg_orders(make.orders(PERFORMANCE_ORDERS)))
    late = aggregates.agg_product_performance(narrow, AS_OF, staging.stg_products(make.products(products)))
    assert rows(direct) == rows(late)


FUNNEL_EVENTS = [
    event("a1", "all", "productview", "2024-06-01 10:00:00.900", device_type="tablet"),
    event("a2", "all", "addtocart", "2024-06-01 10:00:01.100", device_type="mobile"),
    event("a3", "all", "checkoutstart", "2024-06-01 10:05:00", device_type="mobile"),
    event("a4", "all", "purchase", "2024-06-01 09:00:00", device_type="mobile"),
    event("a5", "all", "productview", "2024-06-01 11:00:00", device_type="desktop"),
    event("v1", "viewer", "productview"),
    event("c1", "cart only", "addtocart", device_type=None),
    event("s1", "searcher", "search"),
    event("t1", "no time", "productview", "?", device_type="mobile"),
]


def test_funnel(make):
    funnel = facts.fct_user_funnel(staging.stg_events(make.events(FUNNEL_EVENTS)))
    assert_schema(funnel, ANALYTICS["fct_user_funnel"])
    got = by_key(funnel, "user_id")
    full = got["all"]
    assert full["device_type"] == "desktop"
    assert full["first_view_time"] == ts("2024-06-01 10:00:00.900")
    assert [full[f"seconds_{s}"] for s in ("view_to_cart", "cart_to_checkout", "checkout_to_purchase")] == [1, 299, -3900]
    flags = lambda u: [got[u][f"dropped_after_{s}"] for s in ("view", "cart", "checkout")]
    assert flags("all") == [0, 0, 0]
    assert flags("viewer") == [1, 0, 0]
    assert flags("cart only") == [0, 1, 0]
    assert flags("searcher") == [0, 0, 0]
    assert got["cart only"]["device_type"] is None
    assert got["no time"]["device_type"] == "mobile" and got["no time"]["first_view_time"] is None


def test_funnel_device_of_first_view(make):
    events = staging.stg_events(make.events(FUNNEL_EVENTS))
    got = by_key(facts.fct_user_funnel(events, device="first_view"), "user_id")
    assert got["all"]["device_type"] == "tablet"
    with pytest.raises(ValueError):
        facts.fct_user_funnel(events, device="last")


def test_funnel_takes_other_step_names(make):
    renamed = [
        event("1", "u", "Product_View"), event("2", "u", "add_to_cart", "2024-06-01 10:00:07"),
    ]
    funnel = facts.fct_user_funnel(staging.stg_events(make.events(renamed)), UNDERSCORED_FUNNEL_STEPS)
    assert funnel.first()["seconds_view_to_cart"] == 7


def test_event_pass_of_the_funnel_is_a_hash_aggregation(make):
    plan = final_plan(facts.device_steps(staging.stg_events(make.events(FUNNEL_EVENTS))))
    assert "HashAggregate" in plan and "SortAggregate" not in plan
