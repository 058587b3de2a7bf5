import pytest

from basketry.operators import staging
from basketry.operators.quality import assert_no_pii, assert_schema
from basketry.schemas import STAGING
from tests.conftest import event, final_plan, order, product, rows, ts, user


def test_orders_are_keyed_and_upper_cased(make):
    raw = make.orders([order("o1", status="dElivered"), order(None), order("o2", status=None)])
    staged = staging.stg_orders(raw)
    assert_schema(staged, STAGING["stg_orders"])
    assert rows(staged, "order_id", "status") == [("o1", "DELIVERED"), ("o2", None)]


def test_users_lose_personal_columns(make):
    raw = make.users([user("u1", "Pro", country="fr"), user(None), user("u2", is_active="no"), user("u3", is_active=None)])
    staged = staging.stg_users(raw)
    assert_schema(assert_no_pii(staged), STAGING["stg_users"])
    assert rows(staged, "user_id", "plan_type", "country", "is_active") == [
        ("u1", "pro", "FR", True), ("u2", "pro", "DE", False), ("u3", "pro", "DE", False),
    ]


def test_users_can_carry_digests(make):
    staged = staging.stg_users(make.users([user("u1")]), pii="hash")
    assert_no_pii(staged)
    digest = staged.first()["email_sha256"]
    assert len(digest) == 64 and "@" not in digest
    with pytest.raises(ValueError):
        staging.stg_users(make.users([user("u1")]), pii="keep")


def test_products_flag_is_a_number(make):
    raw = make.products([product("p1"), product("p2", is_active="False"), product("p3", is_active=None), product(None)])
    staged = staging.stg_products(raw)
    assert_schema(staged, STAGING["stg_products"])
    assert rows(staged, "product_id", "product_name", "category", "is_active") == [
        ("p1", "Thing p1", "GARDEN", 1), ("p2", "Thing p2", "GARDEN", 0), ("p3", "Thing p3", "GARDEN", 0),
    ]


COPIES = [
    event("e1", at="2024-06-01 10:00:00", page="/old"),
    event("e1", at="2024-06-01 10:05:00", page="/new"),
    event("e1", at="not a time", page="/bad"),
    event("e2", at="soon"),
    event(None),
    event("e3", event_type="AddToCart"),
]


def test_events_keep_the_latest_copy(make):
    staged = staging.stg_events(make.events(COPIES))
    assert_schema(staged, STAGING["stg_events"])
    assert rows(staged, "event_id", "page", "created_at", "event_type") == [
        ("e1", "/new", ts("2024-06-01 10:05:00"), "productview"),
        ("e2", "/p", None, "productview"),
        ("e3", "/p", ts("2024-06-01 10:00:00"), "addtocart"),
    ]


def test_events_can_keep_the_earliest_copy(make):
    staged = staging.stg_events(make.events(COPIES), keep="earliest")
    assert ("e1", "/old") in rows(staged, "event_id", "page")
    with pytest.raises(ValueError):
        staging.stg_events(make.events(COPIES), keep="any")


def test_deduplication_is_idempotent(make, spark):
    once = staging.stg_events(make.events(COPIES))
    again = staging.stg_events(once.withColumn("created_at", once.created_at.cast("string")))
    assert rows(once) == rows(again)


def test_equal_times_give_the_same_copy_for_any_columns(make):
    copies = [
        event("e1", user_id="u2", device_type="mobile", page="/a"),
        event("e1", user_id="u1", device_type="tablet", page="/b"),
        event("e1", user_id="u1", device_type="mobile", page="/c", session_id="s2"),
        event("e1", user_id="u1", device_type="mobile", page="/d", session_id="s1"),
    ]
    full = staging.stg_events(make.events(copies))
    narrow = staging.stg_events(make.events(copies), columns=staging.FUNNEL_EVENT_COLUMNS)
    assert rows(full, *staging.FUNNEL_EVENT_COLUMNS) == rows(narrow)
    assert full.first()["page"] == "/d"


def test_copies_are_dropped_before_the_shuffle(spark, tmp_path, make):
    make.events(COPIES).write.parquet(str(tmp_path / "events"))
    raw = spark.read.parquet(str(tmp_path / "events"))
    plan = final_plan(staging.stg_events(raw, columns=staging.FUNNEL_EVENT_COLUMNS))
    assert plan.count("WindowGroupLimit") >= 2
    assert "Python" not in plan
    scan = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert "referrer" not in scan and "page" not in scan
