import pytest

from basketry.operators import aggregates, facts, staging
from basketry.sources import readers
from basketry.streaming import incremental, jobs
from tests.conftest import event, order, product, rows, ts, user


@pytest.fixture()
def lake(tmp_path):
    return str(tmp_path / "lake")


def drop(make, lake, table, batch):
    """One more file of a raw table arrives."""
    options = {**readers.CSV_OPTIONS, **readers.CSV_TABLE_OPTIONS[table]}
    raw = getattr(make, table)(batch)
    raw.coalesce(1).write.mode("append").options(**options).csv(readers.table_path(lake, table))


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


ORDER_DROPS = [
    [order("a"), order("b", day="2024-06-02"), order("c", day="2024-06-03", user_id="nobody")],
    [order("b", day="2024-06-02", status="shipped", quantity=2), order("d", day="2024-05-20"), order("c", day="2024-06-04")],
]


def test_order_ingest_equals_batch(spark, make, lake, tmp_path):
    products = staging.stg_products(make.products([product("p1")]))
    users = staging.stg_users(make.users([user("u1")]))
    target, daily, checkpoint = (str(tmp_path / n) for n in ("fct", "daily", "job"))
    for batch in ORDER_DROPS:
        drop(make, lake, "orders", batch)
        finish(jobs.ingest_orders(readers.stream_raw(spark, lake, "orders"), products, users, target, checkpoint, daily))
    final = [ORDER_DROPS[0][0], *ORDER_DROPS[1]]
    full = facts.fct_orders(staging.stg_orders(make.orders(final)), products, users)
    stored = spark.read.schema(full.schema).parquet(target)
    assert rows(stored, *full.columns) == rows(full)
    expected = aggregates.agg_daily_revenue(full)
    assert rows(spark.read.parquet(daily), *expected.columns) == rows(expected)


EVENT_DROPS = [
    [event("1", at="2024-06-01 10:00:00"), event("2", "u2", "addtocart", "2024-06-01 10:10:00"), event("9", at="never")],
    [
        event("1", at="2024-06-01 10:00:30", page="/again"), event("3", "u1", "addtocart", "2024-06-01 10:30:00"),
        event("4", "u2", "productview", "2024-05-30 10:00:00", device_type="mobile"),
    ],
]


def test_event_ingest_keeps_the_latest_copy(spark, make, lake, tmp_path):
    target, checkpoint = str(tmp_path / "events"), str(tmp_path / "job")
    for batch in EVENT_DROPS:
        drop(make, lake, "events", batch)
        finish(jobs.ingest_events(readers.stream_raw(spark, lake, "events"), target, checkpoint))
    full = staging.stg_events(make.events(EVENT_DROPS[0] + EVENT_DROPS[1]))
    assert rows(spark.read.parquet(target), *full.columns) == rows(full)


def test_nothing_new_changes_nothing(spark, make, lake, tmp_path):
    target, checkpoint = str(tmp_path / "events"), str(tmp_path / "job")
    drop(make, lake, "events", EVENT_DROPS[0])
    for _ in range(2):
        finish(jobs.ingest_events(readers.stream_raw(spark, lake, "events"), target, checkpoint))
    assert spark.read.parquet(target).count() == 3


def test_first_arrivals(spark, make, lake, tmp_path):
    target, checkpoint = str(tmp_path / "events"), str(tmp_path / "job")
    late = [event("5", at="2024-06-03 10:00:00")], [event("6", at="2024-06-01 09:00:00"), event("7", at="2024-06-03 10:30:00")]
    for batch in (*EVENT_DROPS, *late, [event("1", at="2024-06-02 00:00:01"), event("9", at="2024-06-03 11:00:00")]):
        drop(make, lake, "events", batch)
        finish(jobs.ingest_first_arrivals(readers.stream_raw(spark, lake, "events"), target, checkpoint))
    stored = rows(spark.read.parquet(target), "event_id", "created_at")
    got = dict(stored)
    assert len(stored) == len(got)
    assert set(got) == {"1", "2", "3", "4", "5", "6", "7", "9"}  # 6 arrived late
    assert got["1"] == ts("2024-06-01 10:00:00")
    assert got["9"] is None  # a copy without a time is found again


def test_live_daily_revenue(spark, make, lake, tmp_path):
    users = staging.stg_users(make.users([user("u1")]))
    target, checkpoint = str(tmp_path / "daily"), str(tmp_path / "job")
    drops = [
        [order("a"), order("b", discount_amount=None), order("x", day="2024-07-20")],
        [order("c", unit_price=4.5), order("d", user_id="nobody"), order("e", created_at=None)],
        [order("f", day="2024-05-02"), order("g", created_at=None, unit_price=0.00003)],
    ]
    for batch in drops:
        drop(make, lake, "orders", batch)
        finish(jobs.publish_daily_revenue(readers.stream_raw(spark, lake, "orders"), users, target, checkpoint))
    full = aggregates.agg_daily_revenue(
        facts.fct_orders(staging.stg_orders(make.orders(sum(drops, []))), stg_users=users)
    )
    assert rows(spark.read.parquet(target), *full.columns) == rows(full)


def test_live_funnel(spark, make, lake, tmp_path):
    events, steps, checkpoint = (str(tmp_path / n) for n in ("events", "steps", "job"))
    # The last drop moves a view to the next day, by a later copy.
    drops = [*EVENT_DROPS, [event("4", "u2", "productview", "2024-05-31 00:00:10", device_type="tablet")]]
    for batch in drops:
        drop(make, lake, "events", batch)
        finish(jobs.publish_funnel(readers.stream_raw(spark, lake, "events"), events, steps, checkpoint))
    full = facts.fct_user_funnel(staging.stg_events(make.events(sum(drops, []))))
    assert rows(jobs.stored_funnel(spark.read.parquet(steps))) == rows(full)


def test_funnel_merge(make):
    first, second = (staging.stg_events(make.events(b)) for b in EVENT_DROPS)
    everything = staging.stg_events(make.events(EVENT_DROPS[0] + EVENT_DROPS[1]), keep="earliest")
    merged = jobs.merge_funnel(facts.fct_user_funnel(first), second)
    assert rows(merged) == rows(facts.fct_user_funnel(everything))


def test_order_versions_of_one_batch(spark, make, tmp_path):
    versions = [order("a", status=s) for s in ("delivered", "confirmed", "pending")] + [order("b", status="shipped"), order("b", day="2024-06-02", status="pending")]
    target = str(tmp_path / "fct")
    full = facts.fct_orders(staging.stg_orders(make.orders(versions)))
    incremental.upsert_orders(spark, full, target, str(tmp_path / "run"))
    assert rows(spark.read.schema(full.schema).parquet(target), "order_id", "status_raw") == [("a", "DELIVERED"), ("b", "PENDING")]
