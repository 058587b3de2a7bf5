import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketry.operators import aggregates, facts, staging
from basketry.schemas import RAW, STAGING
from basketry.sources import readers
from basketry.streaming import watermarks
from tests.conftest import event, order, rows, ts, user
from tests.test_streaming import drop, finish, lake  # noqa: F401


@pytest.fixture()
def places(tmp_path):
    return [str(tmp_path / n) for n in ("routed", "target", "route-job", "job")]


def test_rows_behind_the_clock_are_told_apart(spark, make, lake, places):  # noqa: F811
    root, _, checkpoint, _ = places
    drops = [[order("a", day="2024-06-10"), order("u", created_at=None)], [order("b", day="2024-06-08"), order("c", day="2024-06-09"), order("d", day="2024-06-20")],
             [order("e", day="2024-06-10"), order("f", day="2024-06-19")]]
    for batch in drops:
        drop(make, lake, "orders", batch)
        finish(watermarks.route(readers.stream_raw(spark, lake, "orders"), root, checkpoint, "36 HOURS"))
    assert rows(watermarks.late(spark, root, RAW["orders"]), "order_id") == [("b",), ("e",), ("u",)]
    kept = spark.read.parquet(f"{root}/on_time")
    assert rows(kept, "order_id", "arrival") == [("a", 0), ("c", 1), ("d", 1), ("f", 2)]


def test_a_batch_that_is_routed_again_adds_nothing(spark, make, lake, places, monkeypatch):  # noqa: F811
    root, _, checkpoint, _ = places
    publish, failed = watermarks._publish, []

    def dies(spark_, part, path, aside):
        if "clock" in path and not failed:
            failed.append(path)
            raise RuntimeError("lost")
        publish(spark_, part, path, aside)

    monkeypatch.setattr(watermarks, "_publish", dies)
    drop(make, lake, "orders", [order("a"), order("b", created_at=None)])
    run = lambda: watermarks.route(readers.stream_raw(spark, lake, "orders"), root, checkpoint, "1 HOUR")
    with pytest.raises(Exception, match="lost"):
        run().awaitTermination()
    finish(run())
    assert rows(spark.read.parquet(f"{root}/on_time"), "order_id") == [("a",)]
    assert rows(watermarks.late(spark, root, RAW["orders"]), "order_id") == [("b",)]


def test_windows_and_late_rows_sum_to_the_batch(spark, make, lake, places):  # noqa: F811
    root, target, route_job, job = places
    users = staging.stg_users(make.users([user("u1")]))
    drops = [
        [order("a"), order("b", discount_amount=None), order("x", day="2024-06-04")],
        [order("c", unit_price=4.5, day="2024-06-03"), order("d", user_id="nobody", day="2024-06-04"), order("late", unit_price=0.00003)],
        [order("e", created_at=None), order("f", day="2024-06-20"), order("later", day="2024-06-01", region=None)],
    ]
    state = []
    for batch in drops:
        drop(make, lake, "orders", batch)
        finish(watermarks.route(readers.stream_raw(spark, lake, "orders"), root, route_job, "1 DAY"))
        query = watermarks.daily_windows(watermarks.on_time(spark, root, RAW["orders"]), users, target, job, "1 DAY")
        finish(query)
        state.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        assert all(p["stateOperators"][0]["numRowsDroppedByWatermark"] == 0 for p in query.recentProgress if p["stateOperators"])
    behind = watermarks.late(spark, root, RAW["orders"])
    assert rows(behind, "order_id") == [("e",), ("late",), ("later",)]
    full = aggregates.agg_daily_revenue(facts.fct_orders(staging.stg_orders(make.orders(sum(drops, []))), stg_users=users))
    found = watermarks.daily_revenue_with_late(spark.read.parquet(target), behind, users)
    assert rows(found, *full.columns) == rows(full)
    # The days of the first two drops have left the state.
    assert state[-1] == 1


def test_deduplication_with_bounded_state(spark, make, lake, places):  # noqa: F811
    root, target, route_job, job = places
    at = lambda hour, n=0: (dt.datetime(2024, 6, 1) + dt.timedelta(hours=hour, seconds=n)).isoformat(" ")
    drops = [
        [event(f"e{i}", at=at(0, i)) for i in range(50)] + [event("e0", at=at(0, 59), page="/copy"), event("undated", at="?")],
        [event(f"e{i}", at=at(0, i + 1), page="/copy") for i in range(50)] + [event(f"f{i}", at=at(5, i)) for i in range(20)],
        [event(f"f{i}", at=at(5, i + 1), page="/copy") for i in range(20)] + [event("e3", at=at(9), page="/far"), event("undated", at=at(9), page="/dated"),
                                                                            event("behind", at=at(2)), event("e4", at=at(1), page="/behind")],
    ]
    state = []
    for batch in drops:  # every run is a restart from the checkpoint
        drop(make, lake, "events", batch)
        finish(watermarks.route(readers.stream_raw(spark, lake, "events"), root, route_job, "1 HOUR", prepare=watermarks.first_of_batch))
        query = watermarks.deduplicate(watermarks.on_time(spark, root, STAGING["stg_events"]), target, job, "1 hour")
        finish(query)
        state.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert state == [50, 20, 2]
    stored = spark.read.parquet(target)
    # Only the copy that came nine hours later got through.
    assert rows(stored.groupBy("event_id").count().filter("count > 1"), "event_id") == [("e3",), ]
    found = watermarks.first_arrivals(stored, watermarks.late(spark, root, STAGING["stg_events"]))
    got = {r["event_id"]: (r["page"], r["created_at"]) for r in found.collect()}
    assert found.count() == len(got) == 72
    assert got["e3"] == ("/p", ts("2024-06-01 00:00:03")) and got["undated"] == ("/p", None) and got["behind"][1] == ts("2024-06-01 02:00:00")
    assert {page for page, _ in got.values()} == {"/p"}


def test_nothing_on_time_yet(spark, places):
    root, target, _, job = places
    finish(watermarks.deduplicate(watermarks.on_time(spark, root, STAGING["stg_events"]), target, job, "1 hour"))
    assert watermarks.late(spark, root, STAGING["stg_events"]).count() == 0
