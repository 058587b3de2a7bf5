import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from basketry.operators import aggregates, facts, staging
from basketry.sources import paths, writers
from basketry.streaming import incremental
from tests.conftest import event, final_plan, order, product, rows, ts, user


@pytest.fixture()
def load(spark, make, tmp_path):
    """Load order batches one after the other into a stored fact; returns it."""
    target = str(tmp_path / "fct")
    products = staging.stg_products(make.products([product("p1")]))
    users = staging.stg_users(make.users([user("u1"), user("u2", "free")]))
    full = lambda orders: facts.fct_orders(staging.stg_orders(make.orders(orders)), products, users)

    class Load:
        path, fact = target, staticmethod(full)

        def __call__(self, orders, run, **options):
            incremental.upsert_orders(spark, full(orders), target, f"{tmp_path}/runs/{run}", **options)
            return self.stored()

        def stored(self):
            spark.catalog.refreshByPath(target)
            return spark.read.schema(full([order("x")]).schema).parquet(target)

    return Load()


FIRST = [order("a"), order("b", day="2024-06-02"), order("c", day="2024-06-03"), order("d", day="2024-06-03", region="NA")]
SECOND = [
    order("b", day="2024-06-02", status="refunded"),
    order("c", day="2024-06-05"),
    order("e", day="2024-06-02", user_id="nobody"),
]


def test_upsert_equals_full_rebuild(load):
    load(FIRST, 1)
    stored = load(SECOND, 2)
    survivors = [FIRST[0], FIRST[3], *SECOND]
    assert rows(stored, *sorted(stored.columns)) == rows(load.fact(survivors), *sorted(stored.columns))


def test_emptied_partitions_disappear(load):
    load(FIRST, 1)
    load(SECOND, 2)
    kept = {p.split("/order_date=")[1] for p in glob.glob(f"{load.path}/*/*")}
    assert "2024-06-03/region=EU" not in kept
    assert kept == {"2024-06-01/region=EU", "2024-06-02/region=EU", "2024-06-03/region=NA", "2024-06-05/region=EU"}


def test_emptied_partitions_with_special_characters_disappear(load):
    odd = ["A B", "50%", "x:y", "ü/é", None]
    load([order(f"o{i}", region=r) for i, r in enumerate(odd)], 1)
    stored = load([order(f"o{i}", region="EU") for i in range(len(odd))], 2)
    assert rows(stored, "order_id", "region") == [(f"o{i}", "EU") for i in range(len(odd))]


def test_untouched_partitions_keep_their_files(load):
    load(FIRST, 1)
    before = glob.glob(f"{load.path}/order_date=2024-06-01/*/*.parquet")
    load(SECOND, 2)
    assert glob.glob(f"{load.path}/order_date=2024-06-01/*/*.parquet") == before


def test_a_repeated_run_changes_nothing(load):
    load(FIRST, 1)
    once = rows(load(SECOND, 2), "order_id", "order_date", "status_raw")
    assert rows(load(SECOND, 2), "order_id", "order_date", "status_raw") == once


def test_a_run_that_died_while_publishing_is_completed(spark, load):
    load(FIRST, 1)
    expected = rows(load(SECOND, 2), "order_id", "order_date")
    # The target lost a partition half way; the merged rows are still in the run folder.
    paths.delete(spark, f"{load.path}/order_date=2024-06-02")
    assert len(rows(load.stored(), "order_id")) < len(expected)
    assert rows(load(SECOND, 2), "order_id", "order_date") == expected


def test_newest_version_in_a_batch_counts(load):
    stored = load([order("a", day="2024-06-01"), order("a", day="2024-06-04", status="shipped")], 1)
    assert rows(stored, "order_id", "status_raw") == [("a", "SHIPPED")]


def test_missing_days_are_a_partition_too(load):
    load([order("a", created_at=None), order("b")], 1)
    stored = load([order("a", day="2024-06-09"), order("c", created_at=None)], 2)
    assert rows(stored, "order_id", "order_date") == [
        ("a", dt.date(2024, 6, 9)), ("b", dt.date(2024, 6, 1)), ("c", None),
    ]


def test_daily_refresh_equals_full_aggregation(spark, load, tmp_path):
    daily = str(tmp_path / "daily")
    for n, batch in enumerate((FIRST, SECOND)):
        stored = load(batch, n)
        days = incremental.touched_days(spark, stored.schema, f"{tmp_path}/runs/{n}")
        incremental.refresh_daily_revenue(spark, stored, daily, days, f"{tmp_path}/daily-runs/{n}")
    full = aggregates.agg_daily_revenue(load.fact([FIRST[0], FIRST[3], *SECOND]))
    assert rows(spark.read.parquet(daily), *full.columns) == rows(full)


def test_daily_refresh_drops_a_month_without_orders(spark, load, tmp_path):
    daily = str(tmp_path / "daily")
    for n, batch in enumerate(([order("a", day="2024-05-31"), order("b")], [order("a", day="2024-06-07")])):
        stored = load(batch, n)
        days = incremental.touched_days(spark, stored.schema, f"{tmp_path}/runs/{n}")
        incremental.refresh_daily_revenue(spark, stored, daily, days, f"{tmp_path}/daily-runs/{n}")
    assert [d for (d,) in rows(spark.read.parquet(daily), "order_date")] == [dt.date(2024, 6, 1), dt.date(2024, 6, 7)]
    incremental.refresh_daily_revenue(spark, load.stored(), daily, [], f"{tmp_path}/daily-runs/none")


def test_events_keep_the_latest_copy_over_batches(spark, make, tmp_path):
    target = str(tmp_path / "events")
    batches = [
        [event("1", at="2024-06-01 10:00:00"), event("2", at="2024-06-05 10:00:00"), event("3", at="?")],
        [event("1", at="2024-06-02 10:00:00", page="/new"), event("2", at="2024-06-04 10:00:00", page="/old"), event("3", page="/timed")],
    ]
    for n, batch in enumerate(batches):
        incremental.upsert_events(spark, staging.clean_events(make.events(batch)), target, f"{tmp_path}/runs/{n}")
    everything = staging.stg_events(make.events(batches[0] + batches[1]))
    assert rows(spark.read.parquet(target), *everything.columns) == rows(everything)


def test_recent_orders_prune_partitions(spark, make, tmp_path):
    path = str(tmp_path / "fct")
    fact = facts.fct_orders(staging.stg_orders(make.orders(FIRST)))
    writers.write_fct_orders(fact, path)
    now = F.lit(ts("2024-06-03 12:30:00"))
    recent = incremental.changed_since(spark.read.parquet(path), incremental.look_back(now), "order_date")
    assert rows(recent, "order_id") == [("c",), ("d",)]
    assert "order_date" in final_plan(recent).split("PartitionFilters: ")[1].splitlines()[0]
    assert incremental.high_water_mark(fact).first()[0] == ts("2024-06-03 12:00:00")
