import datetime as dt
import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from basketry.functions.pseudonyms import KEY_CONF, VERSION_CONF, pseudonym
from basketry.operators import calendar, facts, quality, staging
from basketry.plans import panels
from basketry.sources import writers
from tests.conftest import event, final_plan, order, rows, user


@pytest.mark.parametrize("key", [b"k" * 16, bytes(range(64)), b"long" * 40])
def test_pseudonyms_are_hmacs(spark, key):
    values = ["ann@example.org", "", "ü@x", None, "ann@example.org"]
    found = spark.createDataFrame([(v,) for v in values], "v string").select(pseudonym(F.col("v"), key, 3).alias("p"))
    assert [r.p for r in found.collect()] == [v if v is None else "k3:" + hmac.new(key, v.encode(), hashlib.sha256).hexdigest() for v in values]
    with pytest.raises(ValueError):
        pseudonym(F.col("v"), b"short")


def test_the_session_has_the_key(spark, make):
    raw = make.users([user("u1")])
    with pytest.raises(ValueError, match=KEY_CONF):
        staging.stg_users(raw, pii="pseudonym")
    spark.conf.set(KEY_CONF, (b"k" * 16).hex())
    spark.conf.set(VERSION_CONF, "2")
    try:
        staged = staging.stg_users(raw, pii="pseudonym")
        assert staged.first()["email_pseudonym"] == "k2:" + hmac.new(b"k" * 16, b"u1@example.org", hashlib.sha256).hexdigest()
    finally:
        spark.conf.unset(KEY_CONF)
        spark.conf.unset(VERSION_CONF)
    for pii in ("pseudonym", "hash"):
        with pytest.raises(ValueError, match="personal"):
            quality.assert_no_pii(staging.stg_users(raw, pii, b"k" * 16), derived=True)


def test_calendar_days(spark):
    days = calendar.build(spark, dt.date(2023, 12, 30), dt.date(2024, 3, 1))
    got = {r[0]: tuple(r)[1:] for r in days.collect()}
    assert len(got) == 63
    for day, found in got.items():
        assert found == (day.replace(day=1), day.year, (day.month + 2) // 3, day.month, day.isoweekday(), day.isoweekday() > 5)
    with pytest.raises(ValueError):
        calendar.build(spark, dt.date(2024, 1, 2), dt.date(2024, 1, 1))


def test_chosen_days_prune_partitions(spark, make, tmp_path):
    orders = [order(f"o{i}", day=str(dt.date(2024, 1, 1) + dt.timedelta(i))) for i in range(120)] + [order("undated", created_at=None)]
    fact = facts.fct_orders(staging.stg_orders(make.orders(orders)))
    writers.write_fct_orders(fact, str(tmp_path / "daily"))
    writers.write_fct_orders(writers.with_order_month(fact), str(tmp_path / "monthly"), writers.MONTHLY_ORDER_PARTITIONS)
    days = calendar.store(calendar.build(spark, dt.date(2023, 1, 1), dt.date(2025, 12, 31)), str(tmp_path / "calendar"))
    chosen = F.col("is_weekend") & (F.col("month") == 2)
    want = [(f"o{i}",) for i in range(120) if (d := dt.date(2024, 1, 1) + dt.timedelta(i)).month == 2 and d.isoweekday() > 5]
    for name, month, kept in (("daily", None, "order_date=2024-02"), ("monthly", "order_month_start", "order_month_start=2024-02")):
        schema = spark.read.parquet(str(tmp_path / name)).schema
        # Files of other partitions may be unreadable.
        for file in (tmp_path / name).rglob("*.parquet"):
            if kept not in str(file):
                (file.parent / f".{file.name}.crc").unlink()
                file.write_bytes(b"no parquet")
        found = calendar.on_days(spark.read.schema(schema).parquet(str(tmp_path / name)), days, chosen, month)
        assert rows(found, "order_id") == sorted(want)
        assert "dynamicpruning" in final_plan(found)


def test_panel_filter_takes_times(make):
    events = staging.stg_events(make.events([event(str(i), at=f"2024-06-0{i} 23:59:59.9") for i in range(1, 6)] + [event("x", at="?")]))
    assert rows(panels.dashboard_filter(events, "2024-06-02", "2024-06-04", day="created_at"), "event_id") == [("2",), ("3",), ("4",)]
