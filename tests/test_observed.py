from pyspark.sql import functions as F

from basketry.operators import observed, quality
from basketry.schemas import RAW
from basketry.sources import readers
from tests.conftest import event, order, rows, user
from tests.test_streaming import drop, finish, lake  # noqa: F401

ORDERS = [order("a"), order(None, status="odd"), order("b", region="Mars", day="2024-07-01"), order("c", region=None, status="SHIPPED"), order("d", region="mars")]


def test_metrics_of_a_write_equal_the_checks(spark, make, tmp_path):
    tables = {"orders": make.orders(ORDERS), "users": make.users([user("u1"), user(None, "gold"), user("u2", "PRO")]),
              "events": make.events([event("1"), event("2", at="?"), event(None, device_type="fridge")])}
    found = observed.write(tables, lambda name, df: df.write.parquet(str(tmp_path / name)))
    got = {(r.table_name, r.metric): r.value for r in found.collect()}
    assert {t: got[t, "rows"] for t in tables} == {"orders": 5, "users": 3, "events": 3}
    for r in quality.null_keys(tables).collect():
        assert got[r.table_name, "null_keys"] == r.null_keys
    outside = {}
    for r in quality.domain_violations(tables).collect():
        name, column = r.column_name.split(".")
        outside[name, f"outside_{column}"] = outside.get((name, f"outside_{column}"), 0) + r.rows
    assert {k: v for k, v in got.items() if k[1].startswith("outside_") and v} == outside
    newest = tables["orders"].agg(F.max(F.unix_seconds("created_at"))).first()[0]
    assert got["orders", "newest_second"] == newest
    assert spark.read.parquet(str(tmp_path / "orders")).count() == 5


def test_metrics_of_an_empty_table(spark, make, tmp_path):
    found = observed.write({"orders": make.orders(ORDERS).limit(0)}, lambda _, df: df.write.parquet(str(tmp_path / "none")))
    assert rows(found.filter("metric = 'newest_second'"), "value") == [(None,)] and rows(found.filter("metric = 'rows'"), "value") == [(0,)]


def test_metrics_of_a_stream_per_batch(spark, make, lake, tmp_path):  # noqa: F811
    seen = observed.StreamMetrics()
    spark.streams.addListener(seen)
    try:
        for n, batch in enumerate((ORDERS, [order("x", region="Venus")])):
            drop(make, lake, "orders", batch)
            stream = observed.on_stream(readers.stream_raw(spark, lake, "orders"), "orders")
            query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "job")).trigger(availableNow=True).start(str(tmp_path / "out"))
            finish(query)
            seen.wait(query.id, n)
    finally:
        spark.streams.removeListener(seen)
    got = {(r.batch, r.metric): r.value for r in seen.table(spark).collect()}
    assert (got[0, "rows"], got[0, "null_keys"], got[0, "outside_region"], got[0, "outside_status"]) == (5, 1, 2, 1)
    assert (got[1, "rows"], got[1, "null_keys"], got[1, "outside_region"], got[1, "outside_status"]) == (1, 0, 1, 0)
    assert spark.read.schema(RAW["orders"]).parquet(str(tmp_path / "out")).count() == 6
