import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from basketry.operators import facts, staging
from basketry.plans import warehouse
from basketry.schemas import ANALYTICS, RAW, REPORTS, STAGING
from basketry.session import work_dir
from basketry.sources import readers, writers
from tests.conftest import AS_OF, event, final_plan, order, product, rows, ts, user

CSV = {
    "orders": [
        "order_id,user_id,product_id,status,quantity,unit_price,discount_amount,created_at,region",
        "A1,U1,P1,shipped,2,19.90,1.50,2024-06-01 08:30:00,NA",
        '"A,2",U2,P1,PENDING,1,5.00,0.00,2024-06-02 09:00:00,EU',
    ],
    "users": [
        "user_id,email,name,plan_type,signup_date,country,created_at,is_active",
        "U1,one@example.org,One,Pro,31-01-2024,us,31-01-2024 23:15,TRUE",
        "U2,two@example.org,Two,free,05-02-2024,fr,05-02-2024 00:05,FALSE",
    ],
    "products": [
        "product_id,name,category,subcategory,base_price,cost_price,created_at,is_active",
        "P1,Lamp,Home,Light,19.90,8.00,2023-05-05 00:00:00,true",
    ],
    "events": [
        "event_id,user_id,session_id,event_type,product_id,page,referrer,device_type,created_at",
        "E1,U1,S1,productview,P1,/p,,mobile,2024-06-01 08:00:00",
        "E1,U1,S1,productview,P1,/p,mail,mobile,2024-06-01 08:00:05",
    ],
}


@pytest.fixture()
def lake(tmp_path):
    for table, lines in CSV.items():
        folder = tmp_path / table
        folder.mkdir()
        header, *body = lines
        for n, line in enumerate(body):
            (folder / f"part{n}.csv").write_bytes(f"{header}\r\n{line}\r\n".encode())
    return str(tmp_path)


def test_csv_folders(spark, lake):
    orders = readers.read_orders(spark, lake)
    assert rows(orders, "order_id", "quantity", "created_at", "region") == [
        ("A,2", 1, ts("2024-06-02 09:00:00"), "EU"), ("A1", 2, ts("2024-06-01 08:30:00"), "NA"),
    ]
    users = readers.read_users(spark, lake)
    assert rows(users, "user_id", "signup_date", "created_at") == [
        ("U1", dt.date(2024, 1, 31), ts("2024-01-31 23:15:00")), ("U2", dt.date(2024, 2, 5), ts("2024-02-05 00:05:00")),
    ]
    assert rows(readers.read_products(spark, lake), "name", "cost_price") == [("Lamp", 8.0)]
    events = readers.read_events(spark, lake)
    assert rows(events, "referrer") == [(None,), ("mail",)]
    assert rows(readers.read_path(spark, "events", f"{lake}/events/part1.csv"), "referrer") == [("mail",)]


def test_parquet_and_unknown_formats(spark, lake, tmp_path):
    orders = readers.read_orders(spark, lake)
    orders.write.parquet(str(tmp_path / "pq" / "orders"))
    assert rows(readers.read_orders(spark, str(tmp_path / "pq"), "parquet")) == rows(orders)
    with pytest.raises(ValueError):
        readers.read_orders(spark, lake, "xml")


def test_whole_build_from_csv(spark, lake):
    tables = warehouse.build_all(spark, lake, AS_OF)
    assert set(tables) == {*STAGING, *ANALYTICS, *REPORTS}
    assert tables["stg_events"].count() == 1
    assert rows(tables["fct_orders"], "order_id", "net_revenue", "user_plan_type") == [("A,2", 5.0, "free"), ("A1", 38.3, "pro")]
    for df in tables.values():
        assert not {"email", "name"} & set(df.columns)
        df.collect()


def test_views(spark, lake):
    staged = warehouse.build_staging(readers.read_all(spark, lake))
    models = warehouse.build_analytics(staged, AS_OF)
    names = warehouse.register_all(staged, models)
    assert "staging_stg_orders" in names and "analytics_fct_orders" in names
    assert spark.sql("SELECT sum(quantity) FROM analytics_fct_orders").first()[0] == 3
    assert all(writers.drop_view(spark, name) for name in names)
    assert not writers.drop_view(spark, names[0])


def fact(make, orders):
    return facts.fct_orders(staging.stg_orders(make.orders(orders)))


def test_fact_layout_prunes_partitions(spark, make, tmp_path):
    path = str(tmp_path / "fct")
    orders = [order(f"o{d}{r}", day=f"2024-06-{d:02}", region=r) for d in range(1, 5) for r in ("EU", "NA")]
    writers.write_fct_orders(fact(make, orders), path)
    assert len(glob.glob(f"{path}/order_date=2024-06-0*/region=*")) == 8
    stored = spark.read.parquet(path)
    late = stored.filter("order_date >= '2024-06-03' AND region = 'NA'")
    assert rows(late, "order_id") == [("o3NA",), ("o4NA",)]
    assert "PartitionFilters: [isnotnull(order_date" in final_plan(late)


def test_rows_of_a_partition_are_clustered(spark, make, tmp_path):
    path = str(tmp_path / "fct")
    orders = [order(f"o{i:03}", user_id=f"u{i * 7 % 50:02}") for i in range(200)]
    writers.write_fct_orders(fact(make, orders), path, max_records_per_file=150)
    files = sorted(glob.glob(f"{path}/*/*/*.parquet"))
    assert len(files) >= 2
    for file in files:
        users = [r["user_id"] for r in spark.read.parquet(file).select("user_id").collect()]
        assert users == sorted(users)


def test_one_large_partition_is_split_over_tasks(spark, tmp_path):
    path = str(tmp_path / "hot")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        day = F.when(F.col("id") % 3 == 0, "2024-01-01").otherwise(F.concat(F.lit("2024-02-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0")))
        table = spark.range(0, 120_000, 1, 8).select(day.alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        writers.write_table(table, path, ["day"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    assert len(glob.glob(f"{path}/day=2024-01-01/*.parquet")) > 1
    assert spark.read.parquet(path).count() == 120_000


def test_only_written_partitions_change(spark, make, tmp_path):
    path = str(tmp_path / "fct")
    writers.write_fct_orders(fact(make, [order("a", day="2024-06-01"), order("b", day="2024-06-02")]), path)
    writers.write_fct_orders(fact(make, [order("c", day="2024-06-02")]), path, only_written_partitions=True)
    assert rows(spark.read.parquet(path), "order_id") == [("a",), ("c",)]
    writers.write_fct_orders(fact(make, [order("d", day="2024-06-02")]), path)
    assert rows(spark.read.parquet(path), "order_id") == [("d",)]


def test_events_layout(spark, make, tmp_path):
    path = str(tmp_path / "events")
    staged = staging.stg_events(make.events([event("1"), event("2", at="2024-06-02 01:00:00"), event("3", at="?")]))
    writers.write_stg_events(staged, path)
    stored = spark.read.parquet(path)
    assert stored.filter("event_date = '2024-06-02'").first()["event_id"] == "2"
    assert stored.filter("event_date IS NULL").first()["event_id"] == "3"


def test_materialized_warehouse_equals_views(spark, lake, tmp_path):
    staged = warehouse.build_staging(readers.read_all(spark, lake))
    lazy = warehouse.build_all(spark, lake, AS_OF)
    stored = warehouse.materialize(spark, staged, str(tmp_path / "out"), AS_OF)
    for name in (*STAGING, *ANALYTICS, *REPORTS):
        assert rows(stored[name]) == rows(lazy[name]), name
    plan = final_plan(stored["mom_revenue_growth"])
    assert "PartitionFilters: [isnotnull(order_date" in plan and "Join" not in plan


def test_work_dir_is_below_the_named_folder(spark):
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.basketry.workDir")
    assert first != second and first.startswith(root)


@pytest.mark.skipif(not os.environ.get("BASKETRY_SAMPLE_DIR"), reason="no sample CSV files named")
def test_sample_files(spark):
    """Known results of the public 20-row sample."""
    root = os.environ["BASKETRY_SAMPLE_DIR"]
    raw = {t: readers.read_path(spark, t, f"{root}/{t}.csv") for t in ("orders", "users", "products", "events")}
    staged = warehouse.build_staging(raw)
    models = warehouse.build_analytics(staged, dt.date(2026, 3, 1))
    reports = warehouse.build_reports(staged, models, dt.date(2026, 3, 1))
    totals = models["fct_orders"].selectExpr(
        "count(*)", "sum(quantity)", "round(sum(gross_revenue), 2)", "round(sum(net_revenue), 2)",
        "round(sum(net_revenue - quantity * product_cost_price), 2)",
    )
    assert tuple(totals.first()) == (20, 48, 2294.52, 2184.52, 1269.52)
    assert rows(models["fct_orders"].groupBy("status_category").count()) == [
        ("Cancelled", 1), ("Completed", 11), ("In Transit", 4), ("Unknown", 4),
    ]
    assert rows(reports["mom_revenue_growth"]) == [
        ("2026-01", 1083.78, None, None), ("2026-02", 1100.74, 1083.78, 1.56),
    ]
    best = reports["top_products_by_region"].filter("product_rank = 1")
    assert rows(best, "region", "product_id", "total_revenue") == [
        ("APAC", "PRD007", 233.96), ("EU", "PRD016", 224.99), ("LATAM", "PRD014", 170.98), ("NA", "PRD009", 179.99),
    ]
    assert reports["top_products_by_region"].count() == 18
    assert rows(reports["cohort_retention"], "total_users", "month0_pct") == [(4, 0.0), (5, 0.0), (5, 0.0), (6, 0.0)]
    assert reports["at_risk_customers"].count() == 0
    assert rows(models["fct_user_funnel"], "user_id", "seconds_view_to_cart", "dropped_after_view")[:4] == [
        ("USR001", 300, 0), ("USR002", 180, 0), ("USR003", 240, 0), ("USR004", None, 1),
    ]
    dropoff = [(r["device_type"], r["total_users"], round(r["drop_after_view_pct"], 4)) for r in reports["funnel_dropoff"].collect()]
    assert dropoff == [("desktop", 4, 25.0), ("mobile", 3, 66.6667), ("tablet", 2, 50.0)]
    performance = models["agg_product_performance"].selectExpr("sum(units_last_30d)", "round(sum(revenue_last_30d), 2)", "round(sum(revenue_last_90d), 2)")
    assert tuple(performance.first()) == (26, 1100.74, 2184.52)
    assert models["agg_daily_revenue"].count() == 20


def test_doubled_quotes_and_commas_stay_in_their_column(spark, tmp_path):
    names = RAW["products"].fieldNames()
    second = next(f.name for f in RAW["products"] if f.dataType.simpleString() == "string" and f.name != "product_id")
    values = {"product_id": "p1", second: '"24"" Monitor, black"'}
    (tmp_path / "products").mkdir()
    (tmp_path / "products" / "a.csv").write_text(",".join(names) + "\n" + ",".join(values.get(n, "") for n in names) + "\n")
    row = readers.read_products(spark, str(tmp_path)).first()
    assert (row.product_id, row[second]) == ("p1", '24" Monitor, black')


def test_plans_of_lazy_and_monthly_reports(spark, make, tmp_path):
    raw = {
        "orders": make.orders([order("a", day="2024-06-01"), order("b", day="2022-06-01")]),
        "users": make.users([user("u1")]), "products": make.products([product("p1")]), "events": make.events([event("1")]),
    }
    lazy = warehouse.build_lazy_reports(raw, AS_OF)
    assert "Join" not in final_plan(lazy["mom_revenue_growth"])
    for report in ("cohort_retention", "at_risk_customers"):
        assert final_plan(lazy[report]).count("Join type") == 1, report
    stored = warehouse.materialize(spark, warehouse.build_staging(raw), str(tmp_path), AS_OF, monthly=True)
    for report in ("mom_revenue_growth", "top_products_by_region"):
        pruned = [line for line in final_plan(stored[report]).splitlines() if line.startswith("PartitionFilters") and "order_month_start" in line]
        assert any(">=" in line for line in pruned), report
    for report, df in lazy.items():
        assert rows(stored[report], *df.columns) == rows(df), report
