import uuid

import pytest
from pyspark.sql import functions as F

from basketry.sources import bucketed
from tests.conftest import final_plan, rows


@pytest.fixture()
def write(spark, tmp_path):
    names = []

    def run(df, key="user_id", buckets=4, **options):
        names.append(f"t_{uuid.uuid4().hex}")
        return bucketed.write(df, names[-1], str(tmp_path / names[-1]), key, buckets, **options)

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield run
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", before)
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def orders(spark, users):
    data = [(f"o{i}", u, float(i % 7)) for i, u in enumerate(users)]
    return spark.createDataFrame(data, "order_id string, user_id string, net_revenue double")


def people(spark, n):
    return spark.createDataFrame([(f"u{i}", "pro" if i % 2 else None, "DE") for i in range(n)], "user_id string, user_plan_type string, user_country string")


def expected(facts, users):
    joined = facts.join(users, "user_id", "left")
    return rows(joined.groupBy("user_id").agg(F.count("order_id"), F.sum("net_revenue"), F.min("user_plan_type"), F.min("user_country")))


def test_join_and_aggregation_without_a_shuffle(spark, write):
    facts, users = orders(spark, [f"u{i % 40}" for i in range(900)]), people(spark, 30)
    stored, dimension = write(facts), write(users, split_hot=False)
    found = bucketed.revenue_by_user(stored, dimension)
    assert stored.hot == [] and rows(found) == expected(facts, users)
    plan = final_plan(found)
    assert "SortMergeJoin" in plan and "SelectedBucketsCount: 4 out of 4" in plan
    assert "Exchange" not in plan


def test_hot_keys_stay_out_of_the_buckets(spark, write):
    facts, users = orders(spark, ["u1"] * 500 + [None] * 300 + [f"u{i % 40}" for i in range(200)]), people(spark, 30)
    stored, dimension = write(facts), write(users, split_hot=False)
    assert sorted(stored.hot, key=str) == [None, "u1"]
    assert stored.regular().filter("user_id IS NULL OR user_id = 'u1'").isEmpty()
    found = bucketed.revenue_by_user(stored, dimension)
    assert rows(found) == expected(facts, users)
    # Only the few rows of hot keys are shuffled, as partial sums.
    assert final_plan(found).count("SortMergeJoin [") <= 2 and "BroadcastHashJoin" in final_plan(found)
    assert rows(stored.all_rows()) == rows(facts)


def test_a_table_is_attached_again(spark, write):
    facts = orders(spark, ["u1"] * 50 + [f"u{i % 9}" for i in range(40)])
    stored = write(facts, sort_by=["order_id"])
    spark.sql(f"DROP TABLE {stored.name}")
    again = bucketed.attach(bucketed.BucketedTable(spark, stored.name, stored.path, "user_id", 4, stored.schema), ["order_id"])
    assert again.hot == ["u1"] and rows(again.all_rows()) == rows(facts)
    assert "Exchange" not in final_plan(again.regular().groupBy("user_id").count())


def test_unlike_tables_are_refused(spark, write):
    with pytest.raises(ValueError):
        bucketed.join(write(orders(spark, ["u1", "u2"])), write(people(spark, 3), buckets=8))


def test_empty_tables(spark, write):
    stored = write(orders(spark, ["u1"]).limit(0))
    assert bucketed.revenue_by_user(stored, write(people(spark, 3), split_hot=False)).count() == 0
