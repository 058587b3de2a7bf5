import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F, types as T

from basketry.operators import staging
from basketry.plans import registry
from basketry.schemas import RAW
from basketry.sources import paths, readers
from basketry.streaming import incremental, jobs
from basketry.streaming.directory import KeyDirectory
from tests.conftest import event, final_plan, rows, ts
from tests.test_streaming import drop, finish, lake  # noqa: F401

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("version", T.IntegerType()), T.StructField("day", T.DateType())])
DAY = dt.date(2024, 6, 1)


@pytest.fixture()
def directory(spark, tmp_path):
    return KeyDirectory(spark, str(tmp_path / "keys"), ["id"], "day", SCHEMA, buckets=16, filter_bits=1 << 15)


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_finds_every_place_of_known_keys_only(spark, directory, tmp_path):
    assert rows(directory.find(frame(spark, [("a", 1, DAY)]), str(tmp_path / "s0"))) == []
    directory.add(frame(spark, [(f"k{i}", 1, DAY + dt.timedelta(i % 40)) for i in range(2000)] + [(None, 1, None), ("u", 1, None)]))
    directory.add(frame(spark, [("k7", 2, DAY), ("k7", 2, DAY)]))
    asked = frame(spark, [(f"k{i}", 3, DAY) for i in range(0, 4000, 7)] + [("k7", 4, None), (None, 1, DAY), ("u", 1, DAY), ("new", 1, DAY)])
    wanted = [(f"k{i}", DAY + dt.timedelta(i % 40)) for i in range(0, 2000, 7)] + [("k7", DAY), (None, None), ("u", None)]
    assert rows(directory.find(asked, str(tmp_path / "s1"))) == sorted(wanted, key=lambda t: tuple((v is not None, str(v)) for v in t))
    assert {k for (k,) in rows(directory.maybe_known(asked), "id")} < {k for (k,) in rows(asked, "id")}


def test_lookup_reads_only_the_buckets_of_the_batch(spark, directory, tmp_path):
    directory.add(frame(spark, [(f"k{i}", 1, DAY) for i in range(500)]))
    asked = frame(spark, [("k5", 2, DAY)])
    found = directory.find(asked, str(tmp_path / "s"))
    assert "PartitionFilters: [isnotnull(bucket" in final_plan(found)
    mine = directory.maybe_known(asked).first().bucket
    for file in (tmp_path / "keys").glob("*/*/bucket=*/*.parquet"):
        if f"bucket={mine}/" not in str(file):
            (file.parent / f".{file.name}.crc").unlink()
            file.write_bytes(b"no parquet")
    again = directory.find(asked, str(tmp_path / "t"))
    assert rows(again) == [("k5", DAY)]
    # Of keys that the filters have not seen, no place is read.
    for file in (tmp_path / "keys").glob("*/places/bucket=*/*.parquet"):
        file.unlink()
    same_bucket = (frame(spark, [(f"never {i}", 2, DAY) for i in range(200)]).withColumn("bucket", directory._bucket())
                   .filter(F.col("bucket") == mine))
    assert directory.find(same_bucket, str(tmp_path / "u")).count() == 0 < same_bucket.count()


def test_compact_forgets_places_that_keys_left(spark, directory, tmp_path):
    directory.add(frame(spark, [("a", 1, DAY), ("b", 1, DAY)]))
    later = frame(spark, [("a", 2, DAY + dt.timedelta(9)), ("b", 1, DAY)])
    directory.add(later)
    directory.compact(later)
    assert rows(directory.find(later, str(tmp_path / "s"))) == [("a", DAY + dt.timedelta(9)), ("b", DAY)]


def test_upsert_does_not_scan_the_table(spark, tmp_path):
    target = str(tmp_path / "t")

    def load(n, data):
        incremental.upsert(spark, frame(spark, data), target, ["id"], ["day"], f"{tmp_path}/run-{n}", batch_preference=[F.col("version").desc()])
        return rows(spark.read.schema(SCHEMA).parquet(target))

    day = lambda n: DAY + dt.timedelta(n)
    load(1, [(f"k{i}", 1, day(i % 30)) for i in range(300)] + [("undated", 1, None)])
    # Files of days that neither hold nor get a key of the batch may be unreadable.
    for n in (5, 6, 7):
        paths.delete(spark, f"{target}/day={day(n)}")
        (tmp_path / "t" / f"day={day(n)}").mkdir()
        (tmp_path / "t" / f"day={day(n)}" / "part-0.parquet").write_bytes(b"no parquet")
    incremental.upsert(spark, frame(spark, [("k31", 2, day(20)), ("undated", 2, day(3)), ("far", 1, day(300))]), target, ["id"], ["day"], f"{tmp_path}/run-2",
                       batch_preference=[F.col("version").desc()])
    for n in (5, 6, 7):
        paths.delete(spark, f"{target}/day={day(n)}")
    stored = {r[0]: r[1:] for r in rows(spark.read.schema(SCHEMA).parquet(target))}
    assert stored["k31"] == (2, day(20)) and stored["undated"] == (2, day(3)) and stored["far"] == (1, day(300)) and stored["k1"] == (1, day(1))
    assert len(stored) == 301 + 1 - 30


def test_a_table_without_directory_gets_one(spark, tmp_path):
    target = str(tmp_path / "t")
    frame(spark, [("a", 1, DAY), ("b", 1, DAY)]).write.partitionBy("day").parquet(target)
    incremental.upsert(spark, frame(spark, [("a", 2, DAY + dt.timedelta(50))]), target, ["id"], ["day"], f"{tmp_path}/run")
    assert rows(spark.read.schema(SCHEMA).parquet(target)) == [("a", 2, DAY + dt.timedelta(50)), ("b", 1, DAY)]


def test_first_arrivals_however_far_apart(spark, make, lake, tmp_path):  # noqa: F811
    target, checkpoint = str(tmp_path / "events"), str(tmp_path / "job")
    drops = [
        [event("1", at="2024-06-01 10:00:00"), event("2", at="2024-06-01 11:00:00"), event("3", at="never")],
        [event("1", at="2024-06-04 10:00:00"), event("2", at="?"), event("3", at="2024-09-01 10:00:00"), event("4", at="2024-06-09 10:00:00")],
        [event("4", at="2024-01-01 10:00:00"), event("1", at="2023-06-04 10:00:00"), event("5", at="2024-01-01 09:00:00")],
    ]
    for batch in drops:
        drop(make, lake, "events", batch)
        finish(jobs.ingest_first_arrivals(readers.stream_raw(spark, lake, "events"), target, checkpoint))
    assert rows(spark.read.parquet(target), "event_id", "created_at") == [
        ("1", ts("2024-06-01 10:00:00")), ("2", ts("2024-06-01 11:00:00")), ("3", None), ("4", ts("2024-06-09 10:00:00")), ("5", ts("2024-01-01 09:00:00"))]


def test_events_move_between_far_days(spark, make, tmp_path):
    target = str(tmp_path / "events")
    batches = [[event("1", at="2024-06-01 10:00:00"), event("2", at="?")], [event("1", at="2024-08-01 10:00:00"), event("2", at="2024-02-01 10:00:00")]]
    for n, batch in enumerate(batches):
        incremental.upsert_events(spark, staging.clean_events(make.events(batch)), target, f"{tmp_path}/runs/{n}")
    everything = staging.stg_events(make.events(sum(batches, [])))
    assert rows(spark.read.parquet(target), *everything.columns) == rows(everything)


def test_a_lookup_shuffles_the_keys_once(spark, tmp_path):
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("day", T.StringType())])
    stored = spark.createDataFrame([(f"k{i}", "a") for i in range(50)] + [(None, "b")], schema)
    directory = KeyDirectory(spark, str(tmp_path / "keys"), ["key"], "day", schema)
    directory.add(stored, unique=True)
    batch = spark.createDataFrame([("k1", "z"), ("k1", "y"), ("new", "z"), (None, "z")], schema)
    maybe = directory.maybe_known(batch)
    assert {r["key"] for r in maybe.collect()} >= {"k1", None} and maybe.count() <= 3
    assert {(r["key"], r["place"]) for r in directory.find(batch, str(tmp_path / "scratch")).collect()} == {("k1", "a"), (None, "b")}
    planned = final_plan(directory.maybe_known(batch))
    assert sum("hashpartitioning(key" in line for line in planned.split("\n") if line.startswith("Arguments")) == 1


def test_deliveries_map_the_raw_table_once(spark, tmp_path, monkeypatch):
    mapped, n = spark.sparkContext.accumulator(0), 40

    @F.udf("string")
    def noted(x):
        mapped.add(1)
        return x

    fields = [noted(F.col("id").cast("string")).alias("event_id"), *(F.lit("x").alias(c) for c in RAW["events"].fieldNames()[1:])]
    monkeypatch.setattr(registry.star, "raw_events", lambda *_: spark.range(n).select(*fields))
    monkeypatch.setattr(registry.readers, "stream_raw", lambda spark, lake, *_: spark.read.parquet(registry.readers.table_path(lake, "events")))
    monkeypatch.setattr(registry, "_finish", lambda seen: None)
    arrived = []
    t = SimpleNamespace(spark=spark, sf_dir="", folder=lambda name: str(tmp_path / name))
    registry._arrivals(t, "events", lambda raw: arrived.append(raw.count()), "event_id")
    assert len(arrived) == 3 and arrived == sorted(arrived) and arrived[-1] == n
    assert mapped.value == n
