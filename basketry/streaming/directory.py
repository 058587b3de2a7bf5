"""A key directory: in which partitions of a table a key has ever been stored, without reading the table.

An upsert must find the stored rows of its keys wherever they are. The directory keeps two small tables in
hash buckets of the keys, both only ever appended to:

- ``filters``: a membership filter per bucket, as 4 KB bitmaps. Keys that it has not seen are new for certain.
- ``places``: the keys of a bucket and the lead partition values they were stored under.

A lookup reads the filters of the batch's buckets, then the places of the buckets that hold a key that may be known.
Bucket numbers are partition folders, so Spark lists and reads nothing of the others.

Rows are added after a table was published and may be added again: a place said twice is the same place. A place a
key has left stays until ``compact``; it costs a look at a partition and never a wrong row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from basketry.sources import paths

# About a million keys a bucket; large tables take more. The folder is named after both numbers: with other ones it is
# made anew from the table.
BUCKETS = 16
# Per bucket: bits, and bits set per key. One key in 10 is taken for known at 400,000 keys a bucket.
FILTER_BITS, FILTER_HASHES = 1 << 21, 2
_MAP_BITS = 1 << 15


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, (left[k].eqNullSafe(right[k]) for k in keys))


class KeyDirectory:
    """The directory of a table with ``keys`` and a lead partition column; ``schema`` holds them all."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], lead: str, schema: T.StructType,
                 buckets: int = BUCKETS, filter_bits: int = FILTER_BITS):
        if filter_bits % _MAP_BITS:
            raise ValueError(f"filter_bits is a multiple of {_MAP_BITS}")
        self.spark, self.path, self.keys, self.lead = spark, f"{path.rstrip('/')}/{buckets}-{filter_bits}", list(keys), lead
        self.buckets, self.filter_bits = buckets, filter_bits
        self.places_schema = T.StructType([*(schema[k] for k in keys), T.StructField("place", schema[lead].dataType), T.StructField("bucket", T.IntegerType())])
        self.filters_schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("bits", T.BinaryType()), T.StructField("bucket", T.IntegerType())])

    @property
    def exists(self) -> bool:
        return paths.finished(self.spark, f"{self.path}/filters")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _bits(self) -> Column:
        """Places of a key's bits in its bucket's filter: (part, bit)."""
        spots = [F.pmod(F.xxhash64(*self.keys, F.lit(f"filter {i}")), F.lit(self.filter_bits)) for i in range(FILTER_HASHES)]
        return F.array(*(F.struct((s / _MAP_BITS).cast("int").alias("part"), (s % _MAP_BITS).cast("long").alias("bit")) for s in spots))

    def add(self, rows: DataFrame, unique: bool = False) -> None:
        """Note where rows (keys and lead column) are stored; their filters follow the places, so none is missed.

        ``unique`` says that no key comes twice, which saves a shuffle.
        """
        noted = rows.select(*self.keys, F.col(self.lead).alias("place"))
        noted = (noted if unique else noted.distinct()).withColumn("bucket", self._bucket())
        self._append(noted.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", *self.keys), "places")
        spots = rows.select(self._bucket().alias("bucket"), F.explode(self._bits()).alias("spot"))
        maps = spots.groupBy("bucket", F.col("spot.part").alias("part")).agg(F.expr("bitmap_construct_agg(spot.bit)").alias("bits"))
        self._append(maps.hint("rebalance", F.col("bucket")), "filters")

    def _append(self, rows: DataFrame, name: str) -> None:
        rows.write.mode("append").partitionBy("bucket").parquet(f"{self.path}/{name}")

    def _stored(self, name: str, schema: T.StructType, buckets: Sequence[int]) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}").filter(F.col("bucket").isin(list(buckets)))

    def _buckets_of(self, rows: DataFrame) -> list[int]:
        """At most ``buckets`` numbers reach the driver."""
        return sorted(r[0] for r in rows.select("bucket").distinct().collect())

    def maybe_known(self, batch: DataFrame) -> DataFrame:
        """The distinct keys of the batch that the filters have seen, and a few they have not, with their bucket."""
        asked = batch.select(*self.keys, self._bucket().alias("bucket"), F.explode(self._bits()).alias("spot"))
        filters = self._stored("filters", self.filters_schema, self._buckets_of(batch.select(self._bucket().alias("bucket"))))
        maps = filters.groupBy("bucket", "part").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
        spots = asked.select(*self.keys, "bucket", F.col("spot.part").alias("part"), F.col("spot.bit").alias("bit"))
        # A filter stays one row per part however many keys ask for it: the keys' bits are tested at the part's bitmap.
        byte = F.conv(F.hex(F.expr("substring(bits, int(bit div 8) + 1, 1)")), 16, 10).cast("int")
        hit = byte.bitwiseAND(F.expr("shiftleft(1, int(bit % 8))")) > 0
        tested = spots.join(maps, ["bucket", "part"], "left").groupBy(*self.keys, "bucket").agg(
            F.bool_and(F.coalesce(hit, F.lit(False))).alias("seen"))
        return tested.filter("seen").drop("seen")

    def find(self, batch: DataFrame, scratch: str) -> DataFrame:
        """Keys of the batch that were ever stored, and their places (null is one); a key may have several.

        ``scratch`` is a folder of this one lookup, for the keys that the filters let through.
        """
        if not self.exists:
            return batch.limit(0).select(*self.keys, F.col(self.lead).alias("place"))
        self.maybe_known(batch).write.mode("overwrite").parquet(scratch)
        fields = [self.places_schema[k] for k in self.keys]
        maybe = self.spark.read.schema(T.StructType([*fields, self.places_schema["bucket"]])).parquet(scratch)
        places = self._stored("places", self.places_schema, self._buckets_of(maybe))
        return places.join(maybe.select(*self.keys), same_key(places, maybe, self.keys), "left_semi").select(*self.keys, "place").distinct()

    def compact(self, table: DataFrame) -> None:
        """Write the directory anew from the table it belongs to, without places that keys have left.

        Lookups must not run meanwhile.
        """
        paths.delete(self.spark, self.path)
        self.add(table)
