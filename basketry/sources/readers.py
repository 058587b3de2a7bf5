"""Raw tables as folders of CSV or Parquet files with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamReader

from basketry.schemas import RAW

# A quote inside quotes is doubled. Values with line breaks need ``multiLine="true"``, which stops Spark from
# splitting files, so it is left to callers.
CSV_OPTIONS = {"header": "true", "sep": ",", "quote": '"', "escape": '"'}

# The users export writes day-first dates; the other tables are ISO.
CSV_TABLE_OPTIONS = {
    "users": {"dateFormat": "dd-MM-yyyy", "timestampFormat": "dd-MM-yyyy HH:mm"},
    "orders": {"timestampFormat": "yyyy-MM-dd HH:mm:ss"},
    "products": {"timestampFormat": "yyyy-MM-dd HH:mm:ss"},
    "events": {},
}


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def _configured(reader, table: str, fmt: str, options: dict[str, str]):
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"raw tables are csv or parquet, not {fmt!r}")
    reader = reader.schema(RAW[table]).format(fmt)
    if fmt == "csv":
        options = {**CSV_OPTIONS, **CSV_TABLE_OPTIONS[table], **options}
    return reader.options(**options)


def read_path(spark: SparkSession, table: str, path: str, fmt: str = "csv", **options: str) -> DataFrame:
    """One raw table from a file, a folder or a glob."""
    return _configured(spark.read, table, fmt, options).load(path)


def read_raw(spark: SparkSession, root: str, table: str, fmt: str = "csv", **options: str) -> DataFrame:
    """One raw table from its folder below the lake root."""
    return read_path(spark, table, table_path(root, table), fmt, **options)


def read_orders(spark: SparkSession, root: str, fmt: str = "csv", **options: str) -> DataFrame:
    return read_raw(spark, root, "orders", fmt, **options)


def read_users(spark: SparkSession, root: str, fmt: str = "csv", **options: str) -> DataFrame:
    return read_raw(spark, root, "users", fmt, **options)


def read_products(spark: SparkSession, root: str, fmt: str = "csv", **options: str) -> DataFrame:
    return read_raw(spark, root, "products", fmt, **options)


def read_events(spark: SparkSession, root: str, fmt: str = "csv", **options: str) -> DataFrame:
    return read_raw(spark, root, "events", fmt, **options)


def read_all(spark: SparkSession, root: str, fmt: str = "csv") -> dict[str, DataFrame]:
    return {table: read_raw(spark, root, table, fmt) for table in RAW}


def stream_raw(
    spark: SparkSession,
    root: str,
    table: str,
    fmt: str = "csv",
    max_files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """The same table as a stream of newly arrived files."""
    reader: DataStreamReader = _configured(spark.readStream, table, fmt, options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(table_path(root, table))
