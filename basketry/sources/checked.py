"""CSV deliveries split into good rows and rejects with reasons; no value turns into null unseen.

Lines are read as text columns. Each value is read again by the formats its column accepts; a value that none of them
reads, a line with too few or too many columns, and a row without its key make a reject. Good rows and rejects
together are all delivered lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from basketry.schemas import PRIMARY_KEYS, RAW
from basketry.sources import readers

_LINE = "_line"
# Accepted formats, the usual one of each table first.
TIMES = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm", "yyyy-MM-dd")
DAY_FIRST_TIMES = ("dd-MM-yyyy HH:mm", "dd-MM-yyyy HH:mm:ss", "dd-MM-yyyy", *TIMES)
DATES, DAY_FIRST_DATES = ("yyyy-MM-dd",), ("dd-MM-yyyy", "yyyy-MM-dd")


def _value(table: str, field: T.StructField) -> Column:
    """The column's text, read as its type; null if no accepted format reads it."""
    text = F.trim(F.col(field.name))
    if isinstance(field.dataType, T.StringType):
        return F.col(field.name)
    if isinstance(field.dataType, (T.TimestampType, T.DateType)):
        day_first = table == "users"
        if isinstance(field.dataType, T.DateType):
            formats = DAY_FIRST_DATES if day_first else DATES
            return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in formats)).cast("date")
        formats = DAY_FIRST_TIMES if day_first else TIMES
        return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in formats))
    if isinstance(field.dataType, T.DoubleType):
        # Words such as NaN and Infinity are no amounts.
        return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))
    return text.try_cast(field.dataType)


def _reasons(table: str, schema: T.StructType) -> Column:
    found = [F.when(F.col(_LINE).isNotNull(), F.lit("columns"))]
    whole = F.col(_LINE).isNull()
    found.append(F.when(whole & F.coalesce(F.trim(PRIMARY_KEYS[table]) == "", F.lit(True)), F.lit(PRIMARY_KEYS[table])))
    for field in schema.fields:
        if not isinstance(field.dataType, T.StringType):
            given = F.coalesce(F.trim(field.name) != "", F.lit(False))
            found.append(F.when(whole & given & _value(table, field).isNull(), F.lit(field.name)))
    return F.array_compact(F.array(*found))


def read(spark: SparkSession, root: str, table: str, path: str | None = None, **options: str) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) of a table's CSV folder.

    Good rows have the declared columns and types; an empty value of another type than text is null. Rejects have
    file, content (the line as it stood where its columns don't fit, else its values as JSON) and reasons: ``columns``, or
    the names of the columns that can't be read.
    """
    schema = RAW[table]
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(_LINE, T.StringType())])
    settings = {**readers.CSV_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _LINE,
                # A pruned reader takes no notice of columns that it isn't asked for, missing ones among them.
                "columnPruning": "false", **options}
    lines = spark.read.schema(text).options(**settings).csv(path or readers.table_path(root, table))
    checked = lines.select("*", F.col("_metadata.file_path").alias("file")).withColumn("reasons", _reasons(table, schema))
    good = checked.filter(F.size("reasons") == 0).select(*(_value(table, f).alias(f.name) for f in schema.fields))
    values = F.to_json(F.struct(*(F.col(f.name) for f in schema.fields)))
    rejects = checked.filter(F.size("reasons") > 0).select("file", F.coalesce(F.col(_LINE), values).alias("content"), "reasons")
    return good, rejects


def reason_counts(rejects: DataFrame) -> DataFrame:
    """reason, lines: how many lines have a reason; a line may have several."""
    return rejects.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))
