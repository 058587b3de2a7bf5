"""Staging: typed, normalised, keyed rows without personal data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.labels import is_true
from basketry.functions.pseudonyms import configured_key, pseudonym
from basketry.operators.dedupe import first_per_key
from basketry.schemas import PII_COLUMNS, STAGING

EVENT_COLUMNS = tuple(STAGING["stg_events"].fieldNames())

# Columns that decide between copies of an event with equal times, most used
# first: a caller that needs only some columns reads the order up to its last
# needed one and still gets the values the full order would give.
_COPY_ORDER = ("user_id", "event_type", "device_type", "session_id", "product_id", "page", "referrer")

# All the funnel models read of an event.
FUNNEL_EVENT_COLUMNS = ("event_id", "user_id", "event_type", "device_type", "created_at")


def _keyed(raw: DataFrame, key: str) -> DataFrame:
    return raw.filter(F.col(key).isNotNull())


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    return _keyed(raw_orders, "order_id").select(
        F.col("order_id").cast("string"),
        F.col("user_id").cast("string"),
        F.col("product_id").cast("string"),
        F.upper("status").alias("status"),
        F.col("quantity").cast("int"),
        F.col("unit_price").cast("double"),
        F.col("discount_amount").cast("double"),
        F.col("created_at").cast("timestamp"),
        F.col("region").cast("string"),
    )


def stg_users(raw_users: DataFrame, pii: str = "exclude", key: bytes | None = None, key_version: int = 1) -> DataFrame:
    """Personal columns stay out, or come in another form that no fact or dimension takes on.

    ``pii="pseudonym"`` adds keyed pseudonyms, ``pii="hash"`` plain SHA-256 digests, which can be undone by
    hashing candidates. Without ``key`` pseudonyms take the session's.
    """
    if pii not in ("exclude", "hash", "pseudonym"):
        raise ValueError("pii is 'exclude', 'hash' or 'pseudonym'")
    masked = []
    if pii == "hash":
        masked = [F.sha2(F.col(name), 256).alias(f"{name}_sha256") for name in PII_COLUMNS]
    elif pii == "pseudonym":
        key, key_version = (key, key_version) if key else configured_key(raw_users.sparkSession)
        masked = [pseudonym(F.col(name), key, key_version).alias(f"{name}_pseudonym") for name in PII_COLUMNS]
    return _keyed(raw_users, "user_id").select(
        F.col("user_id").cast("string"),
        F.lower("plan_type").alias("plan_type"),
        F.col("signup_date").cast("date"),
        F.upper("country").alias("country"),
        F.col("created_at").cast("timestamp"),
        is_true(F.col("is_active")).alias("is_active"),
        *masked,
    )


def stg_products(raw_products: DataFrame) -> DataFrame:
    return _keyed(raw_products, "product_id").select(
        F.col("product_id").cast("string"),
        F.col("name").alias("product_name"),
        F.upper("category").alias("category"),
        F.upper("subcategory").alias("subcategory"),
        F.col("base_price").cast("double"),
        F.col("cost_price").cast("double"),
        F.col("created_at").cast("timestamp"),
        is_true(F.col("is_active")).cast("int").alias("is_active"),
    )


def event_copy_order(keep: str = "latest", columns: Sequence[str] = EVENT_COLUMNS) -> list[Column]:
    """Preference among copies of one event; unparseable times come last."""
    if keep not in ("latest", "earliest"):
        raise ValueError("keep is 'latest' or 'earliest'")
    time = F.col("created_at")
    first = time.desc_nulls_last() if keep == "latest" else time.asc_nulls_last()
    needed = [i for i, name in enumerate(_COPY_ORDER) if name in columns]
    ties = _COPY_ORDER[: max(needed) + 1] if needed else ()
    return [first, *(F.col(name).asc_nulls_first() for name in ties)]


def clean_events(raw_events: DataFrame) -> DataFrame:
    """Typed, keyed events, copies still in; usable on a stream."""
    return _keyed(raw_events, "event_id").select(
        "event_id",
        "user_id",
        "session_id",
        F.lower("event_type").alias("event_type"),
        "product_id",
        "page",
        "referrer",
        "device_type",
        F.col("created_at").try_cast("timestamp").alias("created_at"),
    )


def stg_events(
    raw_events: DataFrame, keep: str = "latest", columns: Sequence[str] = EVENT_COLUMNS
) -> DataFrame:
    """One row per event id.

    ``columns`` narrows the result, and with it what the scan reads and the
    deduplication shuffles.
    """
    order = event_copy_order(keep, columns)
    return first_per_key(clean_events(raw_events), ["event_id"], order).select(*columns)
