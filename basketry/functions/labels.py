"""Business labels and text flags."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Upper-cased order status to reporting label.
STATUS_LABELS = {
    "DELIVERED": "Completed",
    "SHIPPED": "In Transit",
    "PROCESSING": "Pending",
    "CANCELLED": "Cancelled",
    "RETURNED": "Returned",
}

# The same, covering all six statuses the orders table documents.
DOMAIN_STATUS_LABELS = {
    "PENDING": "Pending",
    "CONFIRMED": "Confirmed",
    "SHIPPED": "In Transit",
    "DELIVERED": "Completed",
    "CANCELLED": "Cancelled",
    "REFUNDED": "Returned",
}

# Plan to tier.
PLAN_TIERS = {"enterprise": "Enterprise", "pro": "Premium", "starter": "Basic", "free": "Free"}

# Lowest margin ratio of each class, best first.
MARGIN_CLASSES = (("High", 0.50), ("Medium", 0.25))


def label(value: Column, labels: Mapping[str, str], default: str = "Unknown") -> Column:
    """Label of a value; nulls and values without a label get ``default``."""
    result = F.lit(default)
    for match, text in labels.items():
        result = F.when(value == match, F.lit(text)).otherwise(result)
    return result


def margin_class(ratio: Column) -> Column:
    result = F.lit("Low")
    for name, floor in reversed(MARGIN_CLASSES):
        result = F.when(ratio >= floor, F.lit(name)).otherwise(result)
    return result


def is_true(text: Column) -> Column:
    """Whether a text flag says true, in any case; null and all else are false."""
    return F.coalesce(F.lower(text) == "true", F.lit(False))
