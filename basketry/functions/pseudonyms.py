"""Keyed pseudonyms: HMAC-SHA-256 out of built-in functions.

A plain digest of an e-mail address can be undone by hashing candidates. With a secret key it can't, while equal values
still get equal pseudonyms, so joins and distinct counts work. The key's version stands in front, so that pseudonyms
made under different keys are told apart. Both pads of the key are literals of the query plan: whoever may read plans
of the staging job can derive pseudonyms, though not the key itself.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, SparkSession, functions as F

KEY_CONF, VERSION_CONF = "spark.basketry.pseudonymKey", "spark.basketry.pseudonymKeyVersion"
_BLOCK = 64


def configured_key(spark: SparkSession) -> tuple[bytes, int]:
    """The session's key (hexadecimal, 16 bytes at least) and its version."""
    text = spark.conf.get(KEY_CONF, None)
    if not text:
        raise ValueError(f"set {KEY_CONF} to the key in hexadecimal digits")
    return bytes.fromhex(text), int(spark.conf.get(VERSION_CONF, "1"))


def pseudonym(value: Column, key: bytes, version: int = 1) -> Column:
    """``k<version>:<64 hexadecimal digits>``; null stays null."""
    if len(key) < 16:
        raise ValueError("keys have 16 bytes at least")
    block = (key if len(key) <= _BLOCK else hashlib.sha256(key).digest()).ljust(_BLOCK, b"\0")
    inner, outer = (F.lit(bytearray(b ^ pad for b in block)) for pad in (0x36, 0x5C))
    message = F.sha2(F.concat(inner, F.encode(value.cast("string"), "UTF-8")), 256)
    return F.concat(F.lit(f"k{version}:"), F.sha2(F.concat(outer, F.unhex(message)), 256))
