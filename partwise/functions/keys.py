"""Customer-provided 32-byte keys: reading, deriving per object, fingerprint."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_BYTES = 32


def key_from_text(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def key_from_base64(text: Column) -> Column:
    """NULL where the text is not base64."""
    return F.try_to_binary(text, F.lit("base64"))


def object_key(key: Column, is_master: Column, url: Column) -> Column:
    """SHA-256 over key and object URL for a master key, else the key itself; BINARY."""
    derived = F.unhex(F.sha2(F.concat(key, F.encode(url, "UTF-8")), 256))
    return F.when(is_master, derived).otherwise(key)


def fingerprint(key: Column) -> Column:
    return F.base64(F.unhex(F.md5(key)))


def valid_key(key: Column) -> Column:
    return F.coalesce(F.length(key) == KEY_BYTES, F.lit(False))
