"""Keys for each object, and content that only its key can read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partwise.functions import keys as K
from partwise.functions.regions import endpoint_url
from partwise.functions.skew import join_by_block, salted_join
from partwise.operators.parts import n_parts


def read_keys(key_table: DataFrame) -> DataFrame:
    """(key_id, key, is_master, reject_reason) from the first that is given of key_text, key_base64 and key_bytes.

    key_bytes is BINARY: a raw key, as a table holds it or reading a key file gives it. Any of the three columns
    may be lacking.
    """
    ways = {"key_text": K.key_from_text, "key_base64": K.key_from_base64, "key_bytes": lambda raw: raw.cast("binary")}
    given = [way(F.col(name)) for name, way in ways.items() if name in key_table.columns]
    key = F.coalesce(F.lit(None).cast("binary"), *given)
    return key_table.select(
        "key_id",
        key.alias("key"),
        "is_master",
        F.when(~K.valid_key(key), F.lit("InvalidEncryptionKey")).alias("reject_reason"),
    )


def derive_object_keys(objects: DataFrame, keys: DataFrame) -> DataFrame:
    """(object_id, key_id, object_key, key_b64, key_md5_b64, reject_reason); object_key as hex.

    objects holds key_id, bucket, key and location. Many objects may use one key: the key table
    is salted. An unknown key, or one that is not 32 bytes long, is a reject; an object without
    key_id has no key and is none. A master key makes keys from URLs: an object whose location is
    unknown has none, which is a missing permission.
    """
    table = keys.select("key_id", F.col("key").alias("_key"), "is_master", "reject_reason")
    wanted = objects.select("object_id", "key_id", "bucket", F.col("key").alias("_name"), "location")
    found = salted_join(wanted, table, ["key_id"], ["object_id"], "left")
    url = F.concat_ws("/", endpoint_url(F.col("location")), F.col("bucket"), F.col("_name"))
    usable = K.valid_key(F.col("_key")) & F.col("reject_reason").isNull()
    placed = ~F.col("is_master") | F.col("location").isNotNull()
    resolved = found.withColumn("_resolved", F.when(usable & placed, K.object_key(F.col("_key"), F.col("is_master"), url)))
    return resolved.select(
        "object_id",
        "key_id",
        F.lower(F.hex("_resolved")).alias("object_key"),
        F.base64("_resolved").alias("key_b64"),
        K.fingerprint(F.col("_resolved")).alias("key_md5_b64"),
        F.when(F.col("key_id").isNotNull() & ~usable, F.lit("InvalidEncryptionKey"))
        .when(F.col("key_id").isNotNull() & ~placed, F.lit("PermissionDenied"))
        .alias("reject_reason"),
    )


def attach_keys(parts: DataFrame, keyed: DataFrame) -> DataFrame:
    """Add object_key to planned parts, before their bytes are read.

    keyed holds object_id, object_key, size and part_size. An object is repeated for each block of
    its parts, so that a huge one is no hot key.
    """
    wanted = keyed.select("object_id", "object_key", F.col("size").alias("_s"), F.col("part_size").alias("_p"))
    return join_by_block(parts, wanted, n_parts(F.col("_s"), F.col("_p")), "left").drop("_s", "_p")


def encrypted(content: Column, key_hex: Column) -> Column:
    """AES-GCM with a new IV for each call; content as it is where there is no key."""
    return F.when(key_hex.isNull(), content).otherwise(F.aes_encrypt(content, F.unhex(key_hex), F.lit("GCM")))


def decrypted(content: Column, key_hex: Column) -> Column:
    """NULL for a wrong key."""
    return F.when(key_hex.isNull(), content).otherwise(F.try_aes_decrypt(content, F.unhex(key_hex), F.lit("GCM")))


def encrypt_objects(parts: DataFrame, key_col: str = "object_key") -> DataFrame:
    """bytes encrypted in place; parts already hold the key of their object (see attach_keys).

    Parts that have a reject_reason, as those of an object whose key is unusable, lose their bytes.
    """
    stored = encrypted(F.col("bytes"), F.col(key_col))
    if "reject_reason" in parts.columns:
        stored = F.when(F.col("reject_reason").isNull(), stored)
    return parts.withColumn("bytes", stored)


def decrypt_objects(parts: DataFrame, key_col: str = "object_key") -> DataFrame:
    """bytes decrypted in place, and reject_reason; stored is_encrypted tells that a key is needed.

    Parts that were rejects before keep their reason.
    """
    plain = decrypted(F.col("bytes"), F.col(key_col))
    no_key = F.lit(False)
    if "is_encrypted" in parts.columns:
        no_key = F.col("is_encrypted") & F.col(key_col).isNull()
    result = parts.withColumn("_plain", F.when(~no_key, plain))
    return result.select(
        *[F.col("_plain").alias(c) if c == "bytes" else F.col(c) for c in parts.columns if c != "reject_reason"],
        F.coalesce(
            F.col("reject_reason") if "reject_reason" in parts.columns else F.lit(None),
            F.when(F.col("_plain").isNull(), F.lit("InvalidEncryptionKey")),
        ).alias("reject_reason"),
    )


def reencrypt_objects(parts: DataFrame, src_key_col: str, dst_key_col: str) -> DataFrame:
    """bytes from one key to another in one projection; a wrong source key is a reject."""
    opened = decrypt_objects(parts, src_key_col)
    return opened.withColumn("bytes", encrypted(F.col("bytes"), F.col(dst_key_col)))
