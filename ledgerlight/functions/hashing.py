"""Deterministic ids and splits, computed natively (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The RFC 4122 DNS namespace used for name-based (v5) ids.
NAMESPACE_DNS_HEX = "6ba7b8109dad11d180b400c04fd430c8"


def uuid5(name: Column, namespace_hex: str = NAMESPACE_DNS_HEX) -> Column:
    """RFC 4122 version-5 UUID of a UTF-8 name, as the canonical 36-char text.

    Equals Python's ``uuid.uuid5(namespace, name)``.
    """
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), F.encode(name, "UTF-8")))
    hex32 = F.substring(digest, 1, 32)
    # version nibble (13th hex digit) := 5; variant bits of the 17th := 10xx
    variant = F.lower(F.conv(
        (F.conv(F.substring(hex32, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3))
         .bitwiseOR(F.lit(8))).cast("string"), 10, 16))
    return F.concat_ws(
        "-",
        F.substring(hex32, 1, 8),
        F.substring(hex32, 9, 4),
        F.concat(F.lit("5"), F.substring(hex32, 14, 3)),
        F.concat(variant, F.substring(hex32, 18, 3)),
        F.substring(hex32, 21, 12),
    )


def row_name(class_name: str, columns: list[str]) -> Column:
    """Unambiguous text of a row: class, then ``name=length:value`` per column.

    Columns are taken in sorted order; lengths make the encoding injective
    without any escaping, so the same row always gives the same id.
    A NULL value is written as ``name=~``.
    """
    parts = [F.lit(class_name)]
    for c in sorted(columns):
        v = F.col(c).cast("string")
        parts.append(F.coalesce(
            F.concat(F.lit(f"|{c}="), F.length(v).cast("string"), F.lit(":"), v),
            F.lit(f"|{c}=~")))
    return F.concat(*parts)


def row_uuid(class_name: str, columns: list[str]) -> Column:
    """Stable v5 id of a row's values within an object class."""
    return uuid5(row_name(class_name, columns))


def split_bucket(key: Column, seed: int) -> Column:
    """0..99 from the key and seed; the same under any partitioning or engine."""
    h = F.substring(F.md5(F.concat(key.cast("string"), F.lit(f":{seed}"))), 1, 8)
    return (F.conv(h, 16, 10).cast("long") % F.lit(100)).cast("int")


def in_train(key: Column, seed: int, train_percent: int = 70) -> Column:
    return split_bucket(key, seed) < F.lit(train_percent)
