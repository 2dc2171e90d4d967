"""Surrogate keys and hashed identifiers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the DNS namespace of name-based UUIDs (RFC 4122).
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"


def text(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def md5_key(value) -> Column:
    return F.md5(text(value).cast("binary"))


def sha256_of(*parts: Column) -> Column:
    """Hash of the joined parts; NULL if any part is NULL."""
    return F.sha2(F.concat(*parts), 256)


def number_text(value: Column) -> Column:
    """Decimal text without trailing zeros, so equal numbers give equal keys."""
    plain = value.try_cast("decimal(38,6)").cast("string")
    return F.coalesce(F.regexp_replace(plain, r"\.?0+$", ""), value.cast("string"))


def promotion_code(amount: Column) -> Column:
    return F.coalesce(number_text(amount), F.lit("0"))


def method_code(source_system: Column) -> Column:
    return F.coalesce(source_system, F.lit("unknown"))


def name_uuid(name: Column) -> Column:
    """UUID version 5 of a name in the DNS namespace."""
    digest = F.sha1(F.concat(F.unhex(F.lit(DNS_NAMESPACE)), F.encode(name, "UTF-8")))
    # The variant digit keeps its low two bits and gets binary 10 in front.
    variant = F.lower(
        F.hex(F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8))
    )
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"), variant, F.substring(digest, 18, 3),
        F.lit("-"), F.substring(digest, 21, 12),
    )
