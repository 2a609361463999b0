"""Deterministic identifiers as column expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_NAMESPACE = str(uuid.NAMESPACE_URL)


def uuid5(name: Column, namespace: str = DEFAULT_NAMESPACE) -> Column:
    """RFC 4122 version 5 UUID of a string column, computed JVM-side."""
    digest = F.sha1(F.concat(F.lit(uuid.UUID(namespace).bytes), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


def has_id(source: Column, source_id: Column) -> Column:
    return (F.coalesce(source, F.lit("")) != "") & (F.coalesce(source_id, F.lit("")) != "")


def review_id(source: Column, source_id: Column, namespace: str = DEFAULT_NAMESPACE) -> Column:
    """UUIDv5 over ``source|source_id``; NULL when either part is empty or NULL."""
    return F.when(has_id(source, source_id), uuid5(F.concat(source, F.lit("|"), source_id), namespace))


def row_id(run_id: Column, source_path: Column, row_number: Column) -> Column:
    """Reproducible row id, for runs that must be repeatable."""
    return F.md5(F.concat_ws("|", run_id, source_path, row_number.cast("string")))
