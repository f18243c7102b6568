"""Reusable ``Column`` builders; every one stays a JVM-side built-in expression."""

from arenaflow.functions.columns import (
    FIELD_SEPARATOR,
    compact_to_iso,
    compact_to_iso_checked,
    date_key,
    date_range,
    first_valid,
    iso_to_compact,
    month_key,
    null_to_empty,
    number_text,
    pack,
    pack_record,
    plain_decimal,
    python_whitespace_class,
    valid_version,
    valid_version_ws,
)

__all__ = [
    "FIELD_SEPARATOR",
    "compact_to_iso",
    "compact_to_iso_checked",
    "date_key",
    "date_range",
    "first_valid",
    "iso_to_compact",
    "month_key",
    "null_to_empty",
    "number_text",
    "pack",
    "pack_record",
    "plain_decimal",
    "python_whitespace_class",
    "valid_version",
    "valid_version_ws",
]
