"""Column-level functions: pure ``Column -> Column`` builders, all JVM-side."""

from tessera.functions.columns import (
    UNKNOWN,
    blank_or_null,
    clean_label,
    clean_label_basic,
    clean_region,
    date_key,
    sale_amount,
)

__all__ = [
    "UNKNOWN",
    "blank_or_null",
    "clean_label",
    "clean_label_basic",
    "clean_region",
    "date_key",
    "sale_amount",
]
