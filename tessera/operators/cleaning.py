"""Operators of the cleaned (silver) layer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import clean_label, clean_label_basic, clean_region
from tessera.operators.dedup import asc, desc, keep_best
from tessera.schemas import CRITICAL_COLUMNS


def require_columns(df: DataFrame, columns=tuple(CRITICAL_COLUMNS)) -> DataFrame:
    """Drop rows where any of ``columns`` is NULL (default: the six critical ones;
    name, region and created_at may be missing)."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def business_rules(df: DataFrame) -> DataFrame:
    """``quantity > 0 AND unit_price >= 0``; NULL fails, NaN price passes."""
    return df.filter((F.col("quantity") > 0) & (F.col("unit_price") >= 0))


def clean_text(df: DataFrame) -> DataFrame:
    """Trim names and regions, upper-case regions, NULL/blank → ``UNKNOWN``."""
    return df.withColumns({"product_name": clean_label("product_name"),
                           "region": clean_region("region")})


def clean_text_basic(df: DataFrame) -> DataFrame:
    """First variant: trim (+ upper for regions); only NULL → ``UNKNOWN``."""
    return df.withColumns({"product_name": clean_label_basic("product_name"),
                           "region": clean_label_basic("region", upper=True)})


def sale_rank():
    """Which copy of a sale survives: newest ``created_at``, then the higher
    price, then the lower product, customer and quantity."""
    return [desc("created_at"), desc("unit_price"), asc("product_id"),
            asc("customer_id"), asc("quantity")]


def dedup_sales(df: DataFrame) -> DataFrame:
    """One row per ``id``, chosen by ``sale_rank`` (deterministic)."""
    return keep_best(df, "id", sale_rank())


def build_silver(bronze: DataFrame, *, strict_reference_order: bool = False) -> DataFrame:
    """Cleaned sales: valid rows only, one per id, normalised text.

    Default order is filter → clean → de-duplicate: the filters are row-local,
    so they run in the scan stage (and reach the CSV or Parquet reader as
    pushed filters) and no id is lost because its arbitrary survivor happened to be
    invalid.  ``strict_reference_order`` de-duplicates first, then filters, which
    reproduces the original order of steps (with a deterministic survivor).
    """
    if strict_reference_order:
        return business_rules(clean_text(require_columns(dedup_sales(bronze))))
    return dedup_sales(clean_text(business_rules(require_columns(bronze))))


def build_silver_basic(bronze: DataFrame) -> DataFrame:
    """First, CSV-era variant: only a missing id drops a row, business rules
    apply, blank text stays blank."""
    return dedup_sales(clean_text_basic(business_rules(require_columns(bronze, ["id"]))))
