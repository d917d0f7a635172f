"""Star-schema builders: four dimensions with dense surrogate keys and the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import date_key, sale_amount
from tessera.operators.keys import dense_key

# Dimensions whose in-memory size, together, is within this budget are broadcast
# to the fact join; a larger one goes through a shuffle join that AQE can still
# convert (by actual size) or split for skew.
DEFAULT_BROADCAST_BYTES = 128 * 1024 * 1024
# Per-row overhead of a broadcast hash relation (pointers, hash slots).
_ROW_OVERHEAD_BYTES = 16
# Spark's size in bytes per fixed-size column type; decimals up
# to 18 digits are 8 bytes, wider ones 16.
_TYPE_BYTES = {"byte": 1, "boolean": 1, "short": 2, "integer": 4, "float": 4, "date": 4,
               "long": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8,
               # An offset and a length; their bytes are measured.
               "string": 8, "binary": 8}


def _width(data_type) -> int:
    name = data_type.typeName()
    if name == "decimal":
        return 8 if data_type.precision <= 18 else 16
    return _TYPE_BYTES.get(name, 64)


def dim_date(silver: DataFrame) -> DataFrame:
    """One row per sale date that occurs (not a calendar)."""
    d = F.col("full_date")
    return (silver.select(F.col("sale_date").alias("full_date")).distinct()
                  .select(date_key(d).alias("date_key"), d,
                          F.year(d).alias("year"), F.quarter(d).alias("quarter"),
                          F.month(d).alias("month"), F.dayofmonth(d).alias("day")))


def product_names(silver: DataFrame) -> DataFrame:
    """The distinct (product, name) pairs: two hashed columns, so all but a row
    per pair and task is gone before any string is compared or shuffled."""
    return silver.select("product_id", "product_name").distinct()


def dim_product(silver: DataFrame, *, partitions: int | None = None) -> DataFrame:
    """One row per product with its (single, gate-checked) name and a dense key.

    ``min`` picks the name: equal to any other choice once the mapping gate has
    passed, and deterministic when it has not."""
    base = product_names(silver).groupBy("product_id").agg(F.min("product_name").alias("product_name"))
    return dense_key(base, "product_id", "product_key", partitions=partitions) \
        .select("product_key", "product_id", "product_name")


def dim_customer(silver: DataFrame, *, partitions: int | None = None) -> DataFrame:
    base = silver.select("customer_id").distinct()
    return dense_key(base, "customer_id", "customer_key", partitions=partitions) \
        .select("customer_key", "customer_id")


def dim_region(silver: DataFrame, *, partitions: int | None = None) -> DataFrame:
    base = silver.select(F.col("region").alias("region_name")).distinct()
    return dense_key(base, "region_name", "region_key", partitions=partitions) \
        .select("region_key", "region_name")


def estimated_bytes(df: DataFrame, rows: int, string_bytes: int = 0) -> int:
    """In-memory size of ``rows`` rows of ``df``'s columns as a broadcast hash
    relation: Spark's width per fixed-size column type, the measured bytes of
    all strings, and a fixed overhead per row."""
    width = sum(_width(f.dataType) for f in df.schema.fields) + _ROW_OVERHEAD_BYTES
    return rows * width + string_bytes


def measured_bytes(side: DataFrame, rows: int | None = None) -> int:
    """``estimated_bytes`` with what it needs counted: one small aggregate over
    a stored dimension, none when its ``rows`` are known and it has no strings."""
    strings = [F.sum(F.octet_length(f.name)) for f in side.schema.fields
               if f.dataType.typeName() in ("string", "binary")]
    if rows is not None and not strings:
        return estimated_bytes(side, rows)
    total = sum((F.coalesce(x, F.lit(0)) for x in strings), F.lit(0)).cast("long")
    found = side.agg(F.count(F.lit(1)).alias("n"), total.alias("b")).first()
    return estimated_bytes(side, found["n"], found["b"])


def within_budget(sizes: dict[str, int], max_bytes: int = DEFAULT_BROADCAST_BYTES) -> set[str]:
    """The names that share one broadcast budget; the smallest get theirs first."""
    left, fit = max_bytes, set()
    for name in sorted(sizes, key=sizes.get):
        if sizes[name] <= left:
            fit.add(name)
            left -= sizes[name]
    return fit


def lookup_key(fact: DataFrame, dim: DataFrame, fact_col: str, dim_col: str, key: str, *,
               dim_rows: int | None = None, dim_bytes: int | None = None,
               max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``fact LEFT JOIN dim ON fact_col = dim_col``, adding ``key``.

    The dimension is broadcast only when the measured size of the two columns
    shipped (``dim_bytes`` if given) is within ``max_broadcast_bytes``.  Beyond
    that the join shuffles on the natural key, and AQE splits a hot key's
    partition (``spark.sql.adaptive.skewJoin``).  A NULL natural key never
    matches, so it keeps a NULL surrogate key.
    """
    side = dim.select(F.col(dim_col).alias("_nk"), F.col(key))
    if dim_bytes is None:
        dim_bytes = measured_bytes(side, dim_rows)
    if dim_bytes <= max_broadcast_bytes:
        side = F.broadcast(side)
    return fact.join(side, fact[fact_col] == side["_nk"], "left").drop("_nk")


def in_date_ranges(silver: DataFrame) -> DataFrame:
    """The cleaned sales dealt to tasks by ranges of their date, by id within a
    date, so a date with a third of all sales is spread over several tasks.
    Broadcast lookups keep the ranges: ``fact_sales`` of this, sorted within
    its partitions, has files and row groups of few dates each."""
    return silver.repartitionByRange("sale_date", "id")


def fact_sales(silver: DataFrame, product: DataFrame, customer: DataFrame, region: DataFrame,
               *, dates: DataFrame | None = None, dim_rows: dict | None = None,
               max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """One fact row per cleaned sale, keyed to the four dimensions.

    ``date_key`` is a pure function of the date, so by default it is computed,
    not joined; pass ``dates`` to look it up in ``dim_date`` instead (same
    result for dates that occur, NULL otherwise).
    """
    rows = dim_rows or {}
    lookups = [("dim_product", product, "product_id", "product_id", "product_key"),
               ("dim_customer", customer, "customer_id", "customer_id", "customer_key"),
               ("dim_region", region, "region", "region_name", "region_key")]
    if dates is not None:
        lookups.insert(0, ("dim_date", dates, "sale_date", "full_date", "date_key"))
    sizes = {name: measured_bytes(dim.select(col, key), rows.get(name)) for name, dim, _, col, key in lookups}
    f = silver if dates is not None else silver.withColumn("date_key", date_key("sale_date"))
    fit = within_budget(sizes, max_broadcast_bytes)
    for name, dim, fact_col, col, key in lookups:
        f = lookup_key(f, dim, fact_col, col, key, dim_bytes=sizes[name],
                       max_broadcast_bytes=max_broadcast_bytes if name in fit else -1)
    return f.select(
        F.col("id").alias("sale_id"), "date_key", "product_key", "customer_key", "region_key",
        "quantity", "unit_price", sale_amount("quantity", "unit_price").alias("total_amount"),
        "created_at")
