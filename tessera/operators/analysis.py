"""Reporting queries over the star schema.

Each one aggregates the fact on its surrogate keys *before* meeting a
dimension, so the join sees one row per key rather than one per sale, and the
dimension side stays as small as the number of distinct keys.  Money is summed
as decimal, so totals are exact and independent of partitioning.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tessera.session import checkpoint_dir

MONEY = DecimalType(38, 2)


def _revenue(col: str = "total_amount"):
    return F.sum(col).cast(MONEY).alias("revenue")


def _measures():
    return [F.count(F.lit(1)).alias("sales"), F.sum("quantity").cast("long").alias("units"),
            _revenue()]


def kpis(fact: DataFrame) -> DataFrame:
    """One row: sales, units, revenue and the average basket (revenue / sales)."""
    return (fact.agg(*_measures())
                .withColumn("avg_basket",
                            F.round(F.try_divide(F.col("revenue"), F.col("sales")), 2).cast(MONEY)))


def by_month(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Totals per month; sales without a known date are the row of nulls, so the
    months add up to ``kpis``."""
    per_day = fact.groupBy("date_key").agg(*_measures())
    return (per_day.join(dim_date.select("date_key", "year", "quarter", "month"), "date_key", "left")
                   .groupBy("year", "quarter", "month")
                   .agg(F.sum("sales").alias("sales"), F.sum("units").cast("long").alias("units"),
                        F.sum("revenue").cast(MONEY).alias("revenue")))


def by_date(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """One row per sale date: the daily series."""
    per_day = fact.groupBy("date_key").agg(*_measures())
    return (per_day.join(dim_date.select("date_key", "full_date"), "date_key", "left")
                   .select("date_key", "full_date", "sales", "units", "revenue"))


def between_dates(fact: DataFrame, first: date, last: date) -> DataFrame:
    """Sales of ``[first, last]``, as a range of ``date_key`` that reaches the
    reader: of a fact clustered by date it opens the files, and reads the row
    groups, of these dates only."""
    low, high = (d.year * 10_000 + d.month * 100 + d.day for d in (first, last))
    return fact.where(F.col("date_key").between(low, high))


def by_key(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """One row per member of a dimension that has sales (every product, every
    customer), with its attributes.  The fact is reduced to one row per key
    first; that result and the dimension are then the same size, so the
    planner shuffles or broadcasts them by their actual sizes."""
    per_key = fact.groupBy(key).agg(*_measures())
    return per_key.join(dim, key, "left").select(*dim.columns, "sales", "units", "revenue")


def by_region(fact: DataFrame, dim_region: DataFrame) -> DataFrame:
    per_key = fact.groupBy("region_key").agg(*_measures())
    return (per_key.join(dim_region, "region_key", "left")
                   .select("region_key", "region_name", "sales", "units", "revenue"))


def top_by_revenue(fact: DataFrame, dim: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The ``n`` keys with the highest revenue (ties: lower key first), with
    their dimension attributes.  The limit is the feature: a top-k report.
    ``orderBy().limit()`` runs as a per-partition top-k and a merge; its at
    most ``n`` rows are checkpointed, so the fact is read once.  The dimension is then filtered by a semi-join against the ``n`` broadcast keys
    (streamed once, never shuffled, however large it is), and the at most
    ``n`` matching rows are joined back to the top-k -- a left join, so a key
    missing from the dimension still shows, with NULL attributes."""
    per_key = fact.groupBy(key).agg(*_measures())
    top = per_key.orderBy(F.col("revenue").desc(), F.col(key).asc()).limit(n)
    checkpoint_dir(fact.sparkSession)
    top = top.checkpoint(eager=True)
    matched = dim.join(F.broadcast(top.select(key)), key, "left_semi")
    return (top.join(F.broadcast(matched), key, "left")
               .select(*dim.columns, "sales", "units", "revenue"))


def region_year_cube(fact: DataFrame, dim_region: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue by region × year with every subtotal (``CUBE``), tagged by
    ``grouping_id`` (0 = detail, 1 = region subtotal, 2 = year subtotal,
    3 = grand total).  Sales without a known date have year null."""
    per_key = fact.groupBy("region_key", "date_key").agg(*_measures())
    years = dim_date.select("date_key", "year")
    detail = (per_key.join(years, "date_key", "left")
                     .join(dim_region, "region_key", "left"))
    return (detail.cube("region_name", "year")
                  .agg(F.grouping_id().cast("int").alias("grouping_level"),
                       F.sum("sales").alias("sales"), F.sum("units").cast("long").alias("units"),
                       F.sum("revenue").cast(MONEY).alias("revenue")))


# --------------------------------------------------------------- sketches ---

# Sizes of the stored sketches, 2^12 registers (1.04 / sqrt(4096),
# 1.6 % standard error) and k = 200 (1.33 % of ranks for one quantile at 99 %).
HLL_LOG_K, KLL_K = 12, 200


def sales_sketches(fact: DataFrame) -> DataFrame:
    """``(date_key, region_key, sales, customers, products, baskets)``: per day
    and region mergeable sketches of the distinct customers and products and of
    the amounts.  One pass with partial sketches on the map side; every larger
    period or area is merged from these rows, without the fact."""
    return fact.groupBy("date_key", "region_key").agg(
        F.count(F.lit(1)).alias("sales"),
        F.hll_sketch_agg("customer_key", HLL_LOG_K).alias("customers"),
        F.hll_sketch_agg("product_key", HLL_LOG_K).alias("products"),
        F.kll_sketch_agg_double(F.col("total_amount").cast("double"), KLL_K).alias("baskets"))


def merged_sketches(sketches: DataFrame, *groups: str, quantiles: tuple[float, ...] = (0.5, 0.9)) -> DataFrame:
    """Stored sketches merged up to ``groups``: sales (exact), distinct customers
    and products and the amounts at ``quantiles`` (approximate).  Groups whose
    sales have no key or amount at all get 0 distinct ones and null amounts."""
    merged = sketches.groupBy(*groups).agg(
        F.sum("sales").alias("sales"), F.hll_union_agg("customers").alias("customers"),
        F.hll_union_agg("products").alias("products"),
        F.kll_merge_agg_double("baskets", KLL_K).alias("baskets"))
    known = F.kll_sketch_get_n_double("baskets") > 0
    amounts = [F.when(known, F.kll_sketch_get_quantile_double("baskets", F.lit(q))).alias(f"amount_p{round(100 * q)}")
               for q in quantiles]
    return merged.select(*groups, "sales", F.hll_sketch_estimate("customers").alias("customers"),
                         F.hll_sketch_estimate("products").alias("products"), *amounts)


def sketch_report(sketches: DataFrame, dim_date: DataFrame, dim_region: DataFrame) -> DataFrame:
    """Distinct customers and products and median baskets per month and region,
    from stored sketches alone."""
    dated = (sketches.join(dim_date.select("date_key", "year", "month"), "date_key", "left")
             .join(dim_region, "region_key", "left"))
    return merged_sketches(dated, "year", "month", "region_name")
