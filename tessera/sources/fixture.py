"""The raw (``bronze``) sales records derived from the star-schema test tables.

The test folders hold clean TPC-H-like tables; the pipeline needs a raw sales
feed with the usual dirt (missing values, blanks, padding, lower case, invalid
quantities and prices, several versions of one sale).  Dirt is a pure function
of the keys, so every engine derives the same rows; the SQL text in
``tessera.plans.oracle`` is the same rule for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.keys import checked_int
from tessera.operators.star import DEFAULT_BROADCAST_BYTES, measured_bytes, within_budget
from tessera.sources.tables import load

#: The tables that the raw feed is derived from.
FEED_TABLES = ("lineitem", "orders", "part", "customer", "nation", "region")


def bronze_from_tables(spark: SparkSession, root: str, *,
                       max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Raw sales rows (9 columns of the sales schema) at the scale of ``lineitem``.

    Join plan: the customer → nation → region chain is reduced to one
    ``(c_custkey, r_name)`` table before it meets ``orders``; only the columns
    used reach the scans (Catalyst prunes them), and what is needed of a
    supplier is worked out there.  That table and the part names are broadcast
    when their measured size is within ``max_broadcast_bytes`` together, so
    that ``lineitem`` is shuffled for ``orders`` alone; beyond that the planner
    sizes these equi-joins itself (sort-merge with AQE skew splitting).
    """
    sk = F.col("l_suppkey")
    li = load(spark, root, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate",
        (sk % 5 == 0).alias("padded"),
        F.when(sk % 83 == 0, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).alias("unit_price"))
    orders = load(spark, root, "orders").select("o_orderkey", "o_custkey")
    part = load(spark, root, "part").select("p_partkey", "p_name")
    customer = load(spark, root, "customer").select("c_custkey", "c_nationkey")
    nation = load(spark, root, "nation").select("n_nationkey", "n_regionkey")
    region = load(spark, root, "region").select("r_regionkey", "r_name")

    cust_region = (customer
                   .join(nation, customer.c_nationkey == nation.n_nationkey)
                   .join(region, nation.n_regionkey == region.r_regionkey)
                   .select("c_custkey", "r_name"))
    sides = {"part": part, "cust_region": cust_region}
    fit = within_budget({n: measured_bytes(side) for n, side in sides.items()}, max_broadcast_bytes)
    part, cust_region = (F.broadcast(side) if n in fit else side for n, side in sides.items())
    order_region = (orders.join(cust_region, F.col("o_custkey") == F.col("c_custkey"))
                    .select("o_orderkey", "o_custkey", "r_name"))
    rows = (li.join(order_region, li.l_orderkey == order_region.o_orderkey)
              .join(part, F.col("l_partkey") == F.col("p_partkey")))

    raw_id = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    pk, ck, ln = F.col("l_partkey"), F.col("o_custkey"), F.col("l_linenumber")
    return rows.select(
        checked_int(raw_id, "id").alias("id"),
        F.when(raw_id % 97 == 0, F.lit(None)).otherwise(F.col("l_shipdate").cast("date"))
         .alias("sale_date"),
        checked_int(pk, "product_id").alias("product_id"),
        F.when(pk % 100 == 0, F.lit(None).cast("string"))
         .when(pk % 50 == 0, F.lit("  "))
         .when(F.col("padded"), F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")))
         .otherwise(F.col("p_name")).alias("product_name"),
        checked_int(ck, "customer_id").alias("customer_id"),
        F.when(ck % 41 == 0, F.lit(None).cast("string"))
         .when(ck % 43 == 0, F.lit(" "))
         .when(ln == 2, F.concat(F.lit(" "), F.lower(F.col("r_name"))))
         .otherwise(F.col("r_name")).alias("region"),
        F.when((pk % 71 == 0) & (ln == 1), F.lit(0))
         .otherwise(F.col("l_quantity").cast("int")).alias("quantity"),
        "unit_price",
        F.col("l_shipdate").alias("created_at"),
    )
