"""Independent SQL for every catalog query (DuckDB dialect, plain ANSI where
possible), over the raw test tables.  The layers are CTEs written from the
rules, not generated from the Spark plans, so the two sides only agree when
both are right."""

from __future__ import annotations

# The raw feed: dirt injected by key arithmetic (same rule as
# tessera.sources.fixture.bronze_from_tables).
BRONZE = """bronze AS (
  SELECT CAST(l.l_orderkey*10 + l.l_linenumber AS INTEGER) AS id,
    CASE WHEN (l.l_orderkey*10 + l.l_linenumber) % 97 = 0 THEN NULL
         ELSE CAST(l.l_shipdate AS DATE) END AS sale_date,
    CAST(l.l_partkey AS INTEGER) AS product_id,
    CASE WHEN l.l_partkey % 100 = 0 THEN NULL WHEN l.l_partkey % 50 = 0 THEN '  '
         WHEN l.l_suppkey % 5 = 0 THEN concat('  ', p.p_name, ' ') ELSE p.p_name END AS product_name,
    CAST(o.o_custkey AS INTEGER) AS customer_id,
    CASE WHEN o.o_custkey % 41 = 0 THEN NULL WHEN o.o_custkey % 43 = 0 THEN ' '
         WHEN l.l_linenumber = 2 THEN concat(' ', lower(r.r_name)) ELSE r.r_name END AS region,
    CASE WHEN l.l_partkey % 71 = 0 AND l.l_linenumber = 1 THEN 0
         ELSE CAST(l.l_quantity AS INTEGER) END AS quantity,
    CASE WHEN l.l_suppkey % 83 = 0 THEN -l.l_extendedprice ELSE l.l_extendedprice END AS unit_price,
    l.l_shipdate AS created_at
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN part p ON l.l_partkey = p.p_partkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey)"""

COLS = "id, sale_date, product_id, product_name, customer_id, region, quantity, unit_price, created_at"

CRITICAL = ("id IS NOT NULL AND sale_date IS NOT NULL AND product_id IS NOT NULL "
            "AND customer_id IS NOT NULL AND quantity IS NOT NULL AND unit_price IS NOT NULL")
BUSINESS = "quantity > 0 AND unit_price >= 0"
NAME_RULE = ("CASE WHEN product_name IS NULL OR trim(product_name) = '' THEN 'UNKNOWN' "
             "ELSE trim(product_name) END")
REGION_RULE = ("CASE WHEN region IS NULL OR trim(region) = '' THEN 'UNKNOWN' "
               "ELSE upper(trim(region)) END")
NAME_BASIC = "CASE WHEN product_name IS NULL THEN 'UNKNOWN' ELSE trim(product_name) END"
REGION_BASIC = "CASE WHEN region IS NULL THEN 'UNKNOWN' ELSE upper(trim(region)) END"
# The surviving copy of a sale: newest, dearest, lowest product/customer/quantity,
# then the remaining columns (descending) so only equal rows tie.
SURVIVOR = ("ORDER BY created_at DESC NULLS LAST, unit_price DESC NULLS LAST, "
            "product_id ASC NULLS LAST, customer_id ASC NULLS LAST, quantity ASC NULLS LAST, "
            "sale_date DESC NULLS LAST, product_name DESC NULLS LAST, region DESC NULLS LAST")


def dedup(source: str) -> str:
    return (f"SELECT {COLS} FROM (SELECT *, row_number() OVER (PARTITION BY id {SURVIVOR}) AS rn "
            f"FROM {source}) WHERE rn = 1")


CLEANED = (f"cleaned AS (SELECT id, sale_date, product_id, {NAME_RULE} AS product_name, customer_id, "
           f"{REGION_RULE} AS region, quantity, unit_price, created_at FROM bronze "
           f"WHERE {CRITICAL} AND {BUSINESS})")
SILVER = f"silver AS ({dedup('cleaned')})"

DATE_KEY = "CAST(year({d})*10000 + month({d})*100 + day({d}) AS INTEGER)"

DIM_DATE = ("dim_date AS (SELECT " + DATE_KEY.format(d="full_date") + " AS date_key, full_date, "
            "CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter, "
            "CAST(month(full_date) AS INTEGER) AS month, CAST(day(full_date) AS INTEGER) AS day "
            "FROM (SELECT DISTINCT sale_date AS full_date FROM silver) t)")
DIM_PRODUCT = ("dim_product AS (SELECT CAST(row_number() OVER (ORDER BY product_id) AS INTEGER) "
               "AS product_key, product_id, product_name FROM (SELECT product_id, "
               "min(product_name) AS product_name FROM silver GROUP BY product_id) t)")
DIM_CUSTOMER = ("dim_customer AS (SELECT CAST(row_number() OVER (ORDER BY customer_id) AS INTEGER) "
                "AS customer_key, customer_id FROM (SELECT DISTINCT customer_id FROM silver) t)")
DIM_REGION = ("dim_region AS (SELECT CAST(row_number() OVER (ORDER BY region_name) AS INTEGER) "
              "AS region_key, region_name FROM (SELECT DISTINCT region AS region_name FROM silver) t)")
FACT = ("fact AS (SELECT s.id AS sale_id, " + DATE_KEY.format(d="s.sale_date") + " AS date_key, "
        "p.product_key, c.customer_key, r.region_key, s.quantity, s.unit_price, "
        "CAST(round(s.quantity * s.unit_price, 2) AS DECIMAL(18,2)) AS total_amount, s.created_at "
        "FROM silver s LEFT JOIN dim_product p ON s.product_id = p.product_id "
        "LEFT JOIN dim_customer c ON s.customer_id = c.customer_id "
        "LEFT JOIN dim_region r ON s.region = r.region_name)")

_CTES = {
    "bronze": (BRONZE, ()),
    "cleaned": (CLEANED, ("bronze",)),
    "silver": (SILVER, ("cleaned",)),
    "dim_date": (DIM_DATE, ("silver",)),
    "dim_product": (DIM_PRODUCT, ("silver",)),
    "dim_customer": (DIM_CUSTOMER, ("silver",)),
    "dim_region": (DIM_REGION, ("silver",)),
    "fact": (FACT, ("dim_product", "dim_customer", "dim_region")),
}


def with_layers(*names: str) -> str:
    """``WITH`` clause holding the named layers and everything they need."""
    order: list[str] = []

    def visit(n: str):
        if n in order:
            return
        for dep in _CTES[n][1]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(_CTES[n][0] for n in order) + "\n"
