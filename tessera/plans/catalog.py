"""Named queries: each a Spark builder ``(spark, root) -> DataFrame`` paired with
the independent SQL that must give the same rows.

Every query reads the whole test tables of ``root`` (no id subsets, no row
caps); the only limits are the top-k reports and the preview, where the limit
is the feature.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import analysis, cleaning, quality, star
from tessera.plans import jobs
from tessera.plans import oracle as sql
from tessera.plans.layers import Layers, Published
from tessera.schemas import SALES_COLUMNS, STAR_TABLES, sales_schema
from tessera.sinks.drops import write_drop
from tessera.sinks.tables import scratch_path, store
from tessera.sources.files import latest_drop, read_bronze, read_drops
from tessera.sources.tables import load

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
SQL: dict[str, str] = {}


def query(name: str, oracle: str | None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            SQL[name] = oracle
        return fn
    return register


def _union_layers(parts: dict[str, DataFrame]) -> DataFrame:
    out = None
    for layer, df in parts.items():
        tagged = df.select(F.lit(layer).alias("layer"), *df.columns)
        out = tagged if out is None else out.unionByName(tagged)
    return out


# ---------------------------------------------------------------- sources ---

@query("source_extract", sql.with_layers("bronze") + f"SELECT {sql.COLS} FROM bronze ORDER BY id")
def source_extract(spark, root):
    """The full source snapshot in id order (what a drop is written from)."""
    return Layers(spark, root).bronze.orderBy("id")


@query("bronze_scan", sql.with_layers("bronze") + f"SELECT {sql.COLS} FROM bronze")
def bronze_scan(spark, root):
    """Raw feed written as a CSV drop (into the shared checkpoint folder), then
    read back with the explicit schema."""
    path = write_drop(Layers(spark, root).bronze, scratch_path(spark, "drops"))
    return read_bronze(spark, path, schema=sales_schema(timestamp_ntz=True))


def _two_drops(spark, root) -> str:
    """Folder of two drops on two dates: every second sale, then all."""
    folder = scratch_path(spark, "drops")
    feed = Layers(spark, root).bronze
    write_drop(feed.where("id % 2 = 0"), folder, now=datetime(2024, 1, 1, tzinfo=timezone.utc))
    write_drop(feed, folder, now=datetime(2024, 1, 2, tzinfo=timezone.utc))
    return folder


@query("bronze_scan_split", sql.with_layers("bronze") + f"SELECT {sql.COLS} FROM bronze")
def bronze_scan_split(spark, root):
    """The newest of two drops, its files split between tasks (no field of the
    feed holds a line break)."""
    return read_bronze(spark, latest_drop(spark, _two_drops(spark, root)),
                       schema=sales_schema(timestamp_ntz=True), multiline=False)


@query("bronze_scan_inferred", sql.with_layers("bronze") + "SELECT count(*) AS rows, "
       "CAST(sum(id) AS BIGINT) AS ids, CAST(sum(quantity) AS BIGINT) AS quantities, "
       "min(sale_date) AS first_date, max(sale_date) AS last_date, "
       "count(DISTINCT product_id) AS products FROM bronze")
def bronze_scan_inferred(spark, root):
    """A drop with its types inferred: numbers add up, dates compare."""
    path = write_drop(Layers(spark, root).bronze, scratch_path(spark, "drops"))
    return read_bronze(spark, path, schema=None).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("id").cast("long").alias("ids"),
        F.sum("quantity").cast("long").alias("quantities"), F.min("sale_date").alias("first_date"),
        F.max("sale_date").alias("last_date"), F.count_distinct("product_id").alias("products"))


@query("bronze_drops", sql.with_layers("bronze")
       + "SELECT DATE '2024-01-01' AS ingestion_date, count(*) FILTER (WHERE id % 2 = 0) AS rows, "
         "CAST(sum(id) FILTER (WHERE id % 2 = 0) AS BIGINT) AS ids FROM bronze UNION ALL "
         "SELECT DATE '2024-01-02', count(*), CAST(sum(id) AS BIGINT) FROM bronze")
def bronze_drops(spark, root):
    """Rows per dated drop folder."""
    found = read_drops(spark, _two_drops(spark, root), schema=sales_schema(timestamp_ntz=True))
    return found.groupBy("ingestion_date").agg(F.count(F.lit(1)).alias("rows"),
                                               F.sum("id").cast("long").alias("ids"))


@query("drop_validation", sql.with_layers("bronze")
       + "SELECT (SELECT count(*) FROM bronze) AS rows, count(*) AS inconsistent_products FROM (SELECT product_id "
         "FROM bronze GROUP BY product_id HAVING count(DISTINCT product_name) > 1) t")
def drop_validation(spark, root):
    """The validation job on the newest drop; its product names differ by
    padding, so the gate reports them."""
    cfg = jobs.PipelineConfig(bronze_root=_two_drops(spark, root), silver_path="", gold_root="")
    return jobs.drop_checks(spark, latest_drop(spark, cfg.bronze_root), cfg)


#: Text that no value of the column can be read from, and the ids it is put in.
_BAD_FIELDS = {"quantity": ("many", 53), "sale_date": ("soon", 59), "created_at": ("then", 61)}


@query("drop_quarantine", sql.with_layers("bronze") + "\nUNION ALL\n".join(
    [f"SELECT 'bad_{c}' AS reason, count(*) AS rows FROM bronze WHERE id % {n} = 0" for c, (_, n) in _BAD_FIELDS.items()]
    + ["SELECT 'any', count(*) FROM bronze WHERE "
       + " OR ".join(f"id % {n} = 0" for _, n in _BAD_FIELDS.values()),
       f"SELECT 'cleaned', count(DISTINCT id) FROM bronze WHERE {sql.CRITICAL} AND {sql.BUSINESS} AND id % 53 <> 0 "
       "AND id % 59 <> 0"]))
def drop_quarantine(spark, root):
    """A drop with unparsable numbers, dates and times: the cleaning job keeps
    their records, with the reasons, beside the cleaned table."""
    lake = scratch_path(spark, "lake")
    cfg = jobs.PipelineConfig(bronze_root=f"{lake}/bronze", silver_path=f"{lake}/silver", gold_root=f"{lake}/gold",
                              bronze_schema=sales_schema(timestamp_ntz=True), quarantine_path=f"{lake}/quarantine")
    feed = Layers(spark, root).bronze
    spoiled = feed.withColumns({c: F.when(F.col("id") % n == 0, F.lit(text)).otherwise(F.col(c).cast("string"))
                                for c, (text, n) in _BAD_FIELDS.items()})
    jobs.ingest(spoiled, cfg)
    jobs.bronze_to_silver(spark, cfg)
    stored = spark.read.parquet(cfg.quarantine_path)
    reasons = stored.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
    for name, df in (("any", stored), ("cleaned", jobs.read_published(spark, cfg, "sales"))):
        reasons = reasons.unionByName(df.agg(F.count(F.lit(1)).alias("rows")).withColumn("reason", F.lit(name)))
    return reasons


@query("job_pipeline", sql.with_layers("fact", "dim_date") + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, count(*) AS rows FROM {src}" for name, src in (
        ("sales", "silver"), ("dim_date", "dim_date"), ("dim_product", "dim_product"),
        ("dim_customer", "dim_customer"), ("dim_region", "dim_region"), ("fact_sales", "fact"))))
def job_pipeline(spark, root):
    """Drop, cleaned table, star: the whole chain of jobs over CSV drops, run
    twice so that published tables are replaced, then read back."""
    lake = scratch_path(spark, "lake")
    cfg = jobs.PipelineConfig(bronze_root=f"{lake}/bronze", silver_path=f"{lake}/silver", gold_root=f"{lake}/gold",
                              bronze_schema=sales_schema(timestamp_ntz=True))
    feed = Layers(spark, root).bronze
    jobs.ingest(feed.where("id % 2 = 0"), cfg, now=datetime(2024, 1, 1, tzinfo=timezone.utc))
    jobs.run_pipeline(spark, cfg)
    jobs.ingest(feed, cfg, now=datetime(2024, 1, 2, tzinfo=timezone.utc))
    jobs.run_pipeline(spark, cfg)
    return _row_counts({t: jobs.read_published(spark, cfg, t) for t in ("sales", *STAR_TABLES)})


@query("job_pipeline_set", sql.with_layers("fact", "dim_date") + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, count(*) AS rows, count(*) AS keyed_sales FROM {src}" if name == "fact_sales" else
    f"SELECT '{name}' AS table_name, count(*) AS rows, (SELECT count(*) FROM fact JOIN {src} USING ({key})) "
    f"AS keyed_sales FROM {src}" for name, src, key in (
        ("dim_date", "dim_date", "date_key"), ("dim_product", "dim_product", "product_key"),
        ("dim_customer", "dim_customer", "customer_key"), ("dim_region", "dim_region", "region_key"),
        ("fact_sales", "fact", ""))))
def job_pipeline_set(spark, root):
    """The star published as one set, twice: its tables by one reading of the
    pointer, and the sales that find their row in each dimension of that run."""
    lake = scratch_path(spark, "lake")
    cfg = jobs.PipelineConfig(bronze_root=f"{lake}/bronze", silver_path=f"{lake}/silver", gold_root=f"{lake}/gold",
                              star_as_set=True)
    feed = Layers(spark, root).bronze
    for part in (feed.where("id % 2 = 0"), feed):
        jobs.bronze_to_silver(spark, cfg, bronze=part)
        jobs.silver_to_gold(spark, cfg)
    tables = jobs.read_star(spark, cfg)
    fact = tables["fact_sales"]
    out = None
    for name, df in tables.items():
        key = name.removeprefix("dim_") + "_key"
        keyed = fact.join(df.select(key), key) if name.startswith("dim_") else fact
        row = quality.side_by_side({"rows": _rows(df), "keyed_sales": _rows(keyed)}).select(
            F.lit(name).alias("table_name"), "rows", "keyed_sales")
        out = row if out is None else out.unionByName(row)
    return out


@query("gate_duplicate_ids_bucketed", sql.with_layers("silver")
       + "SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT id FROM silver GROUP BY id HAVING count(*) > 1) t) "
         "AS duplicate_ids, (SELECT count(DISTINCT id) FROM silver) AS rows_after_dedup FROM silver")
def gate_duplicate_ids_bucketed(spark, root):
    """The cleaned catalog table, bucketed by id: the duplicate gate and another
    de-duplication, both without a shuffle of the ids."""
    lake, name = scratch_path(spark, "lake"), f"lake_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{lake}/db'")
    cfg = jobs.PipelineConfig(bronze_root=f"{lake}/bronze", silver_path=f"{lake}/silver", gold_root=f"{lake}/gold",
                              catalog=name)
    jobs.bronze_to_silver(spark, cfg, bronze=Layers(spark, root).bronze)
    sales = jobs.read_published(spark, cfg, "sales")
    return quality.side_by_side({"rows": _rows(sales), "duplicate_ids": quality.duplicate_keys(sales, "id"),
                                 "rows_after_dedup": _rows(cleaning.dedup_sales(sales))})


# ----------------------------------------------------------------- silver ---

@query("silver_dedup", sql.with_layers("bronze") + sql.dedup("bronze"))
def silver_dedup(spark, root):
    return cleaning.dedup_sales(Layers(spark, root).bronze)


@query("silver_critical_nulls",
       sql.with_layers("bronze") + f"SELECT {sql.COLS} FROM bronze WHERE {sql.CRITICAL}")
def silver_critical_nulls(spark, root):
    return cleaning.require_columns(Layers(spark, root).bronze)


@query("silver_business_rules",
       sql.with_layers("bronze") + f"SELECT {sql.COLS} FROM bronze WHERE {sql.BUSINESS}")
def silver_business_rules(spark, root):
    return cleaning.business_rules(Layers(spark, root).bronze)


@query("silver_text_clean", sql.with_layers("bronze")
       + f"SELECT id, sale_date, product_id, {sql.NAME_RULE} AS product_name, customer_id, "
         f"{sql.REGION_RULE} AS region, quantity, unit_price, created_at FROM bronze")
def silver_text_clean(spark, root):
    return cleaning.clean_text(Layers(spark, root).bronze)


@query("silver_basic", sql.with_layers("bronze")
       + "SELECT * FROM (" + sql.dedup(
           f"(SELECT id, sale_date, product_id, {sql.NAME_BASIC} AS product_name, customer_id, "
           f"{sql.REGION_BASIC} AS region, quantity, unit_price, created_at FROM bronze "
           f"WHERE id IS NOT NULL AND {sql.BUSINESS})") + ")")
def silver_basic(spark, root):
    return cleaning.build_silver_basic(Layers(spark, root).bronze)


@query("silver_sales", sql.with_layers("silver") + f"SELECT {sql.COLS} FROM silver")
def silver_sales(spark, root):
    return Layers(spark, root).silver


@query("silver_strict_order", sql.with_layers("bronze")
       + f"SELECT id, sale_date, product_id, {sql.NAME_RULE} AS product_name, customer_id, "
         f"{sql.REGION_RULE} AS region, quantity, unit_price, created_at FROM ("
       + sql.dedup("bronze") + f") d WHERE {sql.CRITICAL} AND {sql.BUSINESS}")
def silver_strict_order(spark, root):
    return cleaning.build_silver(Layers(spark, root).bronze, strict_reference_order=True)


# ------------------------------------------------------------ silver gates ---

def _per_layer_sql(select: str, layers=("bronze", "silver")) -> str:
    return sql.with_layers(*layers) + "\nUNION ALL\n".join(
        select.format(layer=l) for l in layers)


def _rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


@query("report_rows_removed", sql.with_layers("silver")
       + "SELECT b.n AS bronze_rows, s.n AS silver_rows, b.n - s.n AS rows_removed "
         "FROM (SELECT count(*) AS n FROM bronze) b, (SELECT count(*) AS n FROM silver) s")
def report_rows_removed(spark, root):
    lay = Layers(spark, root)
    both = quality.side_by_side({"bronze_rows": _rows(lay.bronze), "silver_rows": _rows(lay.silver)})
    return both.withColumn("rows_removed", F.col("bronze_rows") - F.col("silver_rows"))


@query("report_duplicates_removed", sql.with_layers("bronze")
       + "SELECT count(*) AS rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT id FROM bronze) t) "
         "AS duplicates_removed FROM bronze")
def report_duplicates_removed(spark, root):
    b = Layers(spark, root).bronze
    per_id = b.groupBy("id").agg(F.count(F.lit(1)).alias("_n"))
    return per_id.agg(F.sum("_n").cast("long").alias("rows"),
                      (F.sum("_n") - F.count(F.lit(1))).cast("long").alias("duplicates_removed"))


@query("gate_duplicate_ids", _per_layer_sql(
    "SELECT '{layer}' AS layer, count(*) AS duplicate_ids FROM "
    "(SELECT id FROM {layer} GROUP BY id HAVING count(*) > 1) t"))
def gate_duplicate_ids(spark, root):
    lay = Layers(spark, root)
    return _union_layers({l: quality.duplicate_keys(getattr(lay, l), "id", "duplicate_ids")
                          for l in ("bronze", "silver")})


@query("gate_invalid_quantity", _per_layer_sql(
    "SELECT '{layer}' AS layer, count(*) FILTER (WHERE quantity <= 0) AS invalid_quantity FROM {layer}"))
def gate_invalid_quantity(spark, root):
    lay = Layers(spark, root)
    return _union_layers({l: quality.count_violations(getattr(lay, l), [quality.invalid_quantity()],
                                                      rows=None) for l in ("bronze", "silver")})


@query("gate_invalid_price", _per_layer_sql(
    "SELECT '{layer}' AS layer, count(*) FILTER (WHERE unit_price < 0) AS invalid_price FROM {layer}"))
def gate_invalid_price(spark, root):
    lay = Layers(spark, root)
    return _union_layers({l: quality.count_violations(getattr(lay, l), [quality.invalid_price()],
                                                      rows=None) for l in ("bronze", "silver")})


@query("gate_inconsistent_products", _per_layer_sql(
    "SELECT '{layer}' AS layer, count(*) AS inconsistent_products FROM (SELECT product_id FROM {layer} "
    "GROUP BY product_id HAVING count(DISTINCT product_name) > 1) t"))
def gate_inconsistent_products(spark, root):
    lay = Layers(spark, root)
    return _union_layers({l: quality.inconsistent_mappings(getattr(lay, l), "product_id", "product_name",
                                                           "inconsistent_products")
                          for l in ("bronze", "silver")})


@query("silver_row_checks", _per_layer_sql(
    "SELECT '{layer}' AS layer, count(*) AS rows, count(*) FILTER (WHERE quantity <= 0) AS invalid_quantity, "
    "count(*) FILTER (WHERE unit_price < 0) AS invalid_price FROM {layer}"))
def silver_row_checks(spark, root):
    """All row-level gates of a layer from one scan."""
    lay = Layers(spark, root)
    checks = [f() for f in quality.SALES_ROW_CHECKS]
    return _union_layers({l: quality.count_violations(getattr(lay, l), checks)
                          for l in ("bronze", "silver")})


@query("null_profile", sql.with_layers("bronze") + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM bronze"
    for c in SALES_COLUMNS))
def null_profile(spark, root):
    return quality.null_profile(Layers(spark, root).bronze)


_MAPPING_SQL = (
    "pairs AS (SELECT {key}, {value}, count(*) AS row_count FROM {src} "
    "WHERE {value} IS NOT NULL GROUP BY {key}, {value}), "
    "bad AS (SELECT {key}, count(*) AS {n} FROM pairs GROUP BY {key} HAVING count(*) > 1) "
    "SELECT p.{key}, b.{n}, p.{value}, p.row_count FROM pairs p JOIN bad b ON p.{key} = b.{key} "
    "ORDER BY b.{n} DESC, p.{key}, p.{value}")
_MAPPING_MAX_SQL = (
    "SELECT CAST(max(n) AS BIGINT) AS {alias} FROM (SELECT {key}, count(DISTINCT {value}) AS n "
    "FROM {src} GROUP BY {key}) t WHERE n > 1")


@query("diagnose_mapping", sql.with_layers("bronze").rstrip("\n") + ",\n" + _MAPPING_SQL.format(
    key="product_id", value="product_name", src="bronze", n="name_count"))
def diagnose_mapping(spark, root):
    """Raw names per product (padding and blanks make several)."""
    return quality.mapping_report(Layers(spark, root).bronze, "product_id", "product_name",
                                  count_alias="name_count", rows_alias="row_count")


@query("diagnose_mapping_max", sql.with_layers("bronze") + _MAPPING_MAX_SQL.format(
    key="product_id", value="product_name", src="bronze", alias="max_names"))
def diagnose_mapping_max(spark, root):
    return quality.mapping_report_max(Layers(spark, root).bronze, "product_id", "product_name")


@query("diagnose_mapping_part", "WITH " + _MAPPING_SQL.format(
    key="p_name", value="p_brand", src="part", n="brand_count"))
def diagnose_mapping_part(spark, root):
    """The same diagnosis on a clean catalogue: part names sold under several brands."""
    return quality.mapping_report(load(spark, root, "part"), "p_name", "p_brand",
                                  count_alias="brand_count", rows_alias="row_count")


@query("diagnose_mapping_part_max", _MAPPING_MAX_SQL.format(
    key="p_name", value="p_brand", src="part", alias="max_brands"))
def diagnose_mapping_part_max(spark, root):
    return quality.mapping_report_max(load(spark, root, "part"), "p_name", "p_brand", "max_brands")


# ------------------------------------------------------------------- gold ---

@query("gold_dim_date", sql.with_layers("dim_date") + "SELECT * FROM dim_date")
def gold_dim_date(spark, root):
    return Published(spark, root).dim_date


@query("gold_dim_product", sql.with_layers("dim_product") + "SELECT * FROM dim_product")
def gold_dim_product(spark, root):
    return Published(spark, root).dim_product


@query("gold_dim_customer", sql.with_layers("dim_customer") + "SELECT * FROM dim_customer")
def gold_dim_customer(spark, root):
    return Published(spark, root).dim_customer


@query("gold_dim_region", sql.with_layers("dim_region") + "SELECT * FROM dim_region")
def gold_dim_region(spark, root):
    return Published(spark, root).dim_region


@query("scaled_customer_key", sql.with_layers("dim_customer") + "SELECT * FROM dim_customer")
def scaled_customer_key(spark, root):
    """Customer keys over many range partitions (more than cores, most of them
    small), to exercise the offset arithmetic across partition boundaries."""
    return star.dim_customer(Published(spark, root).stored_silver, partitions=61)


@query("join_date", sql.with_layers("dim_date")
       + "SELECT s.id, s.sale_date, d.date_key FROM silver s LEFT JOIN dim_date d ON s.sale_date = d.full_date")
def join_date(spark, root):
    lay = Published(spark, root)
    return star.lookup_key(lay.stored_silver, lay.dim_date, "sale_date", "full_date", "date_key") \
        .select("id", "sale_date", "date_key")


@query("join_product", sql.with_layers("dim_product")
       + "SELECT s.id, s.product_id, p.product_key FROM silver s "
         "LEFT JOIN dim_product p ON s.product_id = p.product_id")
def join_product(spark, root):
    lay = Published(spark, root)
    return star.lookup_key(lay.stored_silver, lay.dim_product, "product_id", "product_id", "product_key") \
        .select("id", "product_id", "product_key")


@query("join_customer", sql.with_layers("dim_customer")
       + "SELECT s.id, s.customer_id, c.customer_key FROM silver s "
         "LEFT JOIN dim_customer c ON s.customer_id = c.customer_id")
def join_customer(spark, root):
    lay = Published(spark, root)
    return star.lookup_key(lay.stored_silver, lay.dim_customer, "customer_id", "customer_id", "customer_key") \
        .select("id", "customer_id", "customer_key")


@query("join_region", sql.with_layers("dim_region")
       + "SELECT s.id, s.region, r.region_key FROM silver s LEFT JOIN dim_region r ON s.region = r.region_name")
def join_region(spark, root):
    lay = Published(spark, root)
    return star.lookup_key(lay.stored_silver, lay.dim_region, "region", "region_name", "region_key") \
        .select("id", "region", "region_key")


@query("gold_fact_sales", sql.with_layers("fact") + "SELECT * FROM fact")
def gold_fact_sales(spark, root):
    return Published(spark, root).fact


@query("gold_fact_sales_joined_date", sql.with_layers("fact", "dim_date") + "SELECT * FROM fact")
def gold_fact_sales_joined_date(spark, root):
    """Fact with ``date_key`` looked up in ``dim_date`` (the four-join form)."""
    lay = Published(spark, root)
    return star.fact_sales(lay.stored_silver, lay.dim_product, lay.dim_customer, lay.dim_region,
                           dates=lay.dim_date)


# ------------------------------------------------------------- gold gates ---

@query("gate_fact_grain", sql.with_layers("fact")
       + "SELECT s.n AS silver_rows, f.n AS fact_rows, abs(s.n - f.n) AS grain_difference "
         "FROM (SELECT count(*) AS n FROM silver) s, (SELECT count(*) AS n FROM fact) f")
def gate_fact_grain(spark, root):
    lay = Published(spark, root)
    both = quality.side_by_side({"silver_rows": _rows(lay.stored_silver), "fact_rows": _rows(lay.fact)})
    return both.withColumn("grain_difference", F.abs(F.col("silver_rows") - F.col("fact_rows")))


@query("gate_fk_nulls", sql.with_layers("fact") + "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {k} IS NULL) AS null_{k}" for k in quality.FACT_KEY_COLUMNS) + " FROM fact")
def gate_fk_nulls(spark, root):
    return quality.count_violations(Published(spark, root).fact,
                                    [quality.null_key(k) for k in quality.FACT_KEY_COLUMNS], rows=None)


@query("gate_fk_orphans", sql.with_layers("fact", "dim_date") + "SELECT " + ", ".join(
    f"(SELECT count(*) FROM fact f WHERE f.{k} IS NOT NULL AND NOT EXISTS "
    f"(SELECT 1 FROM {d} x WHERE x.{k} = f.{k})) AS orphan_{k}"
    for k, d in (("date_key", "dim_date"), ("product_key", "dim_product"),
                 ("customer_key", "dim_customer"), ("region_key", "dim_region"))))
def gate_fk_orphans(spark, root):
    """Fact keys with no dimension row, one left-anti join per dimension; the
    four one-row counts come back as one row (``side_by_side``)."""
    lay = Published(spark, root)
    return _orphans(lay.fact, lay)


def _orphans(fact: DataFrame, lay: Published) -> DataFrame:
    dims = {"date_key": lay.dim_date, "product_key": lay.dim_product,
            "customer_key": lay.dim_customer, "region_key": lay.dim_region}
    keys = {k: dim.select(k) for k, dim in dims.items()}
    for k in star.within_budget({k: star.measured_bytes(dim) for k, dim in keys.items()}):
        keys[k] = F.broadcast(keys[k])
    return quality.side_by_side({
        f"orphan_{k}": (fact.where(F.col(k).isNotNull()).select(k)
                        .join(dim, k, "left_anti").agg(F.count(F.lit(1))))
        for k, dim in keys.items()})


@query("gate_duplicate_sale_ids", sql.with_layers("fact")
       + "SELECT count(*) AS duplicate_sale_ids FROM (SELECT sale_id FROM fact GROUP BY sale_id "
         "HAVING count(*) > 1) t")
def gate_duplicate_sale_ids(spark, root):
    return quality.duplicate_keys(Published(spark, root).fact, "sale_id", "duplicate_sale_ids")


@query("gate_negative_amount", sql.with_layers("fact")
       + "SELECT count(*) FILTER (WHERE total_amount < 0) AS negative_amount FROM fact")
def gate_negative_amount(spark, root):
    return quality.count_violations(Published(spark, root).fact, [quality.negative_amount()], rows=None)


@query("gold_row_checks", sql.with_layers("fact") + "SELECT count(*) AS rows, "
       + ", ".join(f"count(*) FILTER (WHERE {k} IS NULL) AS null_{k}" for k in quality.FACT_KEY_COLUMNS)
       + ", count(*) FILTER (WHERE total_amount < 0) AS negative_amount FROM fact")
def gold_row_checks(spark, root):
    """Every row-level gate of the fact from one scan."""
    checks = [quality.null_key(k) for k in quality.FACT_KEY_COLUMNS] + [quality.negative_amount()]
    return quality.count_violations(Published(spark, root).fact, checks)


@query("reconcile_rows", sql.with_layers("fact")
       + "SELECT (SELECT count(*) FROM (SELECT id, quantity, unit_price FROM silver EXCEPT ALL "
         "SELECT sale_id, quantity, unit_price FROM fact) a) AS missing_rows, "
         "(SELECT count(*) FROM (SELECT sale_id, quantity, unit_price FROM fact EXCEPT ALL "
         "SELECT id, quantity, unit_price FROM silver) b) AS extra_rows")
def reconcile_rows(spark, root):
    lay = Published(spark, root)
    return quality.reconcile(lay.stored_silver.withColumnRenamed("id", "sale_id"), lay.fact,
                             ["sale_id", "quantity", "unit_price"])


@query("reconcile_fingerprint", sql.with_layers("fact")
       + "SELECT (SELECT count(*) FROM (SELECT id, quantity, unit_price, created_at FROM silver EXCEPT ALL "
         "SELECT sale_id, quantity, unit_price, created_at FROM fact) a) AS missing_rows, "
         "(SELECT count(*) FROM (SELECT sale_id, quantity, unit_price, created_at FROM fact EXCEPT ALL "
         "SELECT id, quantity, unit_price, created_at FROM silver) b) AS extra_rows")
def reconcile_fingerprint(spark, root):
    """The fact against the cleaned table by fingerprints of hash buckets: as
    they are equal, no row is shuffled."""
    lay = Published(spark, root)
    return quality.reconcile_by_fingerprint(lay.stored_silver.withColumnRenamed("id", "sale_id"), lay.fact,
                                            jobs.RECONCILED)


# ---------------------------------------------------------------- reports ---

def _counts_sql(tables: dict[str, str], columns: dict[str, int] | None = None) -> str:
    def extra(name):
        return f"{columns[name]} AS column_count, " if columns else ""
    return "\nUNION ALL\n".join(f"SELECT '{name}' AS table_name, {extra(name)}count(*) AS rows FROM {src}"
                                for name, src in tables.items())


@query("layer_row_counts", sql.with_layers("fact") + _counts_sql(
    {"bronze": "bronze", "silver": "silver", "fact_sales": "fact"}))
def layer_row_counts(spark, root):
    lay = Published(spark, root)
    return _row_counts({"bronze": lay.bronze, "silver": lay.stored_silver, "fact_sales": lay.fact})


def _row_counts(tables: dict[str, DataFrame], with_columns: bool = False) -> DataFrame:
    out = None
    for name, df in tables.items():
        cols = [F.lit(name).alias("table_name")]
        if with_columns:
            cols.append(F.lit(len(df.columns)).alias("column_count"))
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(*cols, "rows")
        out = row if out is None else out.unionByName(row)
    return out


_STAR = {"dim_date": "dim_date", "dim_product": "dim_product", "dim_customer": "dim_customer",
         "dim_region": "dim_region", "fact_sales": "fact"}


@query("star_summary", sql.with_layers("fact", "dim_date") + _counts_sql(_STAR))
def star_summary(spark, root):
    lay = Published(spark, root)
    return _row_counts({n: lay.table(n) for n in _STAR})


@query("inspect_row_counts", sql.with_layers("fact", "dim_date") + _counts_sql(
    _STAR, {"dim_date": 6, "dim_product": 3, "dim_customer": 2, "dim_region": 2, "fact_sales": 9}))
def inspect_row_counts(spark, root):
    lay = Published(spark, root)
    return _row_counts({n: lay.table(n) for n in _STAR}, with_columns=True)


@query("preview_top10", sql.with_layers("fact") + "SELECT * FROM fact ORDER BY sale_id LIMIT 10")
def preview_top10(spark, root):
    return Published(spark, root).fact.orderBy("sale_id").limit(10)


_MEASURES = ("count(*) AS sales, CAST(sum(quantity) AS BIGINT) AS units, "
             "CAST(sum(total_amount) AS DECIMAL(38,2)) AS revenue")


@query("bi_kpis", sql.with_layers("fact")
       + f"SELECT *, CAST(round(revenue / sales, 2) AS DECIMAL(38,2)) AS avg_basket FROM "
         f"(SELECT {_MEASURES} FROM fact) t")
def bi_kpis(spark, root):
    return analysis.kpis(Published(spark, root).fact)


@query("bi_by_month", sql.with_layers("fact", "dim_date")
       + "SELECT d.year, d.quarter, d.month, count(*) AS sales, CAST(sum(f.quantity) AS BIGINT) AS units, "
         "CAST(sum(f.total_amount) AS DECIMAL(38,2)) AS revenue FROM fact f "
         "LEFT JOIN dim_date d ON f.date_key = d.date_key GROUP BY d.year, d.quarter, d.month")
def bi_by_month(spark, root):
    lay = Published(spark, root)
    return analysis.by_month(lay.fact, lay.dim_date)


@query("bi_by_date", sql.with_layers("fact", "dim_date")
       + f"SELECT f.date_key, d.full_date, {_MEASURES.replace('quantity', 'f.quantity')} FROM fact f "
         "LEFT JOIN dim_date d ON f.date_key = d.date_key GROUP BY f.date_key, d.full_date")
def bi_by_date(spark, root):
    lay = Published(spark, root)
    return analysis.by_date(lay.fact, lay.dim_date)


@query("bi_date_range", sql.with_layers("fact", "dim_date")
       + f"SELECT f.date_key, d.full_date, {_MEASURES.replace('quantity', 'f.quantity')} FROM fact f "
         "LEFT JOIN dim_date d ON f.date_key = d.date_key WHERE d.full_date BETWEEN DATE '1995-01-01' "
         "AND DATE '1995-03-31' GROUP BY f.date_key, d.full_date")
def bi_date_range(spark, root):
    """The daily series of one quarter, from the files and row groups of the
    clustered fact that hold it."""
    lay = Published(spark, root)
    return analysis.by_date(analysis.between_dates(lay.fact, date(1995, 1, 1), date(1995, 3, 31)), lay.dim_date)


@query("bi_sketched_customers", sql.with_layers("fact", "dim_date")
       + "SELECT d.year, d.month, r.region_name, count(*) AS sales, count(DISTINCT f.customer_key) AS customers, "
         "count(DISTINCT f.product_key) AS products, true AS within_bound FROM fact f "
         "LEFT JOIN dim_date d ON f.date_key = d.date_key LEFT JOIN dim_region r ON f.region_key = r.region_key "
         "GROUP BY d.year, d.month, r.region_name")
def bi_sketched_customers(spark, root):
    """Distinct customers and products per month and region from stored daily
    sketches, beside the exact counts: whether all estimates are within three
    standard errors (5 %, or one)."""
    lay = Published(spark, root)
    sketched = analysis.sketch_report(store(analysis.sales_sketches(lay.fact), "sketches"), lay.dim_date, lay.dim_region)
    keys = ("year", "month", "region_name")
    exact = (lay.fact.join(lay.dim_date.select("date_key", "year", "month"), "date_key", "left")
             .join(lay.dim_region, "region_key", "left").groupBy(*keys)
             .agg(F.count_distinct("customer_key").alias("exact_customers"),
                  F.count_distinct("product_key").alias("exact_products")))

    def near(name):
        return F.abs(F.col(name) - F.col(f"exact_{name}")) <= F.greatest(F.lit(1), 0.05 * F.col(f"exact_{name}"))

    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"e.{k}")) for k in keys]
    both = sketched.alias("s").join(exact.alias("e"), same[0] & same[1] & same[2])
    return both.select(*[F.col(f"s.{k}") for k in keys], "sales", F.col("exact_customers").alias("customers"),
                       F.col("exact_products").alias("products"),
                       (near("customers") & near("products")).alias("within_bound"))


@query("bi_by_product", sql.with_layers("fact")
       + f"SELECT p.product_key, p.product_id, p.product_name, t.sales, t.units, t.revenue FROM "
         f"(SELECT product_key, {_MEASURES} FROM fact GROUP BY product_key) t "
         f"LEFT JOIN dim_product p ON t.product_key = p.product_key")
def bi_by_product(spark, root):
    lay = Published(spark, root)
    return analysis.by_key(lay.fact, lay.dim_product, "product_key")


@query("bi_by_customer", sql.with_layers("fact")
       + f"SELECT c.customer_key, c.customer_id, t.sales, t.units, t.revenue FROM "
         f"(SELECT customer_key, {_MEASURES} FROM fact GROUP BY customer_key) t "
         f"LEFT JOIN dim_customer c ON t.customer_key = c.customer_key")
def bi_by_customer(spark, root):
    lay = Published(spark, root)
    return analysis.by_key(lay.fact, lay.dim_customer, "customer_key")


@query("bi_by_region", sql.with_layers("fact")
       + f"SELECT f.region_key, r.region_name, {_MEASURES.replace('quantity', 'f.quantity')} FROM fact f "
         "LEFT JOIN dim_region r ON f.region_key = r.region_key GROUP BY f.region_key, r.region_name")
def bi_by_region(spark, root):
    lay = Published(spark, root)
    return analysis.by_region(lay.fact, lay.dim_region)


@query("bi_top_products", sql.with_layers("fact")
       + f"SELECT p.product_key, p.product_id, p.product_name, t.sales, t.units, t.revenue FROM "
         f"(SELECT product_key, {_MEASURES} FROM fact GROUP BY product_key "
         f"ORDER BY revenue DESC, product_key LIMIT 10) t LEFT JOIN dim_product p ON t.product_key = p.product_key")
def bi_top_products(spark, root):
    lay = Published(spark, root)
    return analysis.top_by_revenue(lay.fact, lay.dim_product, "product_key")


@query("bi_top_customers", sql.with_layers("fact")
       + f"SELECT c.customer_key, c.customer_id, t.sales, t.units, t.revenue FROM "
         f"(SELECT customer_key, {_MEASURES} FROM fact GROUP BY customer_key "
         f"ORDER BY revenue DESC, customer_key LIMIT 10) t "
         f"LEFT JOIN dim_customer c ON t.customer_key = c.customer_key")
def bi_top_customers(spark, root):
    lay = Published(spark, root)
    return analysis.top_by_revenue(lay.fact, lay.dim_customer, "customer_key")


@query("bi_region_year_cube", sql.with_layers("fact", "dim_date")
       + "SELECT r.region_name, d.year, CAST(grouping(r.region_name, d.year) AS INTEGER) AS grouping_level, "
         "count(*) AS sales, CAST(sum(f.quantity) AS BIGINT) AS units, "
         "CAST(sum(f.total_amount) AS DECIMAL(38,2)) AS revenue FROM fact f "
         "LEFT JOIN dim_date d ON f.date_key = d.date_key LEFT JOIN dim_region r ON f.region_key = r.region_key "
         "GROUP BY CUBE (r.region_name, d.year)")
def bi_region_year_cube(spark, root):
    lay = Published(spark, root)
    return analysis.region_year_cube(lay.fact, lay.dim_region, lay.dim_date)


# ----------------------------------------------------------- damaged star ---
#
# The published star passes its gates, so the same checks also run on a copy
# of the fact with deliberate damage, by sale id.

_DAMAGED = (",\ndamaged AS (SELECT sale_id, CASE WHEN sale_id % 29 = 0 THEN NULL ELSE date_key END AS date_key, "
            "CASE WHEN sale_id % 17 = 0 THEN product_key + 100000000 WHEN sale_id % 13 = 0 THEN NULL "
            "ELSE product_key END AS product_key, "
            "CASE WHEN sale_id % 41 = 0 THEN NULL WHEN sale_id % 43 = 0 THEN customer_key + 100000000 "
            "ELSE customer_key END AS customer_key, "
            "CASE WHEN sale_id % 31 = 0 THEN -1 ELSE region_key END AS region_key, quantity, unit_price, "
            "CASE WHEN sale_id % 23 = 0 THEN -total_amount ELSE total_amount END AS total_amount "
            "FROM fact WHERE sale_id % 37 <> 0 "
            "UNION ALL SELECT sale_id, date_key, product_key, customer_key, region_key, quantity, unit_price, "
            "total_amount FROM fact WHERE sale_id % 19 = 0)\n")


def _damaged_sql(*layers: str) -> str:
    return sql.with_layers(*layers).rstrip("\n") + _DAMAGED


def _damaged(lay: Published) -> DataFrame:
    """The fact with missing and unknown keys, negated amounts, lost and repeated sales."""
    def bad(n):
        return F.col("sale_id") % n == 0

    fact = lay.fact.drop("created_at")
    changed = fact.where(~bad(37)).withColumns({
        "date_key": F.when(~bad(29), F.col("date_key")),
        "product_key": F.when(bad(17), F.col("product_key") + 100_000_000).when(~bad(13), F.col("product_key")),
        "customer_key": F.when(bad(43) & ~bad(41), F.col("customer_key") + 100_000_000).when(
            ~bad(41), F.col("customer_key")),
        "region_key": F.when(bad(31), -1).otherwise(F.col("region_key")),
        "total_amount": F.when(bad(23), -F.col("total_amount")).otherwise(F.col("total_amount"))})
    return changed.unionByName(fact.where(bad(19)))


@query("damaged_row_checks", _damaged_sql("fact") + "SELECT count(*) AS rows, "
       + ", ".join(f"count(*) FILTER (WHERE {k} IS NULL) AS null_{k}" for k in quality.FACT_KEY_COLUMNS)
       + ", count(*) FILTER (WHERE total_amount < 0) AS negative_amount FROM damaged")
def damaged_row_checks(spark, root):
    checks = [quality.null_key(k) for k in quality.FACT_KEY_COLUMNS] + [quality.negative_amount()]
    return quality.count_violations(_damaged(Published(spark, root)), checks)


@query("damaged_fk_orphans", _damaged_sql("fact", "dim_date") + "SELECT " + ", ".join(
    f"(SELECT count(*) FROM damaged f WHERE f.{k} IS NOT NULL AND NOT EXISTS "
    f"(SELECT 1 FROM {d} x WHERE x.{k} = f.{k})) AS orphan_{k}"
    for k, d in (("date_key", "dim_date"), ("product_key", "dim_product"),
                 ("customer_key", "dim_customer"), ("region_key", "dim_region"))))
def damaged_fk_orphans(spark, root):
    lay = Published(spark, root)
    return _orphans(_damaged(lay), lay)


@query("damaged_duplicate_sale_ids", _damaged_sql("fact")
       + "SELECT count(*) AS duplicate_sale_ids FROM (SELECT sale_id FROM damaged GROUP BY sale_id "
         "HAVING count(*) > 1) t")
def damaged_duplicate_sale_ids(spark, root):
    return quality.duplicate_keys(_damaged(Published(spark, root)), "sale_id", "duplicate_sale_ids")


@query("damaged_grain", _damaged_sql("fact")
       + "SELECT s.n AS silver_rows, f.n AS fact_rows, abs(s.n - f.n) AS grain_difference "
         "FROM (SELECT count(*) AS n FROM silver) s, (SELECT count(*) AS n FROM damaged) f")
def damaged_grain(spark, root):
    lay = Published(spark, root)
    both = quality.side_by_side({"silver_rows": _rows(lay.stored_silver), "fact_rows": _rows(_damaged(lay))})
    return both.withColumn("grain_difference", F.abs(F.col("silver_rows") - F.col("fact_rows")))


@query("damaged_reconcile", _damaged_sql("fact")
       + "SELECT (SELECT count(*) FROM (SELECT id, quantity, unit_price FROM silver EXCEPT ALL "
         "SELECT sale_id, quantity, unit_price FROM damaged) a) AS missing_rows, "
         "(SELECT count(*) FROM (SELECT sale_id, quantity, unit_price FROM damaged EXCEPT ALL "
         "SELECT id, quantity, unit_price FROM silver) b) AS extra_rows")
def damaged_reconcile(spark, root):
    lay = Published(spark, root)
    return quality.reconcile(lay.stored_silver.withColumnRenamed("id", "sale_id"), _damaged(lay),
                             ["sale_id", "quantity", "unit_price"])


@query("damaged_totals", _damaged_sql("fact", "dim_date") + "\nUNION ALL\n".join(
    f"SELECT '{report}' AS report, count(*) AS sales, CAST(sum(total_amount) AS DECIMAL(38,2)) AS revenue "
    "FROM damaged" for report in ("kpis", "month", "cube")))
def damaged_totals(spark, root):
    """Totals of three reports agree although sales lack a date or a known region."""
    lay = Published(spark, root)
    fact = _damaged(lay)
    cube = analysis.region_year_cube(fact, lay.dim_region, lay.dim_date).where("grouping_level = 0")
    parts = {"kpis": analysis.kpis(fact), "month": analysis.by_month(fact, lay.dim_date), "cube": cube}
    return _union_layers({n: df.agg(F.sum("sales").cast("long").alias("sales"),
                                    F.sum("revenue").cast(analysis.MONEY).alias("revenue"))
                          for n, df in parts.items()}).withColumnRenamed("layer", "report")


@query("damaged_reconcile_fingerprint", SQL["damaged_reconcile"])
def damaged_reconcile_fingerprint(spark, root):
    """As ``damaged_reconcile``, exact, by way of the buckets that differ."""
    lay = Published(spark, root)
    return quality.reconcile_by_fingerprint(lay.stored_silver.withColumnRenamed("id", "sale_id"), _damaged(lay),
                                            ["sale_id", "quantity", "unit_price"])
