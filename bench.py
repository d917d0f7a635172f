"""Bench: the whole batch pipeline plus the BI reports at one scale factor.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default sf0.1) and prints
one JSON line.  Steps timed:

  ingest        raw feed derived from the test tables, written as a CSV drop
  silver        newest drop → cleaned table (gates from the write + one key job)
  gold          cleaned table → 4 dimensions + fact, gated, published
  bi_*          the six reports over the published star
  q_*           a few catalog queries planned from the raw tables

``value`` is the sum of the pipeline steps and reports.  Both forms are
warmed up first with one untimed pass over sf0.001, and every timed step is
run ``$BENCH_REPEAT`` times (default 2, fresh folders each time) and reported
as its best run, for both forms alike.  With
``BENCH_BASELINE=1`` (default) the textbook composition is timed too
(arbitrary dedup, one action per check, global-window keys, every action
re-evaluating its inputs) and reported under ``baseline``.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tessera.functions import sale_amount  # noqa: E402
from tessera.operators import analysis, cleaning, quality, star  # noqa: E402
from tessera.operators.keys import dense_key_single_task  # noqa: E402
from tessera.plans import catalog, jobs  # noqa: E402
from tessera.schemas import STAR_TABLES  # noqa: E402
from tessera.session import local_session  # noqa: E402
from tessera.sources.fixture import bronze_from_tables  # noqa: E402
from tessera.sources.files import latest_drop, read_bronze  # noqa: E402


def timed(results: dict, name: str, fn):
    """Run ``fn``; keep the best time seen under ``name``."""
    t = time.perf_counter()
    out = fn()
    took = round(time.perf_counter() - t, 3)
    results[name] = min(took, results.get(name, took))
    return out


def naive_pipeline(spark, bronze_path: str, out: str) -> None:
    """The library's operators put together as a textbook would, for comparison:
    any row of an id survives, every check is an action of its own that runs the
    whole plan again, keys come from one-task windows, nothing is stored between
    the steps but the cleaned table, which is cached."""
    raw = read_bronze(spark, bronze_path)
    single = raw.dropDuplicates(["id"])
    clean = cleaning.business_rules(cleaning.clean_text(cleaning.require_columns(single)))
    for step in (raw, single, clean):
        step.count()
    for gate in (quality.duplicate_keys(clean, "id"),
                 quality.inconsistent_mappings(clean, "product_id", "product_name"),
                 *[quality.count_violations(clean, [c()], rows=None) for c in quality.SALES_ROW_CHECKS]):
        gate.collect()
    clean.write.mode("overwrite").parquet(f"{out}/silver")
    silver = spark.read.parquet(f"{out}/silver").cache()
    silver.count()
    names = star.product_names(silver).groupBy("product_id").agg(F.min("product_name").alias("product_name"))
    regions = silver.select(F.col("region").alias("region_name")).distinct()
    tables = {"dim_date": star.dim_date(silver),
              "dim_product": dense_key_single_task(names, "product_id", "product_key"),
              "dim_customer": dense_key_single_task(silver.select("customer_id").distinct(), "customer_id",
                                                    "customer_key"),
              "dim_region": dense_key_single_task(regions, "region_name", "region_key")}
    for dim in tables.values():
        dim.count()
    joined = silver
    for name, mine, theirs in (("dim_date", "sale_date", "full_date"), ("dim_product", "product_id", "product_id"),
                               ("dim_customer", "customer_id", "customer_id"), ("dim_region", "region", "region_name")):
        # No size is claimed, so the planner chooses the join.
        joined = star.lookup_key(joined, tables[name], mine, theirs, name[4:] + "_key", dim_bytes=1 << 62)
    fact = joined.select(F.col("id").alias("sale_id"), *quality.FACT_KEY_COLUMNS, "quantity", "unit_price",
                         sale_amount("quantity", "unit_price").alias("total_amount"), "created_at")
    for step in (fact, silver):
        step.count()
    for gate in (*[quality.count_violations(fact, [quality.null_key(k)], rows=None) for k in quality.FACT_KEY_COLUMNS],
                 quality.duplicate_keys(fact, "sale_id"),
                 quality.count_violations(fact, [quality.negative_amount()], rows=None)):
        gate.collect()
    for name, df in {**tables, "fact_sales": fact}.items():
        df.write.mode("overwrite").parquet(f"{out}/gold/{name}")
        spark.read.parquet(f"{out}/gold/{name}").count()
    silver.unpersist()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    run_baseline = os.environ.get("BENCH_BASELINE", "1") != "0"
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    scratch = tempfile.mkdtemp(prefix="tessera-bench-")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          extra={"spark.local.dir": scratch,
                                 "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    spark.sparkContext.setCheckpointDir(f"{scratch}/checkpoints")
    q: dict[str, float] = {}

    # Warm the JVM (class loading, JIT, codegen caches) outside the timings:
    # one full pass of the same steps on the smallest data folder.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        warm = jobs.PipelineConfig(bronze_root=f"{scratch}/warm/bronze", silver_path=f"{scratch}/warm/silver",
                                   gold_root=f"{scratch}/warm/gold")
        jobs.ingest(bronze_from_tables(spark, warm_dir), warm)
        jobs.bronze_to_silver(spark, warm)
        jobs.silver_to_gold(spark, warm)
        if run_baseline:
            naive_pipeline(spark, latest_drop(spark, warm.bronze_root), f"{scratch}/warm/naive")

    star = {}
    for rep in range(repeat):
        # Each repetition gets fresh folders; a step's time is its best run.
        cfg = jobs.PipelineConfig(bronze_root=f"{scratch}/r{rep}/bronze", silver_path=f"{scratch}/r{rep}/silver",
                                  gold_root=f"{scratch}/r{rep}/gold")
        timed(q, "ingest", lambda: jobs.ingest(bronze_from_tables(spark, sf_dir), cfg))
        silver_report = timed(q, "silver", lambda: jobs.bronze_to_silver(spark, cfg))
        gold_report = timed(q, "gold", lambda: jobs.silver_to_gold(spark, cfg))
        star = {t: spark.read.parquet(cfg.gold_path(t)) for t in STAR_TABLES}
        fact = star["fact_sales"]
        reports = {
            "bi_kpis": lambda: analysis.kpis(fact),
            "bi_by_month": lambda: analysis.by_month(fact, star["dim_date"]),
            "bi_by_region": lambda: analysis.by_region(fact, star["dim_region"]),
            "bi_top_products": lambda: analysis.top_by_revenue(fact, star["dim_product"], "product_key"),
            "bi_top_customers": lambda: analysis.top_by_revenue(fact, star["dim_customer"], "customer_key"),
            "bi_region_year_cube": lambda: analysis.region_year_cube(fact, star["dim_region"],
                                                                     star["dim_date"]),
        }
        for name, build in reports.items():
            timed(q, name, lambda b=build: b().collect())
    total = round(sum(q.values()), 3)

    for name in ("silver_sales", "gold_fact_sales", "gate_duplicate_ids", "diagnose_mapping",
                 "null_profile", "bi_region_year_cube"):
        timed(q, f"q_{name}", lambda n=name: catalog.QUERIES[n](spark, sf_dir)
              .agg(F.count(F.lit(1))).collect())

    out = {"metric": "pipeline_seconds", "value": total, "unit": "sec", "queries": q, "sf": sf,
           "rows": {"bronze": silver_report["bronze_rows"], "silver": silver_report["silver_rows"],
                    **gold_report["rows"]}}
    if run_baseline:
        b: dict[str, float] = {}
        drop = latest_drop(spark, cfg.bronze_root)
        for rep in range(repeat):
            timed(b, "naive_silver_and_gold", lambda: naive_pipeline(spark, drop, f"{scratch}/naive{rep}"))
        ours = round(q["silver"] + q["gold"], 3)
        out["baseline"] = {**b, "ours_silver_and_gold": ours,
                           "speedup": round(b["naive_silver_and_gold"] / ours, 2) if ours else None}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
