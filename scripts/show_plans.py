"""Write PLANS.md: the physical plans (explain "formatted": tree plus scan
details) of the operators that matter at scale, built on sf0.01.

usage: python scripts/show_plans.py [sf_dir] > PLANS.md
"""
import os
import sys
import tempfile
from datetime import date

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.operators import analysis, cleaning, quality, star  # noqa: E402
from tessera.operators.keys import dense_key  # noqa: E402
from tessera.plans import jobs  # noqa: E402
from tessera.session import local_session  # noqa: E402
from tessera.sinks.drops import write_drop  # noqa: E402
from tessera.sources.files import read_bronze  # noqa: E402
from tessera.sources.fixture import bronze_from_tables  # noqa: E402


def formatted(df) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    text = jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    tree, _, details = text.partition("\n\n\n")
    keep = [line for line in details.splitlines()
            if line.startswith(("PushedFilters", "ReadSchema", "Keys", "Functions", "Arguments: hash",
                                "Arguments: range", "Arguments: Single", "Join type", "Condition"))
            or line.startswith("(")]
    return tree.strip() + "\n\n" + "\n".join(keep)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    scratch = tempfile.mkdtemp(prefix="plans-")
    spark = local_session(extra={"spark.sql.warehouse.dir": f"{scratch}/warehouse"})
    spark.sparkContext.setCheckpointDir(f"{scratch}/ck")
    drop = write_drop(bronze_from_tables(spark, sf_dir), f"{scratch}/bronze")
    raw = read_bronze(spark, drop)
    # The tables the plans read are those that the jobs publish.
    cfg = jobs.PipelineConfig(bronze_root=f"{scratch}/bronze", silver_path=f"{scratch}/silver",
                              gold_root=f"{scratch}/gold", cluster_fact=True)
    jobs.bronze_to_silver(spark, cfg)
    jobs.silver_to_gold(spark, cfg)
    silver, tables = jobs.read_published(spark, cfg, "sales"), jobs.read_star(spark, cfg)
    product, customer, region, days = (tables[f"dim_{t}"] for t in ("product", "customer", "region", "date"))
    published = tables["fact_sales"]
    spark.sql(f"CREATE DATABASE plans LOCATION '{scratch}/db'")
    lake = jobs.PipelineConfig(bronze_root=f"{scratch}/bronze", silver_path=f"{scratch}/silver_buckets",
                               gold_root="", catalog="plans")
    jobs.bronze_to_silver(spark, lake)
    bucketed = jobs.read_published(spark, lake, "sales")
    dealt = star.in_date_ranges(silver)
    sections = [
        ("Cleaned layer from a CSV drop: filters pushed into the scan, dedup combined map-side",
         cleaning.build_silver(raw)),
        ("Dense keys: range partitions over distinct keys, offsets from a per-partition table",
         dense_key(silver.select("customer_id").distinct(), "customer_id", "customer_key", checkpoint=False)),
        ("Fact clustered by date: ranges of the cleaned table, date key computed, dimensions broadcast within a "
         "measured budget, a local sort",
         star.fact_sales(dealt, product, customer, region).sortWithinPartitions("date_key", "sale_id")),
        ("Gate: one product, several names (distinct pairs, hash aggregates only)",
         quality.inconsistent_mappings(silver, "product_id", "product_name")),
        ("Gate: duplicate ids of a plain table (partial count)", quality.duplicate_keys(silver, "id")),
        ("Gate: duplicate ids of the bucketed catalog table (no shuffle of the ids)",
         quality.duplicate_keys(bucketed, "id")),
        ("De-duplication of the bucketed catalog table (no shuffle)", cleaning.dedup_sales(bucketed)),
        ("Reconcile: hash buckets whose fingerprints differ (a row per bucket and task)",
         quality.differing_buckets(silver.withColumnRenamed("id", "sale_id"), published, jobs.RECONCILED)),
        ("Report: one quarter, a range of the clustered fact",
         analysis.by_date(analysis.between_dates(published, date(1995, 1, 1), date(1995, 3, 31)), days)),
        ("Report: revenue by region, aggregated before the join", analysis.by_region(published, region)),
        ("Report: top 10 customers from their stored rows, dimension streamed through a semi-join",
         analysis.top_by_revenue(published, customer, "customer_key")),
        ("Report: region x year cube over pre-aggregated keys",
         analysis.region_year_cube(published, region, days)),
        ("Sketches: one pass, partial sketches on the map side", analysis.sales_sketches(published)),
    ]
    print("# Physical plans (sf0.01, local[*]; generated by `scripts/show_plans.py`)\n")
    print("AQE re-plans at run time (coalescing, skew splits, broadcast conversion); these are the plans")
    print("Catalyst hands to it.\n")
    for title, df in sections:
        print(f"## {title}\n\n```\n{formatted(df)}\n```\n")


if __name__ == "__main__":
    main()
