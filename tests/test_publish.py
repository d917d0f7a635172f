"""Publishing: the star as one set, bucketed catalog tables, clustered facts,
what failed runs leave behind, and the removal of old runs."""
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from tessera.operators import analysis, cleaning, quality
from tessera.plans import jobs
from tessera.schemas import STAR_TABLES
from tessera.sinks import tables as sink
from tessera.sources.fixture import bronze_from_tables

from test_plans import plan


def config(path, **kw):
    return jobs.PipelineConfig(bronze_root=str(path / "bronze"), silver_path=str(path / "silver"),
                               gold_root=str(path / "gold"), **kw)


@pytest.fixture(scope="module")
def feed(spark, sf001):
    return bronze_from_tables(spark, sf001)


def run_both(spark, cfg, feed):
    jobs.bronze_to_silver(spark, cfg, bronze=feed)
    return jobs.silver_to_gold(spark, cfg)


# ------------------------------------------------------------ star as a set ---

def test_failure_between_tables_leaves_the_old_star(spark, feed, tmp_path, monkeypatch):
    cfg = config(tmp_path, star_as_set=True)
    with pytest.raises(jobs.NotPublished):
        jobs.read_star(spark, cfg)
    run_both(spark, cfg, feed.where("id % 2 = 0"))
    old = {t: df.count() for t, df in jobs.read_star(spark, cfg).items()}
    jobs.bronze_to_silver(spark, cfg, bronze=feed)
    checks = []
    real = sink.verify_table

    def failing(spark, path, *a, **kw):
        checks.append(path.rsplit("/", 1)[-1])
        if checks[-1] == "dim_region":
            raise sink.VerificationError("between the tables")
        return real(spark, path, *a, **kw)

    monkeypatch.setattr(sink, "verify_table", failing)
    with pytest.raises(sink.VerificationError):
        jobs.silver_to_gold(spark, cfg)
    monkeypatch.undo()
    assert len(checks) > 1
    assert {t: df.count() for t, df in jobs.read_star(spark, cfg).items()} == old
    assert len([d for d in (tmp_path / "gold" / jobs.RUNS).iterdir() if any(d.iterdir())]) == 1
    report = jobs.silver_to_gold(spark, cfg)
    now = jobs.read_star(spark, cfg)
    assert {t: df.count() for t, df in now.items()} == report["rows"] != old
    assert now["fact_sales"].join(now["dim_product"], "product_key").count() == report["rows"]["fact_sales"]
    assert jobs.inspect_gold(spark, cfg)["fact_sales"]["rows"] == report["rows"]["fact_sales"]


def test_tables_of_one_reading_are_of_one_run(spark, feed, tmp_path):
    """A star that was read before a publish stays whole after it."""
    cfg = config(tmp_path, star_as_set=True)
    run_both(spark, cfg, feed.where("id % 2 = 0"))
    before = jobs.read_star(spark, cfg)
    rows = {t: df.count() for t, df in before.items()}
    run_both(spark, cfg, feed)
    assert {t: df.count() for t, df in before.items()} == rows
    assert len({f.split(f"/{jobs.RUNS}/")[1].split("/")[0] for df in before.values() for f in df.inputFiles()}) == 1


def test_a_set_needs_plain_folders(tmp_path):
    with pytest.raises(ValueError):
        config(tmp_path, star_as_set=True, catalog="lake")
    for fmt in ("iceberg", "hudi"):
        with pytest.raises(sink.UnsupportedFormat):
            config(tmp_path, table_format=fmt)


def test_unverifiable_format_is_refused_before_anything_moves(spark, tmp_path):
    staged = str(tmp_path / "t.__staging_1")
    sink.write_table(spark.range(3), staged)
    with pytest.raises(sink.UnsupportedFormat):
        sink.publish(spark, staged, str(tmp_path / "t"), table_format="iceberg")
    assert os.path.exists(staged) and not os.path.exists(tmp_path / "t")


def test_failed_publish_leaves_no_staging(spark, feed, tmp_path, monkeypatch):
    cfg = config(tmp_path)
    run_both(spark, cfg, feed)

    def failing(*a, **kw):
        raise sink.VerificationError("not there")

    monkeypatch.setattr(sink, "verify_commit", failing)
    with pytest.raises(sink.VerificationError):
        jobs.silver_to_gold(spark, cfg)
    with pytest.raises(sink.VerificationError):
        jobs.bronze_to_silver(spark, cfg, bronze=feed)
    monkeypatch.undo()
    assert sorted(os.listdir(tmp_path / "gold")) == sorted(STAR_TABLES)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["gold", "silver"]


def test_old_runs_are_removed_and_the_current_one_stays(spark, feed, tmp_path):
    cfg = config(tmp_path, star_as_set=True)
    run_both(spark, cfg, feed.where("id % 2 = 0"))
    for _ in range(2):
        jobs.silver_to_gold(spark, cfg)
    runs = tmp_path / "gold" / jobs.RUNS
    os.makedirs(tmp_path / "silver.__staging_dead")
    assert len(list(runs.iterdir())) == 3
    assert jobs.remove_old_runs(spark, cfg) == []          # all are younger than a day
    gone = jobs.remove_old_runs(spark, cfg, keep=1, older_than_hours=0)
    assert [p.name for p in runs.iterdir()] == [sink.pointed_to(spark, cfg.gold_root)]
    assert len(gone) == 3 and not (tmp_path / "silver.__staging_dead").exists()
    assert jobs.read_star(spark, cfg)["fact_sales"].count() > 0


# --------------------------------------------------- bucketed catalog tables ---

@pytest.fixture()
def lake(spark, tmp_path):
    spark.sql(f"CREATE DATABASE bucket_test LOCATION '{tmp_path}/db'")
    yield config(tmp_path, catalog="bucket_test")
    spark.sql("DROP DATABASE bucket_test CASCADE")


@pytest.mark.parametrize("partitions", [8, 5])
def test_bucketed_cleaned_table_needs_no_shuffle_by_id(spark, feed, lake, tmp_path, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    run_both(spark, lake, feed.where("id % 2 = 0"))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        report = run_both(spark, lake, feed)
        sales = spark.table("bucket_test.sales")
        assert sink.bucket_count(spark, "bucket_test.sales") == int(before)
        gate = quality.duplicate_keys(sales, "id")
        assert "hashpartitioning(id" not in plan(gate) and gate.first()[0] == 0
        assert "hashpartitioning(id" in plan(quality.duplicate_keys(sales.repartition(3), "id"))
        again = cleaning.dedup_sales(sales)
        assert "hashpartitioning" not in plan(again)
        assert again.count() == sales.count() == report["rows"]["fact_sales"] == 4225
        assert report["duplicate_sale_ids"] == 0
        assert len(sales.inputFiles()) == int(before)      # every bucket is one file
        assert [t.name for t in spark.catalog.listTables("bucket_test") if "__" in t.name] == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_duplicates_in_a_bucketed_table_are_found(spark, feed, lake):
    """The gate of the catalog mode fires, and the published table stays."""
    run_both(spark, lake, feed)
    real = cleaning.build_silver
    try:
        cleaning.build_silver = lambda df, **kw: real(df, **kw).unionByName(real(df, **kw).where("id % 100 = 11"))
        with pytest.raises(quality.GateFailure) as err:
            jobs.bronze_to_silver(spark, lake, bronze=feed)
    finally:
        cleaning.build_silver = real
    assert err.value.failures["duplicate_ids"] > 0
    assert spark.table("bucket_test.sales").count() == 4225
    assert [t.name for t in spark.catalog.listTables("bucket_test") if "__" in t.name] == []


def test_old_folders_of_catalog_tables_are_removed(spark, feed, lake, tmp_path):
    for _ in range(3):
        run_both(spark, lake, feed)
    assert len(list((tmp_path / "silver").glob("run_*"))) == 3
    jobs.remove_old_runs(spark, lake, keep=2, older_than_hours=0)
    assert len(list((tmp_path / "silver").glob("run_*"))) == 2
    jobs.remove_old_runs(spark, lake, keep=1, older_than_hours=0)
    assert spark.table("bucket_test.sales").count() == spark.table("bucket_test.fact_sales").count() == 4225


# --------------------------------------------------------- clustered facts ---

def test_files_of_a_clustered_fact_hold_ranges_of_dates(spark, feed, tmp_path):
    cfg = config(tmp_path, cluster_fact=True)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        report = run_both(spark, cfg, feed)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert report["silver_rows"] == report["rows"]["fact_sales"] == 4225
    fact = jobs.read_published(spark, cfg, "fact_sales")
    spans = [tuple(r) for r in fact.groupBy(F.input_file_name()).agg(
        F.min("date_key"), F.max("date_key")).drop("input_file_name()").collect()]
    assert len(spans) == 8
    spans.sort()
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert plan(analysis.between_dates(fact, date(1995, 1, 1), date(1995, 3, 31))).count(
        "GreaterThanOrEqual(date_key,19950101), LessThanOrEqual(date_key,19950331)") == 1
    days = [r.keys for r in jobs.read_published(spark, cfg, "dim_date").groupBy(F.input_file_name()).agg(
        F.collect_list("date_key").alias("keys")).collect()]
    assert sum(sorted(days), []) == sorted(sum(days, []))


def test_a_hot_date_is_spread(spark, feed, tmp_path):
    cfg = config(tmp_path, cluster_fact=True)
    hot = feed.withColumn("sale_date", F.when(F.col("id") % 10 < 8, F.lit(date(1995, 1, 1))).otherwise(F.col("sale_date")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        run_both(spark, cfg, hot)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in jobs.read_published(spark, cfg, "fact_sales").groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 2 * sum(sizes) / len(sizes)


# ------------------------------------------------------------- fingerprints ---

def test_reconcile_by_fingerprint_equals_reconcile(spark):
    left = spark.createDataFrame([(1, 1.5, "a"), (1, 1.5, "a"), (2, None, "b"), (None, 2.0, None), (3, 0.0, "c"),
                                  (4, float("nan"), "d")], "k int, v double, s string")
    swapped = spark.createDataFrame([(1, 1.5, "a"), (2, None, "b"), (2, None, "b"), (None, 2.0, None), (3, -0.0, "c"),
                                     (4, float("nan"), "d")], "k int, v double, s string")
    moved = spark.createDataFrame([(1, None, "a"), (None, 1.0, "a")], "k int, v double, s string")
    for a, b in ((left, left), (left, swapped), (swapped, left), (left, moved), (left, left.limit(0)), (moved, moved)):
        for buckets in (1, 4, 4096):
            got = quality.reconcile_by_fingerprint(a, b, ["k", "v", "s"], buckets=buckets).first()
            assert got == quality.reconcile(a, b, ["k", "v", "s"]).first()


def test_equal_tables_shuffle_no_rows(spark, feed, tmp_path):
    """Of equal tables only fingerprints are shuffled; the final plan of the
    exact comparison is empty."""
    feed.write.parquet(str(tmp_path / "a"))
    a = spark.read.parquet(str(tmp_path / "a"))
    same = quality.reconcile_by_fingerprint(a, a.repartition(3), a.columns, buckets=64)
    differ = quality.differing_buckets(a, a.repartition(3), a.columns, buckets=64)
    assert differ.count() == 0
    assert "partial_sum" in plan(differ).split("Exchange")[-1]     # combined ahead of the shuffle
    assert tuple(same.first()) == (0, 0)
    if spark.conf.get("spark.sql.adaptive.enabled") == "true":
        same.collect()
        final = same._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "FileScan" not in final


def test_reconcile_gate_stops_the_star(spark, feed, tmp_path, monkeypatch):
    from tessera.operators import star

    cfg = config(tmp_path, reconcile_gate=True)
    report = run_both(spark, cfg, feed)
    assert report["missing_rows"] == report["extra_rows"] == 0
    real = star.fact_sales
    monkeypatch.setattr(star, "fact_sales", lambda *a, **kw: real(*a, **kw).withColumn(
        "unit_price", F.when(F.col("sale_id") % 100 == 11, F.col("unit_price") + 1).otherwise(F.col("unit_price"))))
    with pytest.raises(quality.GateFailure) as err:
        jobs.silver_to_gold(spark, cfg)
    assert err.value.failures["missing_rows"] == err.value.failures["extra_rows"] > 0


# ----------------------------------------------------------------- sketches ---

def test_merged_sketches_are_near_the_exact_counts(spark, sf001):
    from tessera.plans.layers import Published

    lay = Published(spark, sf001)
    fact = lay.fact
    stored = sink.store(analysis.sales_sketches(fact), "sketches")
    assert "Scan" in plan(stored) and stored.count() == fact.select("date_key", "region_key").distinct().count()
    total = analysis.merged_sketches(stored).first()
    exact = fact.agg(F.count("*").alias("n"), F.count_distinct("customer_key").alias("c"),
                     F.count_distinct("product_key").alias("p"),
                     F.percentile("total_amount", 0.5).alias("m")).first()
    assert total.sales == exact.n
    assert abs(total.customers - exact.c) <= 0.05 * exact.c and abs(total.products - exact.p) <= 0.05 * exact.p
    rank = fact.where(F.col("total_amount") <= F.lit(total.amount_p50)).count() / exact.n
    assert abs(rank - 0.5) <= 0.02
    empty = analysis.merged_sketches(analysis.sales_sketches(fact.limit(0)), "region_key")
    assert empty.count() == 0
    nulls = fact.limit(5).withColumns({"customer_key": F.lit(None).cast("int"), "total_amount": F.lit(None).cast("decimal(18,2)")})
    got = analysis.merged_sketches(analysis.sales_sketches(nulls)).first()
    assert (got.sales, got.customers, got.amount_p50) == (5, 0, None)
