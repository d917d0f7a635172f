"""Drops processed by Structured Streaming: only new drops, newest wins, a
drop still being written is retried, progress survives a restart."""
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tessera.plans import jobs
from tessera.sinks.drops import write_drop
from tessera.sources.files import drops, latest_drop
from tessera.sources.fixture import bronze_from_tables
from tessera.streaming.drops import start_silver_stream

HEADER = "id,sale_date,product_id,product_name,customer_id,region,quantity,unit_price,created_at\n"


def run(spark, cfg, ckpt, reports):
    from pyspark.errors import StreamingQueryException

    q = start_silver_stream(spark, cfg, ckpt, reports=reports)
    try:
        q.awaitTermination(300)
    except StreamingQueryException:
        pass  # inspected through q.exception()
    return q


def test_stream_cleans_newest_complete_drop(spark, sf001, tmp_path):
    cfg = jobs.PipelineConfig(bronze_root=str(tmp_path / "bronze"), silver_path=str(tmp_path / "silver"),
                              gold_root=str(tmp_path / "gold"))
    raw = bronze_from_tables(spark, sf001).withColumn("created_at", F.col("created_at").cast("timestamp"))
    old = raw.filter(F.col("id") % 2 == 0)
    write_drop(old, cfg.bronze_root, now=datetime(2024, 1, 1, tzinfo=timezone.utc))
    write_drop(raw, cfg.bronze_root, now=datetime(2024, 1, 2, tzinfo=timezone.utc))
    reports = []
    ckpt = str(tmp_path / "stream-ckpt")
    assert run(spark, cfg, ckpt, reports).exception() is None
    assert [r["bronze_rows"] for r in reports] == [6000]
    assert spark.read.parquet(cfg.silver_path).count() == 4225

    # Nothing new: a second run does nothing.
    run(spark, cfg, ckpt, reports)
    assert len(reports) == 1

    # A new, smaller drop arrives: only it is processed.
    write_drop(old, cfg.bronze_root, now=datetime(2024, 1, 3, tzinfo=timezone.utc))
    run(spark, cfg, ckpt, reports)
    assert [r["bronze_rows"] for r in reports] == [6000, old.count()]

    # A drop still being written (parts, no _SUCCESS): the run fails and
    # commits nothing; once the marker appears, the retried run publishes it.
    folder = tmp_path / "bronze" / "ingestion_date=2024-01-04" / "sales_20240104_000000.csv"
    folder.mkdir(parents=True)
    (folder / "part-00000.csv").write_text(HEADER + "1,2024-01-04,1,n,1,EUROPE,2,3.0,2024-01-04 00:00:00\n")
    assert [d[2] for d in drops(spark, cfg.bronze_root)] == [True, True, True, False]
    q = run(spark, cfg, ckpt, reports)
    assert q.exception() is not None and "IncompleteDrop" in str(q.exception())
    assert spark.read.parquet(cfg.silver_path).count() != 1
    (folder / "_SUCCESS").write_text("")
    assert run(spark, cfg, ckpt, reports).exception() is None
    assert reports[-1]["bronze_rows"] == 1
    assert spark.read.parquet(cfg.silver_path).count() == 1


def test_stream_and_batch_agree_on_the_newest_drop(spark, sf001, tmp_path):
    """The drop written last is the newest, whatever its name says."""
    cfg = jobs.PipelineConfig(bronze_root=str(tmp_path / "bronze"), silver_path=str(tmp_path / "silver"),
                              gold_root=str(tmp_path / "gold"))
    raw = bronze_from_tables(spark, sf001)
    write_drop(raw, cfg.bronze_root, now=datetime(2024, 1, 2, tzinfo=timezone.utc))
    write_drop(raw.filter("id % 2 = 0"), cfg.bronze_root, now=datetime(2024, 1, 1, tzinfo=timezone.utc))
    reports = []
    assert run(spark, cfg, str(tmp_path / "ck"), reports).exception() is None
    assert reports[0]["source"] == latest_drop(spark, cfg.bronze_root)
    assert "20240101" in reports[0]["source"]


def test_stream_waits_for_a_drop_being_written(spark, tmp_path):
    import threading

    cfg = jobs.PipelineConfig(bronze_root=str(tmp_path / "bronze"), silver_path=str(tmp_path / "silver"),
                              gold_root=str(tmp_path / "gold"))
    folder = tmp_path / "bronze" / "ingestion_date=2024-01-04" / "sales_20240104_000000.csv"
    folder.mkdir(parents=True)
    (folder / "part-00000.csv").write_text(HEADER + "1,2024-01-04,1,n,1,EUROPE,2,3.0,2024-01-04 00:00:00\n")
    reports = []
    threading.Timer(3, lambda: (folder / "_SUCCESS").write_text("")).start()
    q = start_silver_stream(spark, cfg, str(tmp_path / "ck"), reports=reports, wait_seconds=120)
    q.awaitTermination(300)
    assert q.exception() is None and [r["silver_rows"] for r in reports] == [1]


def test_stream_runs_the_chain(spark, sf001, tmp_path):
    cfg = jobs.PipelineConfig(bronze_root=str(tmp_path / "bronze"), silver_path=str(tmp_path / "silver"),
                              gold_root=str(tmp_path / "gold"))
    write_drop(bronze_from_tables(spark, sf001), cfg.bronze_root)
    reports = []
    q = start_silver_stream(spark, cfg, str(tmp_path / "ck"), reports=reports, steps=("silver", "gold"))
    q.awaitTermination(300)
    assert reports[0]["gold"]["rows"]["fact_sales"] == 4225
    with pytest.raises(ValueError):
        start_silver_stream(spark, cfg, str(tmp_path / "ck2"), steps=("gold",))


def test_watching_stream_picks_up_a_new_drop(spark, sf001, tmp_path):
    import time

    cfg = jobs.PipelineConfig(bronze_root=str(tmp_path / "bronze"), silver_path=str(tmp_path / "silver"),
                              gold_root=str(tmp_path / "gold"))
    (tmp_path / "bronze").mkdir()
    reports = []
    q = start_silver_stream(spark, cfg, str(tmp_path / "ck"), processing_time="1 second", reports=reports)
    try:
        time.sleep(2)
        assert reports == []                       # nothing has arrived yet
        write_drop(bronze_from_tables(spark, sf001), cfg.bronze_root)
        deadline = time.time() + 120
        while not reports and time.time() < deadline and q.isActive:
            time.sleep(0.5)
        assert [r["silver_rows"] for r in reports] == [4225]
    finally:
        q.stop()
