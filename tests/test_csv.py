"""CSV drops: typed scan of dirty files, writer/reader round trip, newest drop."""
import math
import os
import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tessera.functions import sale_amount
from tessera.operators import cleaning
from tessera.schemas import SALES_SCHEMA, sales_schema
from tessera.sinks.drops import EmptySource, write_drop
from tessera.sources.files import NoDropFound, latest_drop, read_bronze, read_drops
from tessera.sources.fixture import bronze_from_tables

HEADER = "id,sale_date,product_id,product_name,customer_id,region,quantity,unit_price,created_at\n"


def _write(tmp_path, name, body, header=HEADER):
    p = tmp_path / name
    p.write_text(header + body, encoding="utf-8")
    return str(p)


def test_permissive_bad_fields_become_null(spark, tmp_path):
    path = _write(tmp_path, "a.csv",
                  "1,not-a-date,10,Widget,5,EUROPE,3,2.5,2024-01-01 10:00:00\n"
                  "2,2024-01-02,99999999999,Widget,5,EUROPE,1.0,x,2024-01-01 10:00:00\n"
                  "3,2024-01-03,10\n"
                  "4,2024-01-04,10,Widget,5,EUROPE,3,2.5,2024-01-01 10:00:00,extra\n"
                  '5,2024-01-05,10,"",5,   ,3,NaN,2024-01-01 10:00:00\n')
    rows = {r["id"]: r for r in read_bronze(spark, path).collect()}
    assert rows[1]["sale_date"] is None and rows[1]["product_name"] == "Widget"
    assert rows[2]["product_id"] is None and rows[2]["quantity"] is None and rows[2]["unit_price"] is None
    assert rows[3]["product_name"] is None and rows[3]["created_at"] is None
    assert rows[4]["created_at"] is not None
    assert rows[5]["product_name"] is None and rows[5]["region"] == "   "
    assert math.isnan(rows[5]["unit_price"])


def test_nan_price_passes_rules_and_amount_is_null(spark, tmp_path):
    path = _write(tmp_path, "b.csv", "5,2024-01-05,10,w,5,r,3,NaN,2024-01-01 10:00:00\n")
    df = cleaning.build_silver(read_bronze(spark, path))
    assert df.count() == 1
    assert df.select(sale_amount("quantity", "unit_price").alias("a")).first()["a"] is None


def test_quotes_and_newlines(spark, tmp_path):
    path = _write(tmp_path, "c.csv",
                  '7,2024-01-01,1,"say ""hi"", you",2,"multi\nline",1,1.0,2024-01-01 00:00:00\n')
    row = read_bronze(spark, path).first()
    assert row["product_name"] == 'say "hi", you' and row["region"] == "multi\nline"
    assert row["quantity"] == 1


def test_header_order_checked_only_when_enforced(spark, tmp_path):
    swapped = "sale_date,id,product_id,product_name,customer_id,region,quantity,unit_price,created_at\n"
    path = _write(tmp_path, "d.csv", "2024-01-01,1,1,n,1,r,1,1.0,2024-01-01 00:00:00\n", header=swapped)
    loose = read_bronze(spark, path).first()
    assert loose["id"] is None  # matched by position: the date text lands in ``id``
    with pytest.raises(Exception):
        read_bronze(spark, path, enforce_header=True).collect()


def test_inferred_types(spark, tmp_path):
    path = _write(tmp_path, "e.csv", "1,2024-01-01,1,n,1,r,1,1.5,2024-01-01 00:00:00\n")
    df = read_bronze(spark, path, schema=None)
    types = dict(df.dtypes)
    assert types["id"] == "int" and types["unit_price"] == "double" and types["sale_date"] == "date"


def test_drop_round_trip_keeps_spaces_and_nulls(spark, tmp_path):
    src = spark.createDataFrame(
        [(1, None, 2, "  padded ", 3, " ", 4, 5.5, datetime(2024, 1, 1, 12, 30))], SALES_SCHEMA)
    path = write_drop(src, str(tmp_path / "bronze"))
    assert "/ingestion_date=" in path and os.path.basename(path).startswith("sales_")
    got = read_bronze(spark, path).first()
    assert got["product_name"] == "  padded " and got["region"] == " " and got["sale_date"] is None
    assert got["created_at"] == datetime(2024, 1, 1, 12, 30)


def test_latest_drop_and_empty_guard(spark, tmp_path):
    root = str(tmp_path / "bronze")
    with pytest.raises(NoDropFound):
        latest_drop(spark, root)
    df = spark.createDataFrame([(1,)], "id int")
    old = write_drop(df, root, now=datetime(2024, 1, 1, tzinfo=timezone.utc))
    time.sleep(1.1)
    new = write_drop(df, root, now=datetime(2024, 1, 2, tzinfo=timezone.utc))
    assert latest_drop(spark, root).endswith(new.split("/")[-1])
    assert old != new
    with pytest.raises(EmptySource):
        write_drop(df.limit(0), root)


def test_read_drops_by_date(spark, tmp_path):
    from tessera.sources.files import drop_dates, read_drops

    root = str(tmp_path / "bronze")
    df = spark.createDataFrame([(1,), (2,)], "id int")
    for day in (1, 2, 3):
        write_drop(df, root, now=datetime(2024, 1, day, tzinfo=timezone.utc))
    assert drop_dates(spark, root) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    got = read_drops(spark, root, schema="id int", since="2024-01-02")
    rows = sorted((str(r["ingestion_date"]), r["id"]) for r in got.collect())
    assert rows == [("2024-01-02", 1), ("2024-01-02", 2), ("2024-01-03", 1), ("2024-01-03", 2)]
    one_day = read_drops(spark, root, schema="id int", since="2024-01-02", until="2024-01-02")
    assert sorted(r["id"] for r in one_day.collect()) == [1, 2]
    with pytest.raises(NoDropFound):
        read_drops(spark, root, schema="id int", since="2025-01-01")


def test_check_schema(spark):
    from tessera.schemas import SALES_SCHEMA, SchemaMismatch, check_schema

    df = spark.createDataFrame([], SALES_SCHEMA)
    assert check_schema(df, SALES_SCHEMA) is df
    with pytest.raises(SchemaMismatch, match="missing columns"):
        check_schema(df.drop("region"), SALES_SCHEMA)
    with pytest.raises(SchemaMismatch, match="quantity"):
        check_schema(df.withColumn("quantity", F.col("quantity").cast("string")), SALES_SCHEMA)


def test_single_file_drops_and_folders_mix(spark, tmp_path):
    """A drop written by a single-process CSV writer is one file; one written
    by Spark is a folder of parts.  Both are found and read."""
    root = tmp_path / "bronze"
    day = root / "ingestion_date=2024-01-01"
    day.mkdir(parents=True)
    single = day / "sales_20240101_000000.csv"
    single.write_text(HEADER + "1,2024-01-01,1,n,1,r,1,1.0,2024-01-01 00:00:00\n", encoding="utf-8")
    assert latest_drop(spark, str(root)) == f"file:{single}" or latest_drop(spark, str(root)).endswith(
        "sales_20240101_000000.csv")
    assert read_bronze(spark, latest_drop(spark, str(root))).count() == 1
    time.sleep(1.1)
    df = spark.createDataFrame([(2,), (3,)], "id int")
    folder = write_drop(df, str(root), now=datetime(2024, 1, 2, tzinfo=timezone.utc))
    newest = latest_drop(spark, str(root))
    assert newest.endswith(folder.split("/")[-1])
    assert read_bronze(spark, newest, schema="id int").count() == 2


def test_drop_files_are_bounded(spark, tmp_path):
    df = spark.range(0, 1000, numPartitions=2).selectExpr("cast(id as int) as id")
    path = write_drop(df, str(tmp_path / "bronze"), min_files=2, max_rows_per_file=100)
    parts = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(parts) == 10
    assert read_bronze(spark, path, schema="id int").count() == 1000


def test_latest_drop_refuses_a_folder_being_written(spark, tmp_path):
    from tessera.sources.files import IncompleteDrop

    folder = tmp_path / "ingestion_date=2024-01-01" / "sales_20240101_000000.csv"
    folder.mkdir(parents=True)
    (folder / "part-00000.csv").write_text(HEADER)
    with pytest.raises(IncompleteDrop):
        latest_drop(spark, str(tmp_path))
    assert latest_drop(spark, str(tmp_path), require_complete=False).endswith("sales_20240101_000000.csv")
    (folder / "_SUCCESS").write_text("")
    assert latest_drop(spark, str(tmp_path)).endswith("sales_20240101_000000.csv")


def test_split_reads_keep_doubled_quotes(spark, tmp_path):
    path = _write(tmp_path, "q.csv", '7,2024-01-01,1,"say ""hi"", you",2,EUROPE,1,1.0,2024-01-01 00:00:00\n')
    row = read_bronze(spark, path, multiline=False).first()
    assert row["product_name"] == 'say "hi", you' and row["region"] == "EUROPE"


def test_newest_date_folder_alone_is_listed(spark, tmp_path, monkeypatch):
    """Walking from the newest date stops at the first folder with a drop."""
    from tessera.sources import files

    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        (tmp_path / f"ingestion_date={day}").mkdir()
    old, new = (tmp_path / f"ingestion_date=2024-01-0{d}" / f"sales_2024010{d}_000000.csv" for d in (1, 2))
    new.write_text("id\n2\n")
    old.write_text("id\n1\n")
    os.utime(new, (1, 1))                                   # back-dated by its time, not by its folder
    listed = []
    real = files.list_drops
    monkeypatch.setattr(files, "list_drops", lambda s, root, date="*": listed.append(date) or real(s, root, date))
    assert files.latest_drop(spark, str(tmp_path), by_date=True).endswith(new.name)
    assert listed == ["2024-01-03", "2024-01-02"]
    assert files.latest_drop(spark, str(tmp_path)).endswith(old.name)
    with pytest.raises(files.NoDropFound):
        files.latest_drop(spark, str(tmp_path / "none"), by_date=True)


def test_drops_of_the_job_are_compressed(spark, sf001, tmp_path):
    """Fewer bytes, the same rows; a drop to be split between tasks stays plain."""
    from tessera.plans import jobs

    feed, schema = bronze_from_tables(spark, sf001), sales_schema(timestamp_ntz=True)
    size = {}
    for multiline in (True, False):
        cfg = jobs.PipelineConfig(bronze_root=str(tmp_path / str(multiline)), silver_path="", gold_root="",
                                  csv_multiline=multiline)
        path = jobs.ingest(feed, cfg)
        assert latest_drop(spark, cfg.bronze_root).endswith(os.path.basename(path))
        for found in (read_bronze(spark, path, schema=schema, multiline=multiline),
                      read_drops(spark, cfg.bronze_root, schema=schema, multiline=multiline).drop("ingestion_date")):
            assert found.exceptAll(feed).isEmpty() and feed.exceptAll(found).isEmpty()
        parts = [f for f in os.listdir(path) if f.startswith("part-")]
        assert parts and all(f.endswith(".csv.gz" if multiline else ".csv") for f in parts)
        size[multiline] = sum(os.path.getsize(f"{path}/{f}") for f in parts)
    assert size[True] < size[False] / 2
