"""What an operator keeps in a reused Python worker goes with the next operator's task."""
import os

import pyarrow as pa

from tessera.llm.common import worker_cache


def resident_mb() -> float:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6


def test_one_owner_at_a_time():
    mine = worker_cache("packing")
    mine["encoder"] = object()
    assert worker_cache("packing") is mine and "encoder" in mine
    assert worker_cache("quality") == {} and mine == {}
    assert worker_cache("packing") == {}


def test_memory_is_given_back():
    words = worker_cache("packing").setdefault("words", {})
    words.update((f"word {i}", str(i).encode()) for i in range(1_000_000))
    del words
    full = resident_mb()
    worker_cache("quality")
    assert resident_mb() < full - 60


def test_a_worker_of_the_quality_stage_keeps_no_other_cache(spark, sf001):
    """Fills the workers' caches, scores documents, and looks into the workers
    that are still there."""
    from tessera.llm.quality import _views

    def fill(batches):
        for batch in batches:
            worker_cache("packing")["words"] = {"a": 1}
            yield batch

    def look(batches):
        import sys
        for batch in batches:
            kept = sys.modules.get("_tessera_worker_cache")
            yield pa.RecordBatch.from_arrays([pa.array([os.getpid()]), pa.array(["words" in getattr(kept, "kept", {})])],
                                             names=["pid", "full"])

    spark.range(0, 8, 1, 1).mapInArrow(fill, "id long").collect()
    one = spark.range(0, 1, 1, 1)
    before = {r.pid: r.full for r in one.mapInArrow(look, "pid long, full boolean").collect()}
    docs = spark.read.parquet(f"{sf001}/documents.parquet").coalesce(1)
    for _ in range(20):  # a free worker takes each task, in turn
        _views(docs.limit(5)).collect()
    after = {r.pid: r.full for r in one.mapInArrow(look, "pid long, full boolean").collect()}
    assert not any(after.values()), (before, after)
