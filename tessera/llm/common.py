"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

#: Words of the contracts: runs of anything but ASCII white space (Java syntax).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, batch_rows: int = 500) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    it back: cuts the lineage, and what is stored survives lost executors.  The
    files go when the session's file system closes.  Python stages of ``df``
    get ``batch_rows`` rows at a time, so long texts keep their memory small."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(batch_rows))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, in the JVM."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: str | None) -> list[bytes]:
    """The words of a text in a Python worker, A-Z lower-cased.  ``bytes``
    methods know ASCII only, so this is WORD and ``ascii_lower`` exactly."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def worker_cache(owner: str) -> dict:
    """What ``owner`` keeps in a Python worker, across its tasks.  Spark uses a
    worker again for other stages, and an idle one keeps its memory: a task of
    another owner (one that keeps nothing, too) drops what it finds."""
    kept = sys.modules.setdefault("_tessera_worker_cache", types.ModuleType("cache")).__dict__
    if kept.get("owner") != owner:
        found = kept.pop("kept", None)
        kept["owner"], kept["kept"] = owner, {}
        if found:
            found.clear()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc: freed pages go back
                trim(0)
    return kept["kept"]
