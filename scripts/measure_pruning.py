"""Bytes and rows that a report over one quarter reads from the fact, written as
it comes and in ranges of dates; from Spark's event log.

usage: python scripts/measure_pruning.py [sf_dir]
"""
import json
import os
import sys
import tempfile
import time
from datetime import date

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.operators import analysis  # noqa: E402
from tessera.plans import jobs  # noqa: E402
from tessera.session import local_session  # noqa: E402
from tessera.sources.fixture import bronze_from_tables  # noqa: E402


def read_in(log_dir: str) -> tuple[int, int]:
    """Bytes and records that all tasks logged so far have read from files."""
    total = [0, 0]
    for folder, _, names in os.walk(log_dir):
        for name in names:
            for line in open(os.path.join(folder, name), errors="replace"):
                if '"SparkListenerTaskEnd"' in line:
                    seen = json.loads(line).get("Task Metrics", {}).get("Input Metrics", {})
                    total[0] += seen.get("Bytes Read", 0)
                    total[1] += seen.get("Records Read", 0)
    return total[0], total[1]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    work = tempfile.mkdtemp(prefix="tessera-pruning-")
    log_dir = f"{work}/events"
    os.makedirs(log_dir)
    # Merged towards 256 KB each, the fact of sf0.1 has files to skip.
    spark = local_session(8, 32, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}",
                                        "spark.eventLog.compress": "false", "spark.eventLog.buffer.kb": "1k",
                                        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512k"})
    spark.sparkContext.setCheckpointDir(f"{work}/checkpoints")
    feed = bronze_from_tables(spark, sf_dir)
    for clustered in (False, True):
        cfg = jobs.PipelineConfig(bronze_root="", silver_path=f"{work}/silver", gold_root=f"{work}/gold_{clustered}",
                                  cluster_fact=clustered)
        if not clustered:
            jobs.bronze_to_silver(spark, cfg, bronze=feed)
        took = time.time()
        rows = jobs.silver_to_gold(spark, cfg)["rows"]["fact_sales"]
        took = time.time() - took
        fact = jobs.read_published(spark, cfg, "fact_sales")
        files = len(fact.inputFiles())
        time.sleep(2)
        before = read_in(log_dir)
        analysis.by_date(analysis.between_dates(fact, date(1995, 1, 1), date(1995, 3, 31)),
                         jobs.read_published(spark, cfg, "dim_date")).collect()
        time.sleep(2)
        after = read_in(log_dir)
        print(json.dumps({"clustered": clustered, "fact_rows": rows, "files": files, "star_seconds": round(took, 2),
                          "bytes_read": after[0] - before[0], "rows_read": after[1] - before[1]}))
    spark.stop()


if __name__ == "__main__":
    main()
