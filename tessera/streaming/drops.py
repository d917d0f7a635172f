"""New drops → cleaned table, driven by Structured Streaming.

The batch job finds the newest drop by listing the drop folder on each run.
Here a file stream over the drop folder is the *arrival signal*: its
checkpoint remembers which drop files have been seen, so a run does work only
when something new arrived, and a crashed run resumes where it stopped.

The micro-batch itself is never read.  A batch may hold only part of a drop
(a drop still being committed, or ``maxFilesPerTrigger``), so each batch looks
up the newest drop as the batch job does (``latest_drop``) and hands the
*whole* drop to the ordinary gated ``bronze_to_silver`` job (a drop is a full
snapshot, so older drops are superseded).  If the newest drop is still being
written the batch waits for it up to ``wait_seconds``; then it fails, is not
committed to the checkpoint, and is retried by the next run -- no partial
snapshot is ever published.
"""

from __future__ import annotations

import logging
import time
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tessera.plans import jobs
from tessera.schemas import SALES_SCHEMA
from tessera.sources.files import (DROP_PARTITION, DROP_PREFIX, IncompleteDrop, csv_options, latest_drop,
                                  read_bronze)

log = logging.getLogger(__name__)


def drop_stream(spark: SparkSession, cfg: jobs.PipelineConfig, *, max_files_per_trigger: int | None = None
                ) -> DataFrame:
    """Streaming scan of every drop file under ``cfg.bronze_root`` -- the
    arrival signal (its rows are not read by ``start_silver_stream``)."""
    # A stream cannot infer types: without a configured schema, the sales schema.
    reader = spark.readStream.options(**csv_options(multiline=cfg.csv_multiline)).schema(cfg.bronze_schema or SALES_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(f"{cfg.bronze_root.rstrip('/')}/{DROP_PARTITION}=*/{DROP_PREFIX}*")


STEPS = ("silver", "gold", "bi")


def start_silver_stream(spark: SparkSession, cfg: jobs.PipelineConfig, checkpoint: str, *,
                        available_now: bool = True, processing_time: str | None = None,
                        reports: list | deque | None = None, steps: tuple[str, ...] = ("silver",),
                        wait_seconds: float | None = None) -> StreamingQuery:
    """Start the drop → cleaned-table stream.

    ``available_now`` processes what is there and stops (a scheduled run);
    ``processing_time`` (e.g. ``"1 hour"``) keeps watching.  ``checkpoint``
    must be a shared folder; it holds the list of processed drop files.
    ``steps`` extends each run down the chain: ``("silver", "gold")`` rebuilds
    the star after the cleaned table, ``("silver", "gold", "bi")`` also loads
    the BI database -- in order, stopping at the first failure.
    ``wait_seconds`` is how long a batch waits for a drop still being written:
    by default an hour while watching, not at all in a scheduled run.
    ``reports`` gets one entry a batch; pass a ``deque`` of bounded length to a
    stream that runs on."""
    unknown = [s for s in steps if s not in STEPS]
    if unknown or not steps or steps[0] != "silver":
        raise ValueError(f"steps must start with 'silver' and use {STEPS}: {steps}")

    if wait_seconds is None:
        wait_seconds = 3600 if processing_time else 0

    def newest_drop(session: SparkSession) -> str:
        deadline = time.monotonic() + wait_seconds
        while True:
            try:
                return latest_drop(session, cfg.bronze_root)
            except IncompleteDrop as exc:
                if time.monotonic() >= deadline:
                    raise
                log.info("waiting: %s", exc)
                time.sleep(min(5.0, max(0.1, wait_seconds / 20)))

    def process(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        newest = newest_drop(session)
        bronze = read_bronze(session, newest, schema=cfg.bronze_schema or SALES_SCHEMA,
                             enforce_header=cfg.enforce_header, multiline=cfg.csv_multiline)
        report = jobs.bronze_to_silver(session, cfg, bronze=bronze)
        report["source"] = newest
        if "gold" in steps:
            report["gold"] = jobs.silver_to_gold(session, cfg)
        if "bi" in steps:
            report["bi"] = jobs.gold_to_bi(session, cfg)
        if reports is not None:
            reports.append({"epoch": epoch, **report})

    writer = drop_stream(spark, cfg).writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
