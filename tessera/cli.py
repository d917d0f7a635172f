"""Command line for ``spark-submit``: one sub-command per job.

    spark-submit --py-files tessera.zip tessera/cli.py silver \\
        --bronze s3a://lake/bronze/sales --silver s3a://lake/silver/sales --gold s3a://lake/gold

The session comes from ``spark-submit`` (cluster, memory, object-store and
checkpoint settings); the command only adds the job's paths.  Exit code is
non-zero when a job or a gate fails, so a scheduler stops the chain.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections import deque

from pyspark.sql import SparkSession

from tessera.plans import jobs
from tessera.sinks.bi import BI_BATCH_SIZE, BI_WRITERS
from tessera.sources.jdbc import (BI_ENV_PREFIX, SOURCE_ENV_PREFIX, SOURCE_READERS, extract_source,
                                  postgres_from_env)
from tessera.sources.s3a import s3a_conf


# Which paths each command needs.
_NEEDS = {"ingest": (), "validate-drop": (), "silver": ("silver",), "gold": ("silver", "gold"),
          "bi": ("gold",), "validate": ("silver",), "diagnose": ("silver",), "inspect": ("gold",),
          "pipeline": ("silver", "gold"), "stream": ("silver",), "storage-check": ("gold",),
          "bi-check": (), "clean": ("silver", "gold")}


def _config(args) -> jobs.PipelineConfig:
    missing = [f"--{name}" for name in _NEEDS[args.command] if not getattr(args, name)]
    if args.command == "stream" and "gold" in args.steps.split(",") and not args.gold:
        missing.append("--gold")
    if missing:
        raise SystemExit(f"tessera {args.command}: missing {', '.join(missing)}")
    cfg = jobs.PipelineConfig(bronze_root=args.bronze, silver_path=args.silver, gold_root=args.gold,
                              table_format=args.format, expected_rows=args.expected_rows,
                              strict_reference_order=args.strict_order, variant=args.variant,
                              key_partitions=args.key_partitions, enforce_header=args.enforce_header,
                              null_amount_gate=args.null_amount_gate, csv_multiline=not args.single_line,
                              quarantine_path=args.quarantine, drops_by_date=args.drops_by_date,
                              cluster_fact=args.cluster_fact, star_as_set=args.star_set,
                              reconcile_gate=args.reconcile, catalog=args.catalog, bi_partitions=args.bi_partitions,
                              bi_batch_size=args.bi_batch_size)
    if args.command in ("bi", "pipeline", "stream") and args.with_bi:
        cfg.bi = postgres_from_env(prefix=BI_ENV_PREFIX)
    return cfg


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="tessera")
    p.add_argument("command", choices=["ingest", "validate-drop", "silver", "gold", "bi", "validate",
                                       "diagnose", "inspect", "pipeline", "stream", "storage-check",
                                       "bi-check", "clean"])
    p.add_argument("--bronze", required=True, help="folder of raw drops")
    p.add_argument("--silver", default="", help="cleaned table path")
    p.add_argument("--gold", default="", help="folder of the star tables")
    p.add_argument("--format", default="parquet", help="table format (parquet, delta, ...)")
    p.add_argument("--expected-rows", type=int, default=None)
    p.add_argument("--strict-order", action="store_true", help="de-duplicate before filtering")
    p.add_argument("--variant", default="standard", choices=["standard", "basic"])
    p.add_argument("--key-partitions", type=int, default=None)
    p.add_argument("--enforce-header", action="store_true",
                   help="fail when a drop's header differs from the schema")
    p.add_argument("--null-amount-gate", action="store_true",
                   help="also fail the star on a NULL total_amount")
    p.add_argument("--single-line", action="store_true",
                   help="no CSV field holds a line break: split drop files between tasks")
    p.add_argument("--catalog", default=None,
                   help="catalog database whose tables are switched to each run's folders")
    p.add_argument("--report", default=None, help="diagnose: folder for the whole report (Parquet)")
    p.add_argument("--quarantine", default=None, help="folder for records with unparsable fields")
    p.add_argument("--drops-by-date", action="store_true",
                   help="drops are never back-dated: list the newest date folder only")
    p.add_argument("--cluster-fact", action="store_true", help="write the fact in ranges of dates")
    p.add_argument("--star-set", action="store_true", help="publish the star tables as one set")
    p.add_argument("--reconcile", action="store_true", help="also compare the fact with the cleaned table")
    p.add_argument("--keep-runs", type=int, default=2, help="clean: runs to keep, the current one included")
    p.add_argument("--older-than-hours", type=float, default=24, help="clean: younger folders stay")
    p.add_argument("--s3a", action="store_true",
                   help="take the object-store settings from the environment (see tessera.sources.s3a)")
    p.add_argument("--source-partitions", type=int, default=SOURCE_READERS,
                   help="ingest: parallel cursors on the source table")
    p.add_argument("--bi-partitions", type=int, default=BI_WRITERS, help="concurrent writers of the BI load")
    p.add_argument("--bi-batch-size", type=int, default=BI_BATCH_SIZE, help="rows per insert of the BI load")
    p.add_argument("--source-table", default="sales")
    p.add_argument("--sort-drop", action="store_true",
                   help="write the drop in id order (a range-partitioned sort of the whole source)")
    p.add_argument("--with-bi", action="store_true", help="load the BI database (BI_DB_* variables)")
    p.add_argument("--stream-checkpoint", default="",
                   help="stream: shared folder for the stream's progress (required)")
    p.add_argument("--steps", default="silver",
                   help="stream: comma-separated chain run per new drop (silver[,gold[,bi]])")
    p.add_argument("--every", default=None,
                   help="stream: keep watching, one trigger per interval (e.g. '1 hour'); "
                        "default: process what has arrived and stop")
    args = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO)

    cfg = _config(args)   # fail on missing arguments before starting anything
    builder = SparkSession.builder.appName(f"tessera-{args.command}")
    for key, value in (s3a_conf() if args.s3a else {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        if args.command == "ingest":
            src = extract_source(spark, postgres_from_env(prefix=SOURCE_ENV_PREFIX, schema=None),
                                 args.source_table, num_partitions=args.source_partitions)
            out = {"drop": jobs.ingest(src.orderBy("id") if args.sort_drop else src, cfg)}
        elif args.command == "validate-drop":
            out = jobs.validate_drop(spark, cfg)
        elif args.command == "silver":
            out = jobs.bronze_to_silver(spark, cfg)
        elif args.command == "gold":
            out = jobs.silver_to_gold(spark, cfg)
        elif args.command == "bi":
            out = jobs.gold_to_bi(spark, cfg)
        elif args.command == "validate":
            out = jobs.validate_silver(spark, cfg)
        elif args.command == "diagnose":
            out = jobs.diagnose_mapping(spark, cfg, report_path=args.report)
        elif args.command == "inspect":
            out = jobs.inspect_gold(spark, cfg)
        elif args.command == "clean":
            out = {"removed": jobs.remove_old_runs(spark, cfg, keep=args.keep_runs,
                                                   older_than_hours=args.older_than_hours)}
        elif args.command == "storage-check":
            out = jobs.storage_check(spark, f"{args.gold.rstrip('/')}/_storage_check", table_format=args.format)
        elif args.command == "bi-check":
            out = jobs.bi_check(spark, postgres_from_env(prefix=BI_ENV_PREFIX),
                                identity_sql="SELECT current_database() AS db, current_user AS usr")
        elif args.command == "stream":
            from tessera.streaming.drops import start_silver_stream

            if not args.stream_checkpoint:
                raise ValueError("--stream-checkpoint is required")
            reports: deque = deque(maxlen=100)   # of a stream that runs on, the last ones
            q = start_silver_stream(spark, cfg, args.stream_checkpoint, processing_time=args.every,
                                    reports=reports, steps=tuple(args.steps.split(",")))
            q.awaitTermination()
            out = {"batches": list(reports)}
        else:
            out = jobs.run_pipeline(spark, cfg)
        print(json.dumps(out, default=str, indent=2))
        return 0
    except Exception as exc:  # report and fail the process; the session is the caller's
        logging.error("%s failed: %s", args.command, exc)
        return 1


if __name__ == "__main__":
    sys.exit(main())
