"""Batch jobs: raw drop → cleaned table → star schema → BI database.

Each job plans its layer once, writes it to a staging folder while observing
the row-level gate counts *from that same write*, runs the key-level gates on
what was written, and only then publishes.  A failing gate raises
``GateFailure`` and leaves the previously published tables untouched.  Jobs
take the caller's session and never stop it.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators import cleaning, quality, star
from tessera.operators.keys import dense_key
from tessera.plans.parallel import run_concurrently
from tessera.schemas import SALES_SCHEMA, STAR_SCHEMAS, STAR_TABLES, check_schema
from tessera.sinks import tables as sink
from tessera.sinks.bi import BI_BATCH_SIZE, BI_WRITERS, load_star
from tessera.sinks.drops import write_drop
from tessera.sources.files import CORRUPT, latest_drop, read_bronze, read_with_corrupt, with_reasons
from tessera.sources.jdbc import JdbcConfig, probe
from tessera.sources.tables import read_table

log = logging.getLogger(__name__)


@dataclass
class PipelineConfig:
    bronze_root: str                       # folder of drops
    silver_path: str
    gold_root: str
    table_format: str = "parquet"          # "delta" when its jar is on the classpath
    catalog: str | None = None             # catalog database: tables sales, dim_*, fact_sales in it, each
                                           # run a new folder under the paths, switched to once it is checked
    bronze_schema: StructType | None = SALES_SCHEMA   # None = infer types (extra pass)
    drops_by_date: bool = False            # drops are never back-dated: look in the newest date folder only
    enforce_header: bool = False           # fail when a drop's header differs from the schema
    csv_multiline: bool = True             # False: no line breaks inside fields, files are split between tasks
    drop_compression: str | None = "gzip"  # of drops written here; those to be split stay plain
    quarantine_path: str | None = None     # keeps the records of a drop that hold an unparsable field
    strict_reference_order: bool = False   # de-duplicate before filtering
    variant: str = "standard"              # "basic": only a missing id drops a row, blanks stay
    expected_rows: int | None = None       # exact raw row count the newest drop must hold
    key_partitions: int | None = None      # range partitions for surrogate keys
    max_broadcast_bytes: int = star.DEFAULT_BROADCAST_BYTES
    null_amount_gate: bool = False         # also fail on a NULL total_amount
    reconcile_gate: bool = False           # also compare the fact with the cleaned table, as multisets
    cluster_fact: bool = False             # files of the fact by ranges of dates: one shuffle of it more
    star_as_set: bool = False              # all star tables of a run in one folder, switched by one pointer
    bi: JdbcConfig | None = None
    bi_batch_size: int = BI_BATCH_SIZE
    bi_partitions: int = BI_WRITERS

    def gold_path(self, table: str) -> str:
        return f"{self.gold_root.rstrip('/')}/{table}"

    def path(self, table: str) -> str:
        """Path of ``sales`` (the cleaned table) or of a star table."""
        return self.silver_path if table == "sales" else self.gold_path(table)

    def run_path(self, run: str, table: str) -> str:
        """Path of a star table in one run's set (``star_as_set``)."""
        return f"{self.gold_root.rstrip('/')}/{RUNS}/{run}/{table}"

    def __post_init__(self):
        sink.check_format(self.table_format)
        if self.star_as_set and (self.catalog or self.table_format in sink.TRANSACTIONAL):
            raise ValueError("star_as_set publishes plain folders: no catalog, no transactional format")


# Fixed value: folder of the runs of a star that is published as a set.
RUNS = "runs"


class NotPublished(FileNotFoundError):
    """No run of the star has been published yet."""


def read_published(spark: SparkSession, cfg: PipelineConfig, table: str) -> DataFrame:
    """The current ``sales`` (cleaned table) or star table.  Several star tables
    of one run come from ``read_star``."""
    if cfg.star_as_set and table != "sales":
        return read_star(spark, cfg, (table,))[table]
    if cfg.catalog:
        return spark.table(f"{cfg.catalog}.{table}")
    return read_table(spark, cfg.path(table), cfg.table_format)


def read_star(spark: SparkSession, cfg: PipelineConfig, tables: Sequence[str] = STAR_TABLES) -> dict[str, DataFrame]:
    """The current star tables.  Published as a set, they are all of one run,
    named by one reading of the pointer."""
    if not cfg.star_as_set:
        return {t: read_published(spark, cfg, t) for t in tables}
    run = sink.pointed_to(spark, cfg.gold_root)
    if run is None:
        raise NotPublished(f"no star published under {cfg.gold_root}")
    return {t: read_table(spark, cfg.run_path(run, t), cfg.table_format) for t in tables}


def _staging(cfg: PipelineConfig, table: str, run: str | None = None) -> str:
    run = run or uuid.uuid4().hex[:12]
    path = cfg.path(table)
    if cfg.star_as_set and table != "sales":
        return cfg.run_path(run, table)
    return f"{path.rstrip('/')}/run_{run}" if cfg.catalog else sink.staging_path(path, run)


def _check(spark: SparkSession, path: str, fmt: str, rows: int, schema: StructType) -> None:
    """The commit marker is there and the rows that were written can be read."""
    sink.verify_commit(spark, path, table_format=fmt)
    sink.verify_table(spark, path, rows, table_format=fmt, schema=schema)


def _publish(spark: SparkSession, cfg: PipelineConfig, table: str, staged: str, rows: int,
             schema: StructType, like: str | None = None) -> None:
    """Publish a staged table of ``rows`` rows.  Its rows are read where the
    table can still be taken back: ahead of a switch or a commit, but behind a
    swap of folders, which needs the marker alone ahead."""
    def check(path: str, fmt: str) -> None:
        if path == staged and cfg.table_format not in sink.TRANSACTIONAL:
            sink.verify_commit(spark, path, table_format=fmt)
        else:
            _check(spark, path, fmt, rows, schema)

    if cfg.catalog:
        _check(spark, staged, cfg.table_format, rows, schema)
        sink.switch_location(spark, f"{cfg.catalog}.{table}", staged, schema, table_format=cfg.table_format, like=like)
    else:
        sink.publish(spark, staged, cfg.path(table), table_format=cfg.table_format, schema=schema,
                     check=check)


def _one_row(parts: dict[str, DataFrame]) -> dict:
    """Collect several one-row, one-column aggregates with a single action."""
    return quality.side_by_side(parts).first().asDict()


# ------------------------------------------------------------------ ingest ---

def ingest(source: DataFrame, cfg: PipelineConfig, *, now=None, min_files: int | None = None) -> str:
    """Snapshot ``source`` (e.g. ``sources.jdbc.extract_source``) as a new drop;
    ``min_files`` spreads a source of few partitions.  A drop that is read one
    task per file anyway is compressed; one to be split stays plain."""
    compression = cfg.drop_compression if cfg.csv_multiline else None
    return write_drop(source, cfg.bronze_root, now=now, min_files=min_files, compression=compression)


def drop_checks(spark: SparkSession, path: str, cfg: PipelineConfig) -> DataFrame:
    """One row on a drop, types inferred: its rows and the products with more
    than one name.  Both come from the distinct (product, name) pairs, counted
    in one scan."""
    raw = read_bronze(spark, path, schema=None, multiline=cfg.csv_multiline)
    pairs = raw.groupBy("product_id", "product_name").agg(F.count(F.lit(1)).alias("_n"))
    per_product = pairs.groupBy("product_id").agg(F.sum("_n").alias("_n"), F.count("product_name").alias("_names"))
    return per_product.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"),
                           F.count_if(F.col("_names") > 1).alias("inconsistent_products"))


def validate_drop(spark: SparkSession, cfg: PipelineConfig) -> dict:
    """Newest drop: exact row count (if configured) and one name per product."""
    path = latest_drop(spark, cfg.bronze_root, by_date=cfg.drops_by_date)
    found = drop_checks(spark, path, cfg).first().asDict()
    gates = ["inconsistent_products"]
    if cfg.expected_rows is not None:
        found["row_count_mismatch"] = abs(found["rows"] - cfg.expected_rows)
        gates.append("row_count_mismatch")
    quality.enforce(found, gates)
    return {"path": path, **found}


# ------------------------------------------------------------------ silver ---

SILVER_ROW_GATES = ("invalid_quantity", "invalid_price")
SILVER_KEY_GATES = ("duplicate_ids", "inconsistent_products")


def _sales_buckets(spark: SparkSession, cfg: PipelineConfig) -> int | None:
    """Buckets by id of the cleaned catalog table: as many as it has, the
    session's shuffle partitions for a new one, None outside a catalog."""
    if not cfg.catalog:
        return None
    name = f"{cfg.catalog}.sales"
    if spark.catalog.tableExists(name):
        return sink.bucket_count(spark, name)
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _stage_silver(spark: SparkSession, cfg: PipelineConfig, bronze: DataFrame, silver: DataFrame,
                  seen: Observation, staged: str, source: str | None, bucketed: str | None) -> dict:
    """Write the cleaned table to ``staged`` and run every gate on it.  As
    catalog table ``bucketed`` it is bucketed by id, so that the duplicate gate
    (here, and for the star) needs no shuffle of the ids."""
    check_schema(silver, SALES_SCHEMA)
    fmt = sink.staging_format(cfg.table_format)
    metrics = [F.count_if(c.violates).alias(c.name) for c in (quality.invalid_quantity(), quality.invalid_price())]
    if bucketed:
        written = sink.write_bucketed(silver, bucketed, staged, "id", _sales_buckets(spark, cfg),
                                      table_format=fmt, metrics=metrics)
        stored = spark.table(bucketed)
    else:
        written = sink.write_table(silver, staged, table_format=fmt, metrics=metrics)
        stored = sink.read_back(spark, staged, silver.schema, table_format=fmt)
    bronze_rows = int(seen.get["bronze_rows"])
    keys = _one_row({
        "duplicate_ids": quality.duplicate_keys(stored, "id"),
        "inconsistent_products": quality.inconsistent_mappings(stored, "product_id", "product_name"),
    })
    report = {"source": source, "bronze_rows": bronze_rows, "silver_rows": written["rows"],
              "rows_removed": bronze_rows - written["rows"], **{g: written[g] for g in SILVER_ROW_GATES},
              **keys}
    gates = list(SILVER_ROW_GATES) + list(SILVER_KEY_GATES)
    if cfg.expected_rows is not None:
        # ``bronze_rows`` is observed in the map stage before the de-duplication
        # shuffle; a re-run map stage (lost executor) can only make it larger.
        # A gate must be exact, so a mismatch is confirmed by a real count.
        if bronze_rows != cfg.expected_rows:
            bronze_rows = report["bronze_rows"] = bronze.count()
            report["rows_removed"] = bronze_rows - written["rows"]
        report["row_count_mismatch"] = abs(bronze_rows - cfg.expected_rows)
        gates.append("row_count_mismatch")
    log.info("cleaned layer gates: %s", {g: report[g] for g in gates})
    quality.enforce(report, gates)
    return report


def _quarantine(kept: DataFrame, cfg: PipelineConfig, *, found: int) -> dict:
    """Store the corrupt records of a drop, with what is wrong in each.  They
    were counted in the read that cleaned it; only a drop that holds some is
    read again for them.  The rows that PERMISSIVE made of them are cleaned as
    any others, and dropped when a critical field is the bad one."""
    spark = kept.sparkSession
    if not found:
        sink.discard(spark, cfg.quarantine_path)
        return {"corrupt_rows": 0, "corrupt_reasons": {}}
    written = sink.write_table(with_reasons(kept, cfg.bronze_schema), cfg.quarantine_path)
    stored = sink.read_back(spark, cfg.quarantine_path, written["schema"])
    reasons = stored.select(F.explode("reasons").alias("reason")).groupBy("reason").count().collect()
    return {"corrupt_rows": written["rows"], "corrupt_reasons": {r["reason"]: r["count"] for r in reasons}}


def bronze_to_silver(spark: SparkSession, cfg: PipelineConfig, *, bronze: DataFrame | None = None) -> dict:
    """Newest drop → cleaned table.  One pass reads, cleans, writes and counts;
    one more job checks keys on the written files.

    Counts observed in the write's final stage (rows written, violations) are
    exact.  ``bronze_rows`` is observed before the shuffle: exact unless a map
    stage is re-run after an executor loss, when it can only over-count; it is
    a report, and the exact-row-count gate re-counts before failing."""
    source, kept = None, None
    if bronze is None:
        source = latest_drop(spark, cfg.bronze_root, by_date=cfg.drops_by_date)
        how = {"enforce_header": cfg.enforce_header, "multiline": cfg.csv_multiline}
        if cfg.quarantine_path and cfg.bronze_schema:
            kept = bronze = read_with_corrupt(spark, source, schema=cfg.bronze_schema, **how)
        else:
            bronze = read_bronze(spark, source, schema=cfg.bronze_schema, **how)
    seen = Observation()
    counts = [F.count_if(F.col(CORRUPT).isNotNull()).alias("corrupt_rows")] if kept else []
    observed = bronze.observe(seen, F.count(F.lit(1)).alias("bronze_rows"), *counts).drop(CORRUPT)
    if cfg.variant == "basic":
        silver = cleaning.build_silver_basic(observed)
    elif cfg.variant == "standard":
        silver = cleaning.build_silver(observed, strict_reference_order=cfg.strict_reference_order)
    else:
        raise ValueError(f"unknown cleaning variant {cfg.variant!r}")
    staged = _staging(cfg, "sales")
    bucketed = f"{cfg.catalog}.sales__{uuid.uuid4().hex[:12]}" if _sales_buckets(spark, cfg) else None
    log.info("cleaned layer: reading %s", source or "given raw rows")
    try:
        report = _stage_silver(spark, cfg, bronze, silver, seen, staged, source, bucketed)
        if kept:
            report |= _quarantine(kept, cfg, found=int(seen.get["corrupt_rows"]))
        _publish(spark, cfg, "sales", staged, report["silver_rows"], silver.schema, like=bucketed)
    except Exception:
        sink.discard(spark, staged)  # a failed write, gate or publish leaves nothing behind
        raise
    finally:
        if bucketed:
            spark.sql(f"DROP TABLE IF EXISTS {bucketed}")  # the name only: the files are the published table's
    log.info("cleaned layer published: %s raw rows -> %s rows", report["bronze_rows"], report["silver_rows"])
    return report


# -------------------------------------------------------------------- gold ---

# Columns the fact shares with the cleaned table.
RECONCILED = ("sale_id", "quantity", "unit_price", "created_at")
FACT_ROW_GATES = tuple(f"null_{k}" for k in quality.FACT_KEY_COLUMNS) + ("negative_amount",)


def build_star(silver: DataFrame, cfg: PipelineConfig, staged: dict[str, str]) -> dict:
    """Write the four dimensions, then the fact from the *stored* dimensions
    (keys in fact and dimensions come from the same files).  Returns the
    observed metrics of every write."""
    spark = silver.sparkSession
    fmt = sink.staging_format(cfg.table_format)
    metrics: dict[str, dict] = {}

    def product() -> dict:
        # The product-name gate rides on the dimension build: the name and the
        # number of names come from the same distinct pairs.
        base = star.product_names(silver).groupBy("product_id").agg(
            F.min("product_name").alias("product_name"),
            (F.count("product_name") > 1).alias("_several_names"))
        keyed = dense_key(base, "product_id", "product_key", partitions=cfg.key_partitions)
        seen = Observation()
        out = (keyed.observe(seen, F.count_if(F.col("_several_names")).alias("inconsistent_products"))
                    .select("product_key", "product_id", "product_name"))
        return {**write_dim("dim_product", out),
                "inconsistent_products": int(seen.get["inconsistent_products"])}

    def write_dim(table: str, dim: DataFrame) -> dict:
        check_schema(dim, STAR_SCHEMAS[table])
        return sink.write_table(dim, staged[table], table_format=fmt)

    builders = {
        "dim_date": lambda: write_dim("dim_date", star.dim_date(silver).orderBy("date_key")),
        "dim_product": product,
        "dim_customer": lambda: write_dim("dim_customer",
                                          star.dim_customer(silver, partitions=cfg.key_partitions)),
        "dim_region": lambda: write_dim("dim_region", star.dim_region(silver, partitions=cfg.key_partitions)),
    }
    # Fact sale ids are the cleaned ids: the fact is the cleaned table LEFT
    # JOINed to dimensions, which can only add rows, never drop them, so once
    # the grain gate (fact rows = cleaned rows) holds, duplicate sale ids in the
    # fact are exactly duplicate ids in the cleaned table.  Counting them here
    # overlaps that shuffle with the dimension builds instead of running it
    # after the fact write.
    builders["duplicate_sale_ids"] = lambda: _one_row(
        {"duplicate_sale_ids": quality.duplicate_keys(silver, "id")})
    # The dimensions (and that check) are independent: their jobs are
    # submitted together and share the executors (each is small next to the fact).
    metrics.update(run_concurrently(spark, builders))

    stored = {t: sink.read_back(spark, staged[t], metrics[t]["schema"], table_format=fmt)
              for t in STAR_TABLES if t != "fact_sales"}
    seen = Observation()
    # Dealt by date before the lookups, as a sample of the stored table costs
    # less than one of the joined fact; the sample is not to be observed.
    dealt = star.in_date_ranges(silver) if cfg.cluster_fact else silver
    fact = star.fact_sales(dealt.observe(seen, F.count(F.lit(1)).alias("silver_rows")),
                           stored["dim_product"], stored["dim_customer"], stored["dim_region"],
                           dim_rows={t: m["rows"] for t, m in metrics.items() if t.startswith("dim_")},
                           max_broadcast_bytes=cfg.max_broadcast_bytes)
    if cfg.cluster_fact:
        fact = fact.sortWithinPartitions("date_key", "sale_id")
    check_schema(fact, STAR_SCHEMAS["fact_sales"])
    checks = ([quality.null_key(k) for k in quality.FACT_KEY_COLUMNS]
              + [quality.negative_amount(), quality.null_amount()])
    metrics["fact_sales"] = sink.write_table(
        fact, staged["fact_sales"], table_format=fmt,
        metrics=[F.count_if(c.violates).alias(c.name) for c in checks])
    # Seen below the joins: with a shuffled join that is a map stage, which a
    # lost executor can run twice, so a difference is confirmed by a count.
    silver_rows = int(seen.get["silver_rows"])
    if silver_rows != metrics["fact_sales"]["rows"]:
        silver_rows = silver.count()
    metrics["fact_sales"]["silver_rows"] = silver_rows
    return metrics


def _publish_star(spark: SparkSession, cfg: PipelineConfig, run: str, staged: dict[str, str],
                  rows: dict[str, int], schemas: dict[str, StructType]) -> None:
    if cfg.star_as_set:
        # Nothing of the run can be seen before its pointer, so a failure up to
        # there leaves readers wholly on the old star.
        run_concurrently(spark, {t: (lambda t=t: _check(spark, staged[t], cfg.table_format, rows[t], schemas[t]))
                                 for t in STAR_TABLES})
        sink.point_to(spark, cfg.gold_root, run)
        return
    # Dimensions first, the fact last: a reader never sees a fact whose keys
    # are missing from the published dimensions of the same run.
    run_concurrently(spark, {t: (lambda t=t: _publish(spark, cfg, t, staged[t], rows[t], schemas[t]))
                             for t in STAR_TABLES if t != "fact_sales"})
    _publish(spark, cfg, "fact_sales", staged["fact_sales"], rows["fact_sales"], schemas["fact_sales"])


def silver_to_gold(spark: SparkSession, cfg: PipelineConfig) -> dict:
    """Cleaned table → star schema (4 dimensions + fact), gated, then published."""
    silver = read_published(spark, cfg, "sales")
    run = uuid.uuid4().hex[:12]
    staged = {t: _staging(cfg, t, run) for t in STAR_TABLES}
    try:
        m = build_star(silver, cfg, staged)
        dup = m["duplicate_sale_ids"]
        fm = m["fact_sales"]
        schemas = {t: m[t]["schema"] for t in STAR_TABLES}
        report = {
            "rows": {t: m[t]["rows"] for t in STAR_TABLES},
            "silver_rows": fm["silver_rows"],
            "grain_difference": abs(fm["silver_rows"] - fm["rows"]),
            "inconsistent_products": m["dim_product"]["inconsistent_products"],
            **{g: fm[g] for g in FACT_ROW_GATES}, **dup,
        }
        report["null_amount"] = fm["null_amount"]
        gates = ["inconsistent_products", "grain_difference", *FACT_ROW_GATES, "duplicate_sale_ids"]
        gates += ["null_amount"] if cfg.null_amount_gate else []
        if cfg.reconcile_gate:
            fact = sink.read_back(spark, staged["fact_sales"], schemas["fact_sales"],
                                  table_format=sink.staging_format(cfg.table_format))
            report |= quality.reconcile_by_fingerprint(silver.withColumnRenamed("id", "sale_id"), fact,
                                                       RECONCILED).first().asDict()
            gates += ["missing_rows", "extra_rows"]
        log.info("star gates: %s", {g: report[g] for g in gates})
        quality.enforce(report, gates)
        _publish_star(spark, cfg, run, staged, report["rows"], schemas)
    except Exception:
        for p in staged.values():  # of tables switched to already, the folder is the table's
            if not _in_use(spark, cfg, p):
                sink.discard(spark, p)
        raise
    log.info("star published: %s", report["rows"])
    return report


def _in_use(spark: SparkSession, cfg: PipelineConfig, path: str) -> bool:
    if not cfg.catalog:
        return False
    name = f"{cfg.catalog}.{path.rstrip('/').split('/')[-2]}"
    return spark.catalog.tableExists(name) and sink.location(spark, name).rstrip("/").endswith(path.rstrip("/"))


def remove_old_runs(spark: SparkSession, cfg: PipelineConfig, *, keep: int = 2, older_than_hours: float = 24) -> list[str]:
    """Delete what earlier runs have left and nothing reads any more; returns
    the deleted folders.

    Runs of a star published as a set, and run folders of catalog tables: the
    current one and the newest ``keep - 1`` others stay, and so does whatever
    changed in the last ``older_than_hours``, for runs being written and queries
    still on an old one.  Staging folders of interrupted runs go by age alone."""
    least, gone = older_than_hours * 3600, []

    def remove(root: str, names: Sequence[str]):
        for name in names:
            sink.discard(spark, f"{root}/{name}")
            gone.append(f"{root}/{name}")

    def old(root: str, prefix: str, current: str | None) -> list[str]:
        found = [(n, age) for n, age in sink.folders(spark, root) if n.startswith(prefix) and n != current]
        return [n for n, age in found[max(0, keep - 1):] if age >= least]

    gold = cfg.gold_root.rstrip("/")
    if cfg.star_as_set:
        current = sink.pointed_to(spark, gold)
        remove(f"{gold}/{RUNS}", old(f"{gold}/{RUNS}", "", current))
    for table in ("sales", *STAR_TABLES):
        path = cfg.path(table).rstrip("/")
        if cfg.catalog and spark.catalog.tableExists(f"{cfg.catalog}.{table}"):
            current = sink.location(spark, f"{cfg.catalog}.{table}").rstrip("/").rsplit("/", 1)[-1]
            remove(path, old(path, "run_", current))
        parent, name = path.rsplit("/", 1)
        remove(parent, [n for n, age in sink.folders(spark, parent)
                        if n.startswith(f"{name}.__staging_") and age >= least])
    return gone


# ---------------------------------------------------------------------- BI ---

def gold_to_bi(spark: SparkSession, cfg: PipelineConfig) -> dict:
    """Load the published star into the BI database and reconcile counts."""
    if cfg.bi is None:
        raise ValueError("no BI database configured")
    probe(spark, cfg.bi)
    tables = read_star(spark, cfg)
    expected = _one_row({t: df.agg(F.count(F.lit(1))) for t, df in tables.items()})
    return load_star(spark, tables, cfg.bi, expected, batch_size=cfg.bi_batch_size,
                     num_partitions=cfg.bi_partitions)


# ------------------------------------------------------------ inspection ---

def validate_silver(spark: SparkSession, cfg: PipelineConfig) -> dict:
    """Report (never raise): schema, raw vs cleaned rows, duplicate ids, NULLs
    per column, invalid quantities and prices of the stored cleaned table."""
    silver = read_published(spark, cfg, "sales")
    raw = read_bronze(spark, latest_drop(spark, cfg.bronze_root, by_date=cfg.drops_by_date), schema=None, multiline=cfg.csv_multiline)
    checks = [f() for f in quality.SALES_ROW_CHECKS]
    # Violations and the NULL profile are plain aggregates: one scan for both.
    null_checks = [quality.Check(f"_null_{c}", F.col(c).isNull()) for c in silver.columns]
    row = quality.count_violations(silver, checks + null_checks).first().asDict()
    counts = _one_row({"bronze_rows": raw.agg(F.count(F.lit(1))),
                       "duplicate_ids": quality.duplicate_keys(silver, "id")})
    nulls = {c: row[f"_null_{c}"] for c in silver.columns}
    return {"schema": [(f.name, f.dataType.simpleString(), f.nullable) for f in silver.schema.fields],
            "bronze_rows": counts["bronze_rows"], "silver_rows": row["rows"],
            "rows_removed": counts["bronze_rows"] - row["rows"], "duplicate_ids": counts["duplicate_ids"],
            "nulls": nulls, **{c.name: row[c.name] for c in checks}}


def diagnose_mapping(spark: SparkSession, cfg: PipelineConfig, *, limit: int = 100,
                     report_path: str | None = None) -> dict:
    """Products with more than one name in the cleaned table (worst first).
    The result holds ``limit`` rows to look at; ``report_path`` gets them all,
    as Parquet."""
    silver = read_published(spark, cfg, "sales")
    # How many products are inconsistent and the worst case, from one aggregation.
    per_product = silver.groupBy("product_id").agg(F.count_distinct("product_name").alias("_n"))
    summary = per_product.agg(
        F.count_if(F.col("_n") > 1).alias("inconsistent_products"),
        F.max(F.when(F.col("_n") > 1, F.col("_n"))).cast("long").alias("max_names")).first().asDict()
    report = quality.mapping_report(silver, "product_id", "product_name")
    if report_path:
        report.write.mode("overwrite").parquet(report_path)
    return {**summary, "preview": [r.asDict() for r in report.limit(limit).collect()]}


def inspect_gold(spark: SparkSession, cfg: PipelineConfig, *, preview: int = 5) -> dict:
    """Row count, schema and a few rows of every star table."""
    out = {}
    for t, df in read_star(spark, cfg).items():
        out[t] = {"rows": df.count(), "schema": [tuple(r) for r in sink.describe_table(df).collect()],
                  "preview": [r.asDict() for r in df.limit(preview).collect()]}
    return out


def run_pipeline(spark: SparkSession, cfg: PipelineConfig, *, source: DataFrame | None = None) -> dict:
    """Optional ingest, then cleaned → star → BI, stopping at the first failure."""
    report = {}
    if source is not None:
        report["drop"] = ingest(source, cfg)
    report["silver"] = bronze_to_silver(spark, cfg)
    report["gold"] = silver_to_gold(spark, cfg)
    if cfg.bi is not None:
        report["bi"] = gold_to_bi(spark, cfg)
    return report


# ---------------------------------------------------------- health checks ---

# The three rows of the storage round trip.
ROUND_TRIP_ROWS = [(1, "Bronze"), (2, "Silver"), (3, "Gold")]


def storage_check(spark: SparkSession, path: str, *, table_format: str = "parquet") -> dict:
    """Write three known rows to ``path`` (schema fixed), read them back, and
    check the count and the commit marker -- the storage round trip a
    deployment runs before trusting a new bucket or table format."""
    rows = spark.createDataFrame(ROUND_TRIP_ROWS, "id long, layer string")
    written = sink.write_table(rows, path, table_format=table_format, replace_schema=False)
    stored = sink.verify_table(spark, path, len(ROUND_TRIP_ROWS), table_format=table_format,
                               schema=written["schema"])
    sink.verify_commit(spark, path, table_format=table_format)
    return {"path": path, "written": written["rows"], "read_back": stored}


def bi_check(spark: SparkSession, cfg: JdbcConfig, *, identity_sql: str | None = None) -> dict:
    """The BI database answers: the probe query runs, and optionally an
    identity query (PostgreSQL: ``SELECT current_database() AS db,
    current_user AS usr``) whose single row is returned."""
    probe(spark, cfg)
    out: dict = {"reachable": True}
    if identity_sql:
        from tessera.sources.jdbc import jdbc_query
        out.update(jdbc_query(spark, cfg, identity_sql).first().asDict())
    return out


def register_views(spark: SparkSession, cfg: PipelineConfig, *, prefix: str = "") -> list[str]:
    """Expose the published cleaned table and star as temporary views
    (``sales`` plus the five star tables, optionally prefixed), so analysts
    can query them with ``spark.sql``.  Nothing is read until a query runs."""
    names = []
    if cfg.silver_path:
        read_published(spark, cfg, "sales").createOrReplaceTempView(f"{prefix}sales")
        names.append(f"{prefix}sales")
    if cfg.gold_root:
        for t, df in read_star(spark, cfg).items():
            df.createOrReplaceTempView(f"{prefix}{t}")
            names.append(f"{prefix}{t}")
    return names
