"""One pipeline run (V13-V16, S5-S14, C1-C6): extract → validate → archive → load raw and
quarantine → merge core → statistics.

Every stage is a Spark job over DataFrames; the driver only holds counts and the run id.
The validated batch is handed to the next stages as a written table in the shared
checkpoint folder, so a lost executor re-reads it instead of recomputing the batch, and
every write replaces its own ``run_id`` partition or publishes a new snapshot, so a
retried run does not duplicate rows."""

from __future__ import annotations

import datetime as _dt
import os
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import CONTAINER_INVALID, CONTAINER_PROCESSED, CONTAINER_RAW
from ..operators.core import TS_TEXT, merge_snapshot, watermark_filter
from ..operators.staging import stg_contacts
from ..operators.validate import split, validate
from ..schema import CONTACT_COLUMNS, CONTACT_SCHEMA, QUARANTINE_SCHEMA, RUN_AUDIT_SCHEMA
from ..session import ensure_utc, scratch_path
from ..sources import corestore, readers, sinks
from .model import Outcome, outcome_rows, run_model


def new_run_id(now: _dt.datetime | None = None) -> str:
    """``yyyyMMdd_HHmmss_<8 hex>`` (driver-side literal)."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return now.strftime("%Y%m%d_%H%M%S") + "_" + uuid.uuid4().hex[:8]


@dataclass
class RunStats:
    """V14 / run audit row."""
    run_id: str
    total: int = 0
    valid: int = 0
    invalid: int = 0
    raw_loaded: int = 0
    quarantined: int = 0
    core_merged: int = 0
    model_run: bool = False


@dataclass
class Warehouse:
    """Table locations of one deployment."""
    root: str

    @property
    def raw(self):
        return os.path.join(self.root, "contacts_raw")

    @property
    def quarantine(self):
        return os.path.join(self.root, "contacts_quarantine")

    @property
    def core(self):
        return os.path.join(self.root, "core_contacts")

    @property
    def audit(self):
        return os.path.join(self.root, "run_audit")

    @property
    def marts(self):
        return os.path.join(self.root, "marts")

    @property
    def model_runs(self):
        return os.path.join(self.root, "model_runs")

    @property
    def batches(self):
        return os.path.join(self.root, "batches")


def extract(spark: SparkSession, path: str, fmt: str, since=None) -> DataFrame:
    """Stage 1 (S1 / S2 / S4)."""
    df = readers.read_csv_contacts(spark, path) if fmt == "csv" else readers.read_api_contacts(spark, path)
    if since is not None and fmt != "csv":
        created = F.col("properties.createdate")
        from ..functions.expr import parse_ts
        df = df.where(parse_ts(created) >= F.lit(since).cast("timestamp"))
    return df


def _clock_text(now) -> str:
    """The run's clock as sortable UTC text, fixed once on the driver."""
    if now is None:
        t = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    elif isinstance(now, _dt.datetime):
        t = now.astimezone(_dt.timezone.utc).replace(tzinfo=None) if now.tzinfo else now
    else:
        t = _dt.datetime.fromisoformat(str(now).replace("Z", "+00:00"))
        t = t.astimezone(_dt.timezone.utc).replace(tzinfo=None) if t.tzinfo else t
    return t.strftime("%Y-%m-%d %H:%M:%S.%f")


def merge_core(spark: SparkSession, wh: Warehouse, run_id: str, mode: str = "run",
               now=None, publish: str = "partitions") -> int:
    """Merge the run into core and return the number of affected keys
    (updates + inserts).

    ``publish='partitions'`` rewrites only the months that change, found through the key
    index, and switches readers to them at once (``sources.corestore``);
    ``publish='snapshot'`` writes a full new snapshot and moves a pointer to it.

    The core's high-water mark is recorded with each merge, so the next watermark run reads
    one small object instead of scanning the core. The run's clock is fixed once on the
    driver, so every job of the merge stamps the same ``processed_at`` and the mark is
    exact."""
    now = _clock_text(now)
    mark = sinks.read_watermark(spark, wh.core)
    if mode == "run":
        if not sinks.run_exists(spark, wh.raw, run_id):
            return 0                                   # the run loaded no valid contact
        source = sinks.read_runs(spark, wh.raw, [run_id]).where(F.col("run_id") == run_id)
    elif mode == "watermark":
        runs = sinks.raw_runs_after(spark, wh.raw, mark)
        if runs == []:
            return 0                                   # no run newer than the mark
        raw = spark.read.parquet(wh.raw) if runs is None else sinks.read_runs(spark, wh.raw, runs)
        source = watermark_filter(stg_contacts(raw), None, mark=mark)
    else:
        raise ValueError(f"unknown merge mode {mode!r}")
    return _merge(spark, wh, source, mode, now, publish, mark)


def _merge(spark: SparkSession, wh: Warehouse, source: DataFrame, mode: str, now, publish: str, mark) -> int:
    if publish == "snapshot":
        target = sinks.read_core(spark, wh.core)
        one = source.agg(F.countDistinct("contact_id").alias("k"),
                         F.max(F.col("contact_id").isNull().cast("int")).alias("null_key"),
                         F.date_format(F.max("processed_at"), TS_TEXT).alias("m")).first()
        affected = one["k"] + (one["null_key"] or 0)   # a NULL key counts once
        sinks.publish_snapshot(merge_snapshot(target, source, mode=mode, now=now), wh.core)
        if affected:
            written = now if mode == "run" else one["m"]
            sinks.write_watermark(spark, wh.core, max(m for m in (mark, written) if m))
        return affected
    rows = merge_snapshot(None, source, mode=mode, now=now)            # dedupe + stamp
    return corestore.merge(spark, wh.core, rows, scratch_path(spark, "merge-staging"))["affected"]


def model_run(spark: SparkSession, wh: Warehouse, run_id: str, now=None, publish: str = "partitions") -> Outcome:
    """Staging, core (by watermark), marts and data tests (``plans.model``) over the runs
    that are newer than the core's mark. The outcome is kept as rows under ``model_runs``."""
    now = _clock_text(now)
    mark = sinks.read_watermark(spark, wh.core)
    runs = sinks.raw_runs_after(spark, wh.raw, mark)
    raw = spark.createDataFrame([], CONTACT_SCHEMA) if runs == [] else \
        spark.read.parquet(wh.raw) if runs is None else sinks.read_runs(spark, wh.raw, runs)
    quarantine = spark.read.parquet(wh.quarantine) if sinks.run_exists(spark, wh.quarantine, run_id) else \
        spark.createDataFrame([], QUARANTINE_SCHEMA)

    def core(staging: DataFrame) -> DataFrame:
        _merge(spark, wh, watermark_filter(staging, None, mark=mark), "watermark", now, publish, mark)
        return sinks.read_core(spark, wh.core)

    out = run_model(spark, raw, quarantine, stg_contacts, core, wh.marts, now)
    outcome_rows(spark, out).withColumn("run_id", F.lit(run_id)).coalesce(1).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(wh.model_runs)
    return out


def process_validated(spark: SparkSession, annotated: DataFrame, wh: Warehouse, run_id: str,
                      mode: str = "run", now=None, archive_processed: bool = False,
                      log=print, publish: str = "partitions") -> RunStats:
    """Stages 3-7 on an already read batch."""
    stage_root = scratch_path(spark, "stages")
    # hand over only what the later stages read (the contact columns, the outcome and the
    # original text), not the parsed record a second and third time
    handed = [c for c in CONTACT_COLUMNS if c not in ("processed_at", "run_id")] + \
        ["error_type", "error_message", "original_data"] + \
        [c for c in ("ingest_seq",) if c in annotated.columns]
    # V14 counts are observed while the hand-over is written: no extra scan
    annotated, counts = sinks.save_stage(
        annotated.select(*handed), stage_root, "validated", run_id,
        observe={"t": F.count(F.lit(1)), "v": F.count_if(F.col("error_type").isNull())})
    stats = RunStats(run_id, total=counts["t"], valid=counts["v"], invalid=counts["t"] - counts["v"])
    valid, invalid = split(annotated, run_id=run_id, processed_at=now)
    try:                                             # V15: non-fatal archive
        sinks.write_batch(invalid, wh.batches, CONTAINER_INVALID, run_id, fmt="json")
    except Exception as exc:  # noqa: BLE001
        log(f"invalid archive failed for {run_id}: {exc}")
    if archive_processed:                            # V16
        sinks.write_batch(valid.drop("run_id"), wh.batches, CONTAINER_PROCESSED, run_id)
    stats.raw_loaded = sinks.append_raw(valid, wh.raw, run_id, now)
    stats.quarantined = sinks.append_quarantine(invalid, wh.quarantine, run_id, now)
    if mode == "model":                              # C6: model path, fallback to merge
        out = model_run(spark, wh, run_id, now, publish)
        if out.good:
            stats.core_merged, stats.model_run = -1, True
        else:
            bad = [f"{n}: {s}" for n, s in out.nodes.items() if s != "built"] + \
                [f"{t[0]}.{t[2]} {t[1]}: {t[3]}" for t in out.tests if t[4] == "fail"]
            log(f"model run failed ({'; '.join(bad)}); falling back to run merge")
            stats.core_merged = merge_core(spark, wh, run_id, "run", now, publish)
    else:
        stats.core_merged = merge_core(spark, wh, run_id, mode, now, publish)
    # a replayed run replaces its audit row
    spark.createDataFrame([tuple(asdict(stats).values())], RUN_AUDIT_SCHEMA) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("run_id").parquet(wh.audit)
    sinks.drop_stages(spark, stage_root, run_id)     # audited: nothing reads them again
    return stats


def run_batch(spark: SparkSession, source_path: str, fmt: str, warehouse_root: str,
              run_id: str | None = None, mode: str = "run", now=None, since=None,
              literal: bool = False, archive_processed: bool = False, log=print,
              publish: str = "partitions") -> RunStats:
    """Full run over one landed batch (JSON documents of any layout, or CSV)."""
    ensure_utc(spark)
    wh = Warehouse(warehouse_root)
    run_id = run_id or new_run_id()
    records = extract(spark, source_path, fmt, since)
    # Backup of the extracted batch (Parquet, ZSTD); the text of a malformed CSV row
    # is kept, so every landed byte is found again
    keep = [c for c in records.columns if not c.startswith("_") or c == "_corrupt_record"]
    batches = sinks.write_batch(records.select(*keep), wh.batches, CONTAINER_RAW, run_id)
    # the written batch is validated, so the landing is framed and parsed once
    written = sinks.read_runs(spark, batches, [run_id]).drop("run_id") if sinks.run_exists(spark, batches, run_id) else records
    annotated = validate(written, literal=literal)
    return process_validated(spark, annotated, wh, run_id, mode, now, archive_processed, log,
                             publish)


def run_audit(spark: SparkSession, warehouse_root: str) -> DataFrame:
    return spark.read.schema(RUN_AUDIT_SCHEMA).parquet(Warehouse(warehouse_root).audit) \
        .select(*RUN_AUDIT_SCHEMA.names)
