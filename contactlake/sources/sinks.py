"""Sinks S5-S8, S10-S17: batch store, manifest, raw / quarantine appends, snapshot
publishing of the core table, relational upsert rows, stage hand-over, run audit.

Every write either overwrites exactly its own ``run_id`` partition (dynamic partition
overwrite) or publishes a new snapshot directory, so a retried task or job re-writes the
same output instead of appending twice."""

from __future__ import annotations

import json
import os

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CONTACT_COLUMNS, INGEST_DAY, MANIFEST_SCHEMA, QUARANTINE_SCHEMA, RELATIONAL_COLUMNS


# ------------------------------------------------------------------ S5 / S6 / S14 ------
def write_batch(df: DataFrame, base: str, container: str, run_id: str | None,
                fmt: str = "parquet", newest: str | None = None, day: str | None = None) -> str:
    """One batch per container and run at ``base/container/run_id=<id>``;
    re-writing the same run replaces it (dynamic partition overwrite). With
    ``run_id=None`` the rows carry their run in a ``run_id`` column (many batches in
    one write). The manifest of the store (S7) gets a row for each batch written, with its
    record count and, of the column ``newest``, the greatest value: observed while one batch
    is written, and read back from the written batches when there are many. ``day``: a batch is
    divided by the days of that column, each in files of a balanced size."""
    path = os.path.join(base, container)
    out = df if run_id is None else df.withColumn("run_id", F.lit(run_id))
    newest = newest if newest in df.columns else None
    top = (F.max(newest) if newest else F.max(F.lit(None))).cast("timestamp").alias("newest_at")
    many = F.count(F.lit(1)).alias("record_count")
    seen = Observation() if run_id is not None else None
    if seen:
        out = out.observe(seen, many, top)
    written = out if not day else by_day(out, day) if run_id is None else out.withColumn(INGEST_DAY, F.to_date(day))
    (written
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .option("compression", "zstd" if fmt == "parquet" else "none")
       .partitionBy("run_id", *([INGEST_DAY] if day else [])).format(fmt).save(path))
    spark = df.sparkSession
    if seen:
        got = seen.get
        rows = spark.createDataFrame([(run_id, got["record_count"], got["newest_at"])],
                                     "blob_name string, record_count long, newest_at timestamp")
    else:
        back = spark.read.schema(out.schema).format(fmt).load(path)
        mine = df.select("run_id").distinct()      # other batches of the container keep their rows
        rows = back.join(mine, "run_id", "left_semi").groupBy(F.col("run_id").alias("blob_name")).agg(many, top)
    _put_manifest(rows, base, container)
    return path


def by_day(rows: DataFrame, column: str) -> DataFrame:
    """Rows with the day of a time column, dealt so that a day's files are neither many small
    ones nor one large one (the shuffle is cut and joined by measured sizes)."""
    return rows.withColumn(INGEST_DAY, F.to_date(column)).hint("rebalance", INGEST_DAY)


def manifest_path(base: str) -> str:
    return os.path.join(base, "_manifest_rows")


def _put_manifest(rows: DataFrame, base: str, container: str) -> None:
    """Insert or replace the manifest rows of batches (one small partition each)."""
    file = F.concat(F.lit(f"{base}/{container}/run_id="), F.col("blob_name"))
    rows.select("record_count", "newest_at", file.alias("file_path"), F.current_timestamp().alias("created_at"),
                F.lit(container).alias("container"), "blob_name") \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("container", "blob_name").parquet(os.path.join(manifest_path(base), "rows"))


def write_lines(lines: DataFrame, path: str, header: str | None = None,
                files: int | None = None) -> str:
    """Land text (column ``line``, line breaks in it kept) as files under ``path``, replacing
    them. With a ``header`` every written file starts with that line. ``files`` deals the
    texts out round-robin over that many files."""
    out = lines.select("line")
    if files:
        out = out.repartition(files)
    if header is not None:
        def headed(batches):
            yield pa.RecordBatch.from_arrays([pa.array([header])], ["line"])
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column(0)], ["line"])

        out = out.mapInArrow(headed, "line string")
    out.write.mode("overwrite").text(path)
    return path


def save_stage(df: DataFrame, base: str, stage: str, run_id: str,
               observe: dict | None = None) -> DataFrame | tuple[DataFrame, dict]:
    """Hand a stage's output to the next stage as a written table (cuts lineage and
    survives executor loss), then read it back. With ``observe`` (name → aggregate
    Column) the aggregates are computed while writing and returned as well."""
    path = os.path.join(base, "stages", run_id, stage)
    if observe:
        obs = Observation()
        df.observe(obs, *[c.alias(k) for k, c in observe.items()]).write.mode("overwrite").parquet(path)
        return df.sparkSession.read.parquet(path), obs.get
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def load_stage(spark: SparkSession, base: str, stage: str, run_id: str) -> DataFrame:
    return spark.read.parquet(os.path.join(base, "stages", run_id, stage))


def drop_stages(spark: SparkSession, base: str, run_id: str) -> None:
    """Remove the hand-over tables of a finished run."""
    _delete_path(spark, os.path.join(base, "stages", run_id))


# ------------------------------------------------------------------ S7 / S8 ------------
def read_manifest(spark: SparkSession, base: str) -> DataFrame:
    """The stored manifest of a batch store, one row per batch (no batch is opened)."""
    path = os.path.join(manifest_path(base), "rows")
    if not _path_exists(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    stored = T.StructType([f for f in MANIFEST_SCHEMA.fields if f.name != "blob_key"])
    return spark.read.schema(stored).parquet(path) \
        .withColumn("blob_key", F.concat_ws("/", "container", "blob_name")).select(*MANIFEST_SCHEMA.names)


def list_batches(manifest: DataFrame, prefix: str) -> DataFrame:
    """Batch names starting with ``prefix``, sorted."""
    return manifest.where(F.col("blob_name").startswith(prefix)).orderBy("blob_name")


# ------------------------------------------------------------------ S10-S12 ------------
def _write_run_counted(rows: DataFrame, table_path: str, newest: str | None = None, day: str | None = None,
                       run_id: str | None = None):
    """Replace the run's partition of a table partitioned by ``run_id`` (and, with ``day``, by
    the day of that column) and return the rows written (and, with ``newest``, that column's
    maximum as UTC text). Both are observed while writing (no second scan of the output);
    metrics of failed task attempts are not counted. Days that an earlier attempt of the run
    wrote, and this one did not reach, are removed."""
    obs = Observation()
    metrics = [F.count(F.lit(1)).alias("n")]
    if newest:
        metrics.append(F.date_format(F.max(newest), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("m"))
    if day:
        metrics += [F.min(F.to_date(day)).cast("string").alias("first"), F.max(F.to_date(day)).cast("string").alias("last")]
    out = rows.observe(obs, *metrics)
    # a run has one clock, so its day is one partition and needs no dealing
    (out.withColumn(INGEST_DAY, F.to_date(day)) if day else out).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("run_id", *([INGEST_DAY] if day else [])).parquet(table_path)
    got = obs.get
    if day and got["n"]:
        spark = rows.sparkSession
        for name in _partitions(spark, run_path(table_path, run_id), INGEST_DAY):
            if name[:1].isdigit() and not got["first"] <= name <= got["last"]:
                _delete_path(spark, os.path.join(run_path(table_path, run_id), f"{INGEST_DAY}={name}"))
    return (int(got["n"]), got["m"]) if newest else int(got["n"])


def _partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the partition directories of a folder."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    return [n[len(column) + 1:] for n in names if n.startswith(column + "=")]


def run_path(table_path: str, run_id: str) -> str:
    """Directory of one run's partition (the name escaped as Spark writes it)."""
    from pyspark import SparkContext
    jvm = SparkContext._active_spark_context._jvm
    esc = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(run_id)
    return os.path.join(table_path, f"run_id={esc}")


def read_runs(spark: SparkSession, table_path: str, run_ids: list[str]) -> DataFrame:
    """The given runs of a table partitioned by ``run_id``, opening only their
    directories: reading the table root would list every file of every run first, and
    raw grows by a run every hour."""
    paths = [run_path(table_path, r) for r in run_ids]
    return spark.read.option("basePath", table_path).parquet(*paths)


def run_exists(spark: SparkSession, table_path: str, run_id: str) -> bool:
    """A run that wrote no rows has no partition directory."""
    return _path_exists(spark, run_path(table_path, run_id))


def raw_runs_manifest(table_path: str) -> str:
    return table_path.rstrip("/") + "_runs"


def raw_runs_after(spark: SparkSession, table_path: str, mark: str | None) -> list[str] | None:
    """Runs of the raw table holding rows with ``processed_at`` after ``mark``, from the
    small run manifest written by every append; None when there is no manifest."""
    path = raw_runs_manifest(table_path)
    if not _path_exists(spark, path):
        return None
    m = spark.read.parquet(path).where(F.col("newest_processed_at").isNotNull())  # empty runs
    if mark is not None:
        m = m.where(F.col("newest_processed_at") > F.lit(mark))
    return [r["run_id"] for r in m.select("run_id").collect()]



def append_raw(valid: DataFrame, table_path: str, run_id: str, processed_at=None) -> int:
    """Stamp and write the run's valid contacts into the raw table (partitioned by
    run). Idempotent per run: the run's partition is replaced, not appended to."""
    stamp = F.current_timestamp() if processed_at is None else F.lit(processed_at).cast("timestamp")
    extra = [c for c in ("ingest_seq",) if c in valid.columns]
    out = valid.select(*[c for c in CONTACT_COLUMNS if c not in ("processed_at", "run_id")],
                       stamp.alias("processed_at"), F.lit(run_id).alias("run_id"), *extra)
    n, newest = _write_run_counted(out, table_path, "processed_at", "processed_at", run_id)
    # one manifest row per run (replaced with the run): lets a watermark merge open only
    # the runs newer than its mark
    spark = valid.sparkSession
    spark.createDataFrame([(newest, run_id)], "newest_processed_at string, run_id string") \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("run_id").parquet(raw_runs_manifest(table_path))
    return n


def quarantine_rows(invalid: DataFrame, run_id: str, quarantined_at=None) -> DataFrame:
    """S11 rows: deterministic id (hash of run and record) so a re-run yields the same
    ids; the original record kept as JSON text."""
    stamp = F.current_timestamp() if quarantined_at is None else F.lit(quarantined_at).cast("timestamp")
    seq = F.col("ingest_seq").cast("string") if "ingest_seq" in invalid.columns else F.lit("")
    rid = F.sha2(F.concat_ws("|", F.lit(run_id), seq, F.col("original_data")), 256)
    return invalid.select(rid.alias("id"), "original_data", "error_message", "error_type",
                          F.lit(run_id).alias("run_id"), stamp.alias("quarantined_at"))


def append_quarantine(invalid: DataFrame, table_path: str, run_id: str,
                      quarantined_at=None) -> int:
    """Write the run's invalid records into the quarantine table."""
    return _write_run_counted(quarantine_rows(invalid, run_id, quarantined_at), table_path, day="quarantined_at", run_id=run_id)


def append_table(df: DataFrame, table_path: str, schema=None, partition_by=None) -> int:
    """Generic append, optionally checked against an explicit schema; the rows
    written, observed while writing."""
    if schema is not None:
        missing = [f.name for f in schema.fields if f.name not in df.columns]
        if missing:
            raise ValueError(f"columns missing for append: {missing}")
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    obs = Observation()
    w = df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(table_path)
    return int(obs.get["n"])


# ------------------------------------------------------------------ S13 ----------------
def relational_upsert_rows(target: DataFrame | None, batch: DataFrame,
                           key: str = "contact_id") -> DataFrame:
    """The 5-column relational target after a batch upsert: per key the batch's
    last record (later duplicate wins), on conflict its 4 columns replace the row."""
    # without a position the winner is the row of greatest hash, the same in every run
    order = F.col("ingest_seq").desc() if "ingest_seq" in batch.columns else \
        F.xxhash64(*RELATIONAL_COLUMNS).desc()
    w = Window.partitionBy(key).orderBy(order)
    last = batch.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(*RELATIONAL_COLUMNS)
    if target is None:
        return last
    return target.select(*RELATIONAL_COLUMNS).join(last.select(key), key, "left_anti").unionByName(last)


def relational_upsert(spark: SparkSession, path: str, batch: DataFrame, key: str = "contact_id") -> tuple[int, int]:
    """S13 on a stored target (a snapshot at ``path``, which may not exist yet): the rows
    replaced and the rows inserted. Conflicts are one join of the keys; the new snapshot is
    published whole, so readers never see half an upsert."""
    target = read_snapshot(spark, path)
    if target is None:
        replaced = F.lit(False)
        rows = relational_upsert_rows(None, batch, key).withColumn("_new", F.lit(True))
    else:
        last = relational_upsert_rows(None, batch, key)
        known = target.select(F.col(key).alias("_known")).distinct()
        marked = last.join(known, last[key].eqNullSafe(known["_known"]), "left")
        kept = target.join(last.select(F.col(key).alias("_k")), F.col(key).eqNullSafe(F.col("_k")), "left_anti")
        replaced = F.col("_known").isNotNull()
        rows = kept.select(*RELATIONAL_COLUMNS).withColumn("_new", F.lit(False)).withColumn("_known", F.lit(None).cast("string")) \
            .unionByName(marked.select(*RELATIONAL_COLUMNS, "_known").withColumn("_new", F.lit(True)))
    seen = Observation()
    rows = rows.observe(seen, F.count_if(F.col("_new") & replaced).alias("replaced"),
                        F.count_if(F.col("_new") & ~replaced).alias("inserted"))
    publish_snapshot(rows.select(*RELATIONAL_COLUMNS), path, partition_by=None)
    return seen.get["replaced"], seen.get["inserted"]


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict) -> None:
    """Optional JDBC sink of the relational target (no server is started here)."""
    df.write.jdbc(url, table, mode="overwrite", properties=properties)


# ------------------------------------------------------------------ S15 / snapshots ----
def create_table_if_missing(spark: SparkSession, name: str, path: str, schema_ddl: str,
                            partitioned_by: list[str] | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet PARTITIONED BY``."""
    part = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    fs, p = _fs_path(spark, path)
    fs.mkdirs(p)                        # the location exists before the table points at it
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema_ddl}) USING parquet{part} "
              f"LOCATION '{path}'")


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _read_small_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_small_text(spark: SparkSession, path: str, text: str) -> None:
    """One small object written through the cluster file system (HDFS, object store):
    it becomes visible whole when the stream is closed."""
    fs, p = _fs_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def current_snapshot(spark: SparkSession, base: str) -> str | None:
    text = _read_small_text(spark, os.path.join(base, "_CURRENT"))
    return None if text is None else json.loads(text).get("path")


def read_snapshot(spark: SparkSession, base: str) -> DataFrame | None:
    path = current_snapshot(spark, base)
    return None if path is None else spark.read.parquet(path)


def publish_snapshot(df: DataFrame, base: str, partition_by: str | None = "created_month") -> str:
    """Write a full new snapshot ``base/v=<n>`` and then replace the small ``_CURRENT``
    pointer; the previous snapshot stays readable. A failed write leaves the pointer on
    the old snapshot. Pointer I/O goes through the Hadoop file system of the cluster."""
    from ..operators.core import with_layout
    spark = df.sparkSession
    cur = current_snapshot(spark, base)
    n = 0 if cur is None else int(cur.rstrip("/").rsplit("v=", 1)[1]) + 1
    path = os.path.join(base, f"v={n}")
    out = with_layout(df) if partition_by == "created_month" else df
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    _write_small_text(spark, os.path.join(base, "_CURRENT"), json.dumps({"path": path, "version": n}))
    return path


def read_watermark(spark: SparkSession, core_path: str) -> str | None:
    """High-water mark (max ``processed_at``, UTC text) recorded by the last merge."""
    from . import corestore
    manifest = corestore.current(spark, core_path)
    if manifest is not None:
        return manifest["watermark"]
    text = _read_small_text(spark, os.path.join(core_path, "_WATERMARK"))
    return None if text is None else json.loads(text)["processed_at"]


def write_watermark(spark: SparkSession, core_path: str, mark: str) -> None:
    """Record the core's high-water mark after a merge (a small object beside the data;
    readers of the table skip ``_`` files)."""
    _write_small_text(spark, os.path.join(core_path, "_WATERMARK"),
                      json.dumps({"processed_at": mark}))


def quarantine_schema_ddl() -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in QUARANTINE_SCHEMA.fields)


# ------------------------------------------------------------------ S17 ----------------
def run_query(spark: SparkSession, sql: str, params: dict | None = None) -> DataFrame:
    """SQL with named parameters (``:run_id``), bound by Spark, never formatted in."""
    return spark.sql(sql, args=params or {})


# ------------------------------------------------------------------ C4 ------------------
def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def read_core(spark: SparkSession, base: str) -> DataFrame | None:
    """Core table of either publishing mode: versions of months, or a snapshot pointer."""
    from . import corestore
    manifest = corestore.current(spark, base)
    if manifest is not None:
        return corestore.read(spark, base, manifest)
    return read_snapshot(spark, base)
