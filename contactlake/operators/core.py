"""Core layer: C2 watermark, C3 latest-per-key, C4/C5 merge, C7 layout.

Plain Parquet has no MERGE, so an upsert is computed as a new full snapshot:
``target LEFT ANTI source  UNION ALL  source`` and published under a new version
directory (see ``sources.sinks.publish_snapshot``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import EPOCH
from ..functions.expr import as_of_lit
from ..schema import CONTACT_COLUMNS

# Order of "latest": last modification first (NULL last), then processing time, then
# position in the batch (the last record of a batch wins a full tie).
def latest_order(with_seq: bool = True) -> list:
    order = [F.col("lastmodifieddate").desc_nulls_last(),
             F.col("processed_at").desc_nulls_last()]
    if with_seq:
        order.append(F.col("ingest_seq").desc_nulls_last())
    return order


def dedupe_latest(df: DataFrame, key: str = "contact_id", order=None,
                  keep_columns: list[str] | None = None) -> DataFrame:
    """One row per key, the latest by ``order``.

    ``row_number() = 1`` lets the optimizer insert a partial WindowGroupLimit *before*
    the shuffle, so each map task forwards at most one row per key: a key that holds a
    third of all rows still reaches the reducer as one row per map task."""
    order = order or latest_order("ingest_seq" in df.columns)
    w = Window.partitionBy(key).orderBy(*order)
    out = df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1)
    cols = keep_columns or [c for c in df.columns]
    return out.select(*cols)


def high_water_mark(target: DataFrame, column: str = "processed_at"):
    """C2 helper: ``coalesce(max(target.col), 1970-01-01)`` as a Python value.

    One-row aggregate (partial max per task); collected as a literal so the filter that
    uses it can be pushed into the source scan."""
    row = target.agg(F.max(column).alias("m")).first()
    if row is None or row["m"] is None:
        return F.to_timestamp(F.lit(EPOCH))
    return F.lit(row["m"])


def watermark_filter(source: DataFrame, target: DataFrame | None,
                     column: str = "processed_at", mark=None) -> DataFrame:
    """Keep source rows strictly newer than the target's high-water mark. A ``mark``
    recorded when the target was last written (text, UTC) spares the scan of the
    target."""
    if mark is not None:
        return source.where(F.col(column) > F.to_timestamp(F.lit(mark)))
    if target is None:
        return source
    return source.where(F.col(column) > high_water_mark(target, column))


TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"      # sortable UTC text of a high-water mark


def high_water_text(target: DataFrame, column: str = "processed_at") -> str | None:
    """``max(column)`` of the target as sortable UTC text (one-column scan)."""
    return target.agg(F.date_format(F.max(column), TS_TEXT).alias("m")).first()["m"]


def merge_snapshot(target: DataFrame | None, source: DataFrame, key: str = "contact_id",
                   mode: str = "run", now=None, dedupe: bool = True) -> DataFrame:
    """Upsert ``source`` into ``target`` and return the new full snapshot.

    * source is deduplicated per key first (C3);
    * matched keys are replaced by the source row, others inserted; nothing deleted;
    * ``mode='run'`` stamps ``processed_at = now`` on every merged row (warehouse MERGE),
      ``mode='watermark'`` keeps the source's ``processed_at`` (incremental model).

    The anti join is an equi-join on a key that is unique on both sides after dedupe, so
    no key can be hot in it."""
    src = dedupe_latest(source, key) if dedupe else source
    if mode == "run":
        src = src.withColumn("processed_at", as_of_lit(now))
    elif mode != "watermark":
        raise ValueError(f"unknown merge mode {mode!r}")
    src = src.select(*CONTACT_COLUMNS)
    if target is None:
        return src
    kept = target.select(*CONTACT_COLUMNS).join(src.select(key), key, "left_anti")
    return kept.unionByName(src)


PARTITION_COLUMN = "created_month"


def with_layout(df: DataFrame) -> DataFrame:
    """Month partition column on created_at; inside a month the rows are range
    partitioned on created_at, so every file covers a narrow time span (Parquet min/max
    then skip files and row groups for a day-level window), and each file is clustered
    by status and industry.

    Month directories rather than day directories: a day holds few rows unless the
    table is very large, and day directories then mean thousands of tiny files; the
    file statistics give day-level skipping anyway. Range partitioning on (time, key)
    also splits a hot day over several writer tasks instead of hashing it into one."""
    return (df.withColumn(PARTITION_COLUMN, F.trunc(F.to_date("created_at"), "month"))
              .repartitionByRange("created_at", "contact_id")
              .sortWithinPartitions(PARTITION_COLUMN, "lead_status", "industry"))
