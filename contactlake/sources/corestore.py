"""The core table as versions of partitions, with a key index.

    data/merge=<id>/created_month=<m>/     the contacts of a month, as one merge left them
    index/merge=<id>/bucket=<b>/           (contact_id, created_month) of a bucket of keys
    versions/v=<n>.json                    which merge holds each month and each bucket
    _CURRENT                               the version that readers take

A merge looks its keys up in the buckets they hash to, so it opens neither the other buckets
nor any month without a matched or a new contact. It writes the months and buckets that
change beside the old ones and then replaces ``_CURRENT``: a reader sees the version before
or the one after, and a failed merge leaves no trace but unused files. The version before
stays for readers that have begun; older ones are removed.
"""
from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.core import PARTITION_COLUMN, TS_TEXT, with_layout
from ..schema import CONTACT_COLUMNS, CORE_LAYOUT_SCHEMA
from .readers import batch_names
from .sinks import _delete_path, _path_exists, _read_small_text, _write_small_text

#: keys of one bucket of the index, about; with twice as many it gets more buckets
KEYS_PER_BUCKET = 1 << 20
UNDATED = "__HIVE_DEFAULT_PARTITION__"
INDEX_SCHEMA = T.StructType([T.StructField("contact_id", T.StringType()), T.StructField(PARTITION_COLUMN, T.DateType()),
                             T.StructField("bucket", T.IntegerType())])


def current(spark: SparkSession, base: str) -> dict | None:
    """The manifest of the current version; None without one."""
    pointer = _read_small_text(spark, os.path.join(base, "_CURRENT"))
    if pointer is None or "manifest" not in (at := json.loads(pointer)):
        return None
    return json.loads(_read_small_text(spark, os.path.join(base, at["manifest"])))


def _paths(base: str, manifest: dict, part: str) -> set[str]:
    """Directories of a version: its months (``data``) or its buckets (``index``)."""
    name = PARTITION_COLUMN if part == "data" else "bucket"
    return {os.path.join(base, part, f"merge={merge}", f"{name}={value}") for value, merge in manifest[part].items()}


def read(spark: SparkSession, base: str, manifest: dict, months: set[str] | None = None) -> DataFrame:
    """The contacts of a version, or of some of its months (directory names)."""
    some = manifest if months is None else {"data": {m: v for m, v in manifest["data"].items() if m in months}}
    paths = sorted(_paths(base, some, "data"))
    if not paths:
        return spark.createDataFrame([], CORE_LAYOUT_SCHEMA)
    return spark.read.schema(CORE_LAYOUT_SCHEMA).option("basePath", os.path.join(base, "data")).parquet(*paths) \
        .select(*CORE_LAYOUT_SCHEMA.names)


def read_index(spark: SparkSession, base: str, manifest: dict, buckets: set[int]) -> DataFrame:
    """The index entries of some buckets."""
    paths = sorted(_paths(base, {"index": {b: v for b, v in manifest["index"].items() if int(b) in buckets}}, "index"))
    if not paths:
        return spark.createDataFrame([], INDEX_SCHEMA)
    return spark.read.schema(INDEX_SCHEMA).option("basePath", os.path.join(base, "index")).parquet(*paths) \
        .select(*INDEX_SCHEMA.names)


def bucket_of(buckets: int):
    return F.pmod(F.xxhash64("contact_id"), F.lit(buckets)).cast("int")


def _write_index(entries: DataFrame, path: str) -> None:
    """Entries by bucket, each bucket in order of its keys, so that row groups have narrow ranges."""
    entries.select("contact_id", PARTITION_COLUMN, "bucket").repartition("bucket") \
        .sortWithinPartitions("bucket", "contact_id").write.mode("overwrite").partitionBy("bucket").parquet(path)


def _buckets_for(keys: int) -> int:
    return 1 << max(0, (keys // KEYS_PER_BUCKET).bit_length())


def _name(month) -> str:
    return UNDATED if month is None else str(month)


def merge(spark: SparkSession, base: str, source_rows: DataFrame, staging: str, mark: str | None = None) -> dict:
    """Upsert deduplicated, stamped contacts, publish the new version and return its manifest,
    with ``affected`` (rows of the batch) and ``rewritten`` (names of the months).

    ``mark``: a high-water mark to be recorded; default: the newest ``processed_at`` of the
    batch, or the one recorded before if that is newer. The driver holds the names of months
    and buckets."""
    stage = os.path.join(staging, f"merge-{uuid.uuid4().hex[:12]}")
    seen = Observation()
    month = F.trunc(F.to_date("created_at"), "month")
    source_rows.select(*CONTACT_COLUMNS).withColumn(PARTITION_COLUMN, month) \
        .observe(seen, F.count(F.lit(1)).alias("n"), F.date_format(F.max("processed_at"), TS_TEXT).alias("newest")) \
        .write.parquet(stage)
    src = spark.read.schema(CORE_LAYOUT_SCHEMA).parquet(stage)
    n, newest = seen.get["n"], seen.get["newest"]
    old = current(spark, base)
    if old is None and _path_exists(spark, base):
        raise ValueError(f"{base} holds a table without versions; merge its rows into a new one")
    new = {"version": old["version"] + 1 if old else 0, "buckets": old["buckets"] if old else _buckets_for(n),
           "keys": old["keys"] if old else 0, "data": dict(old["data"]) if old else {}, "index": dict(old["index"]) if old else {},
           "watermark": max([m for m in (mark or newest, old and old["watermark"]) if m], default=None)}
    rewritten: set[str] = set()
    if n:
        merge_id = f"{new['version']:08d}-{uuid.uuid4().hex[:8]}"
        keyed = src.withColumn("bucket", bucket_of(new["buckets"]))
        rewritten, changed, inserted = _touched(spark, base, old, keyed)
        keys = src.select("contact_id")
        rows = src.select(*CONTACT_COLUMNS)
        if old:
            kept = read(spark, base, old, rewritten).select(*CONTACT_COLUMNS).join(keys, "contact_id", "left_anti")
            rows = kept.unionByName(rows)
        data = os.path.join(base, "data", f"merge={merge_id}")
        with_layout(rows).write.mode("overwrite").partitionBy(PARTITION_COLUMN).parquet(data)
        for m in rewritten:  # a month that all its contacts left is not written, and goes
            new["data"].pop(m, None)
        new["data"].update({m: merge_id for m in batch_names(spark, data, PARTITION_COLUMN)})
        new["keys"] += inserted
        index = os.path.join(base, "index", f"merge={merge_id}")
        if new["keys"] > 2 * KEYS_PER_BUCKET * new["buckets"]:  # more and smaller buckets, for all keys
            new["buckets"] = _buckets_for(new["keys"])
            entries = read(spark, base, new).select("contact_id", PARTITION_COLUMN).withColumn("bucket", bucket_of(new["buckets"]))
            new["index"] = {}
        else:
            some = keyed.where(F.col("bucket").isin(sorted(changed))).select(*INDEX_SCHEMA.names)
            entries = read_index(spark, base, old, changed).join(keys, "contact_id", "left_anti").unionByName(some) if old else some
        if changed or not new["index"]:
            _write_index(entries, index)
            new["index"].update({b: merge_id for b in batch_names(spark, index, "bucket")})
    _publish(spark, base, old, new)
    _delete_path(spark, stage)
    return new | {"affected": n, "rewritten": sorted(rewritten)}


def _touched(spark: SparkSession, base: str, old: dict | None, keyed: DataFrame) -> tuple[set[str], set[int], int]:
    """Months that hold a matched key or get a row, buckets with a new or moved key, and the
    number of new keys: the batch against the buckets of its own keys, within their range."""
    own = keyed.agg(F.collect_set("bucket").alias("buckets"), F.collect_set(PARTITION_COLUMN).alias("months"),
                    F.count_if(F.col(PARTITION_COLUMN).isNull()).alias("undated"), F.count("*").alias("n"),
                    F.min("contact_id").alias("low"), F.max("contact_id").alias("high")).first()
    months = {_name(m) for m in own["months"]} | ({UNDATED} if own["undated"] else set())
    buckets = set(own["buckets"])
    if old is None:
        return months, buckets, own["n"]
    index = read_index(spark, base, old, buckets)
    if own["low"] is not None:  # min and max of the row groups tell which to read
        index = index.where(F.col("contact_id").between(own["low"], own["high"]))
    index = index.select("contact_id", "bucket", F.col(PARTITION_COLUMN).alias("_was"), F.lit(True).alias("_known"))
    both = keyed.select("contact_id", "bucket", PARTITION_COLUMN).join(index, ["contact_id", "bucket"], "left")
    known = F.col("_known").isNotNull()
    stays = known & F.col("_was").eqNullSafe(F.col(PARTITION_COLUMN))
    got = both.agg(F.collect_set(F.when(known, F.col("_was"))).alias("months"),
                   F.count_if(known & F.col("_was").isNull()).alias("undated"),
                   F.collect_set(F.when(~stays, F.col("bucket"))).alias("changed"),
                   F.count_if(~known).alias("new")).first()
    months |= {_name(m) for m in got["months"]} | ({UNDATED} if got["undated"] else set())
    return months, set(got["changed"]), got["new"]


def _publish(spark: SparkSession, base: str, old: dict | None, new: dict) -> None:
    """Write the manifest, replace the pointer, and remove what only the version before the
    last one holds."""
    name = f"versions/v={new['version']}.json"
    _write_small_text(spark, os.path.join(base, name), json.dumps(new))
    _write_small_text(spark, os.path.join(base, "_CURRENT"), json.dumps({"manifest": name, "version": new["version"]}))
    text = _read_small_text(spark, gone := os.path.join(base, f"versions/v={new['version'] - 2}.json"))
    if text is not None:
        older = json.loads(text)
        for part in ("data", "index"):
            for path in _paths(base, older, part) - _paths(base, old, part) - _paths(base, new, part):
                _delete_path(spark, path)
        _delete_path(spark, gone)
