"""Batch sources S1-S4, S9: API page files, CSV files, latest batch, created-since."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import API_PROPERTIES_SCHEMA, CSV_SCHEMA
from ..session import ensure_utc
from .framing import framed, ingest_seq, line_columns
from .sinks import list_batches, read_manifest, run_exists, run_path

CSV_DDL = ", ".join(f"{f.name} string" for f in CSV_SCHEMA.fields)


def api_records_from_docs(docs: DataFrame) -> DataFrame:
    """JSON documents in column ``doc`` (an API page ``{results:[...], paging}``, a bare
    array of contacts, or one contact object) → one row per contact record.

    Each document is parsed once into VARIANT. The record keeps that value in ``raw``
    (V3 checks JSON types on it, the quarantine keeps its text); ``id`` and
    ``properties`` are read from it with the typed API schema, which, like a JSON read,
    turns a number into its text. Of a document that is not JSON every line is one of its
    own; one that is not JSON either, or neither object nor array, is one record whose
    ``raw`` is its text as a string.

    With the columns ``line`` and ``at`` (``framing.framed``) ``ingest_seq`` is the record's
    position in the batch, the same for every split size and number of cores."""
    placed = "line" in docs.columns
    keep = [c for c in docs.columns if c not in ("doc", "line", "at")]
    doc = F.col("doc")
    parsed = docs.withColumn("_v", F.try_parse_json("doc"))

    def line_value(x):
        # the parser stops after one value: within brackets of either kind nothing may follow
        one = F.try_parse_json(F.concat(F.lit("["), x, F.lit("]"))).isNotNull() \
            & F.try_parse_json(F.concat(F.lit('{"d":'), x, F.lit("}"))).isNotNull()
        return F.when(one, F.try_parse_json(x))

    whole = F.array(F.struct(F.lit(0).alias("k"), doc.alias("text"), F.col("_v").alias("v")))
    torn = F.filter(F.transform(F.split("doc", "\n"), lambda x, k: F.struct(
        k.alias("k"), x.alias("text"), line_value(x).alias("v"))), lambda x: F.trim(x["text"]) != "")
    parts = parsed.select(*keep, *(["line", "at"] if placed else []),
                          F.explode(F.when(F.col("_v").isNotNull(), whole).otherwise(torn)).alias("_part"))
    v = F.col("_part.v")
    # the first sign tells objects and arrays; the schema of a variant would look at all of it
    first = F.when(v.isNotNull(), F.substring(F.ltrim("_part.text", F.lit(" \t\r\n")), 1, 1))
    results = F.try_variant_get(v, "$.results", "variant")
    arr = F.when((first == "{") & results.isNotNull(),
                 F.try_variant_get(v, "$.results", "array<variant>")) \
        .when(first == "[", F.try_variant_get(v, "$", "array<variant>")) \
        .when(first == "{", F.array(v)) \
        .otherwise(F.array(F.col("_part.text").cast("variant")))
    place = [(F.col("line") + F.col("_part.k")).alias("_line"),
             F.when(F.col("_part.k") == 0, F.col("at")).otherwise(0).alias("_at")] if placed else []
    recs = parts.select(*keep, *place, F.posexplode(arr).alias("_pos", "raw"))
    seq = ingest_seq(F.col("_line"), F.col("_at") + F.col("_pos")) if placed else F.monotonically_increasing_id()
    return recs.select(*keep, "_pos", "raw",
                       F.try_variant_get("raw", "$.id", "string").alias("id"),
                       F.try_variant_get("raw", "$.properties",
                                         API_PROPERTIES_SCHEMA.simpleString()).alias("properties"),
                       seq.alias("ingest_seq"))


def api_records_from_lines(lines: DataFrame) -> DataFrame:
    """Records of JSON text lines (``framing.line_columns``)."""
    return api_records_from_docs(framed(lines, "json").withColumnRenamed("file", "_file"))


def csv_records_from_lines(lines: DataFrame) -> DataFrame:
    """Records of CSV text lines (``framing.line_columns``), each parsed on its own."""
    cells = F.from_csv("doc", CSV_DDL, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "escape": '"', "multiLine": "true"})
    return framed(lines, "csv").select(cells.alias("_row"), F.col("file").alias("_file"), "line") \
        .select("_row.*", "_file", ingest_seq(F.col("line"), F.lit(0).cast("long")).alias("ingest_seq"))


def read_api_contacts(spark: SparkSession, path: str) -> DataFrame:
    """Landed API page files (or arrays / single objects) → one record per contact.

    Documents may stand one on a line (JSON Lines), several on a line, or over many lines of
    any number; files are split inside either way, and a document that spans splits is put
    together. Text that is no document is a record of its own (see
    ``api_records_from_docs``), so every landed text is found again."""
    ensure_utc(spark)
    return api_records_from_lines(spark.read.text(path).select(*line_columns()))


def read_csv_contacts(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV, UTF-8, every cell a string; malformed rows are kept with their
    text in ``_corrupt_record`` (the validator tells short rows from long ones). Quoted cells
    may hold line breaks; files are split inside."""
    ensure_utc(spark)
    return csv_records_from_lines(spark.read.text(path).select(*line_columns()))


def batch_names(spark: SparkSession, base: str, run_col: str = "run_id") -> list[str]:
    """Batch names of a store laid out as ``base/<run_col>=<name>/``, from the directory
    listing alone (one entry per batch; no data file is opened)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    head = f"{run_col}="
    return [unescape(st.getPath().getName()[len(head):]) for st in fs.listStatus(path)
            if st.isDirectory() and st.getPath().getName().startswith(head)]


def read_latest_batch(spark: SparkSession, base: str, container: str, prefix: str = "",
                      fmt: str = "parquet", schema=None) -> DataFrame:
    """S3: the records of the lexically greatest batch whose name begins with ``prefix``,
    taken from the stored manifest; only that batch is opened. Empty when there is none."""
    names = list_batches(read_manifest(spark, base).where(F.col("container") == container), prefix)
    top = names.agg(F.max("blob_name").alias("m")).first()["m"]
    return read_batch(spark, base, container, top, fmt, schema)


def created_since(df: DataFrame, since, col: str = "created_at") -> DataFrame:
    """Optional created-after cut, pushed to the Parquet scan as a filter; on the core
    table (partitioned by ``created_month``) a month bound prunes whole partitions too."""
    if since is None:
        return df
    lower = F.lit(since).cast("timestamp")
    out = df.where(F.col(col) >= lower)
    if col == "created_at" and "created_month" in df.columns:
        out = out.where(F.col("created_month") >= F.trunc(F.to_date(lower), "month"))
    return out


def read_batch(spark: SparkSession, base: str, container: str, name: str | None, fmt: str = "parquet",
               schema=None) -> DataFrame:
    """Records of one named batch, opening only its directory; an unknown name gives an
    empty result (of ``schema``, if given).

    A JSON batch may hold objects on lines or over many lines, and arrays of objects: an
    object is one record, as is each element of an array. It is read with ``schema`` (the
    batch's own fields, no inference over other batches), or as text in a column ``record``."""
    path = os.path.join(base, container)
    if name is None or not run_exists(spark, path, name):
        return spark.createDataFrame([], schema or T.StructType([T.StructField("run_id", T.StringType())]))
    if fmt != "json":
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.format(fmt).option("basePath", path).load(run_path(path, name))
    docs = framed(spark.read.text(run_path(path, name)).select(*line_columns()), "json").select("doc")
    value = F.try_parse_json("doc")
    arr = F.when(F.schema_of_variant(value).startswith("ARRAY"), F.try_variant_get(value, "$", "array<variant>")) \
        .otherwise(F.array(value))
    record = F.to_json("record").alias("record")
    records = docs.select(F.explode(arr).alias("record")).select(record)
    if schema is None:
        return records.withColumn("run_id", F.lit(name))
    own = T.StructType([f for f in schema.fields if f.name != "run_id"])
    return records.select(F.from_json("record", own).alias("r")).select("r.*", F.lit(name).alias("run_id"))
