"""Shared helpers of the training-data operators."""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contactlake.session import scratch_path

#: text bytes that one Python call works on; a longer text is a call of its own
PIECE_BYTES = 2 << 20
#: rows of one Arrow batch, so that a batch of long texts stays small
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def col(name: str) -> Column:
    """A top-level column by its exact name (dots and back-ticks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the Arrow batches of the session (runtime SQL settings)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pieces(batch: pa.RecordBatch, at: int, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose texts (string column ``at``) hold about ``most`` bytes."""
    sizes = pc.binary_length(batch.column(at)).fill_null(0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def map_text(docs: DataFrame, fn: Callable[[list[str]], pa.Array], out: T.StructType,
             text: str = "text", keep: Sequence[str] | None = None,
             rows: int = BATCH_ROWS, most: int = PIECE_BYTES) -> DataFrame:
    """``(row, out)``: ``fn`` turns the texts of a slice (null: empty) into a struct array.

    Rows are independent, so nothing is shuffled and a lost task is simply run again.
    ``row`` holds the columns ``keep`` (default: all) of the input row. A batch has at most
    ``rows`` rows, a slice about ``most`` bytes of text (or one text).
    """
    def sliced(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
        for part in pieces(batch, 1, most):
            yield part, [t or "" for t in part.column(1).to_pylist()]

    return _mapped(docs, col(text).cast("string"), fn, out, keep, rows, sliced)


def map_column(df: DataFrame, fn: Callable[[list], pa.Array], out: T.StructType, name: str,
               keep: Sequence[str] | None = None, rows: int = BATCH_ROWS) -> DataFrame:
    """``(row, out)`` like ``map_text``, from the values of any column."""
    return _mapped(df, col(name), fn, out, keep, rows,
                   lambda batch: [(batch, batch.column(1).to_pylist())])


def _mapped(df, value, fn, out, keep, rows, sliced) -> DataFrame:
    small_batches(df.sparkSession, rows)
    keep = df.columns if keep is None else list(keep)
    slim = df.select(F.struct(*[col(c) for c in keep]).alias("row"), value.alias("value"))
    schema = T.StructType([slim.schema["row"], T.StructField("out", out)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, values in sliced(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), fn(values)], ["row", "out"])

    return slim.mapInArrow(run, schema)


def lists(values, ends, kind: pa.DataType) -> pa.ListArray:
    """A list array from flat values and the running ends of its lists."""
    offsets = pa.array([0, *ends], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(values, kind))


def hex_sha256(c: Column) -> Column:
    return F.sha2(c, 256)
