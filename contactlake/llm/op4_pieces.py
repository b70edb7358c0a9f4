"""Operator 4: SentencePiece encoding with source offsets, and decoding.

Normalisation walks the model's compiled character map by longest prefix and records the
source byte of every normalised character; the spans of the pieces are projected through
that alignment to bytes of the original text.
"""
from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contactlake.llm.common import hex_sha256, map_column, map_text, table
from contactlake.llm.piece_batch import Encoder, loaded

MODEL = "piece_bpe_32k.model"

_INTS = T.ArrayType(T.IntegerType(), containsNull=True)
ENCODED = T.StructType([T.StructField("ids", _INTS), T.StructField("begins", _INTS),
                        T.StructField("ends", _INTS), T.StructField("decoded", T.StringType())])


def model_bytes(path: str) -> bytes:
    """The model file (about half a megabyte), read on the driver and sent with the tasks."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: str, text: str = "text", keep=None,
           decoded: bool = False) -> DataFrame:
    """``(row, out)`` with ``out.ids``, and per id ``out.begins`` and ``out.ends``: the bytes
    of the original text under its piece (end exclusive). With ``decoded``, ``out.decoded``
    is the text that the ids decode to, else null.

    No begin or end ids, no sampling. A null text counts as empty and has no ids. The span
    of a character that falls back to bytes is on its last byte id. Repeated rows are
    encoded each; very long texts are encoded whole; other columns stay in ``row``.
    """
    send = docs.sparkSession.sparkContext.broadcast(model_bytes(model))

    def fn(texts: list[str]) -> pa.Array:
        coder = loaded(Encoder, send.value)
        ids, begin, end, n = coder.encode(texts)
        offsets = pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32))
        cols = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (ids, begin, end)]
        back = coder.decode(ids, n) if decoded else pa.nulls(len(n), pa.string())
        return pa.StructArray.from_arrays([*cols, back], ["ids", "begins", "ends", "decoded"])

    return map_text(docs, fn, ENCODED, text, keep, rows=2500, most=8 << 20)


def decode(rows: DataFrame, model: str, ids: str = "ids", keep=None) -> DataFrame:
    """``(row, out)`` with ``out.text``: the text that the id array ``ids`` decodes to. Null
    or empty ids give an empty text; null entries are skipped; ids outside the model raise."""
    send = rows.sparkSession.sparkContext.broadcast(model_bytes(model))

    def fn(values: list) -> pa.Array:
        coder = loaded(Encoder, send.value).model
        texts = [coder.decode(i for i in v or () if i is not None) for v in values]
        return pa.StructArray.from_arrays([pa.array(texts, pa.string())], ["text"])

    return map_column(rows, fn, T.StructType([T.StructField("text", T.StringType())]), ids, keep)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, and decoded again; ``n_covered`` counts the bytes under the
    pieces, which are all bytes of the text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode(docs, public_tokenizers.path(MODEL), keep=["doc_id"], decoded=True)
    ids, begins, ends = F.col("out.ids"), F.col("out.begins"), F.col("out.ends")
    covered = F.aggregate(F.zip_with(ends, begins, lambda e, b: e - b), F.lit(0).cast("long"),
                          lambda total, n: total + n)
    return coded.select(
        F.col("row.doc_id").alias("doc_id"),
        F.size(ids).cast("long").alias("n_tokens"),
        hex_sha256(F.array_join(ids.cast("array<string>"), ",")).alias("ids_sha256"),
        hex_sha256(F.col("out.decoded")).alias("decoded_sha256"),
        covered.alias("n_covered"))
