"""Operator 5: exact token counts of every prefix of a text.

Dynamic programming over prefixes finds the last token of each prefix and, from it, the
prefix's token count. The counts answer truncation and budget questions without encoding
again: ``count_at`` and ``longest_within`` are plain column expressions on them.
"""
from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contactlake.llm.common import map_text, table
from contactlake.llm.op4_pieces import MODEL, model_bytes
from contactlake.llm.piece_batch import Prefixes, loaded

LIMIT = 4096

COUNTS = T.StructType([T.StructField("counts", T.ArrayType(T.IntegerType()))])


def prefix_counts(docs: DataFrame, model: str, text: str = "text", keep=None) -> DataFrame:
    """``(row, out)`` with ``out.counts``: entry k (from 0) is the number of tokens of the
    first k + 1 characters of the text, as if that prefix were encoded alone.

    A null text counts as empty and has no entries. Texts of any length are counted whole;
    repeated rows each; other columns stay in ``row``. Counts may fall as a prefix grows.
    """
    send = docs.sparkSession.sparkContext.broadcast(model_bytes(model))

    def fn(texts: list[str]) -> pa.Array:
        values, n = loaded(Prefixes, send.value).counts(texts)
        offsets = pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32))
        return pa.StructArray.from_arrays(
            [pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()))], ["counts"])

    return map_text(docs, fn, COUNTS, text, keep, rows=2500, most=8 << 20)


def count_at(counts: Column, chars: Column | int) -> Column:
    """Tokens of the first ``chars`` characters (all of them if there are fewer)."""
    n = F.least(F.lit(chars) if isinstance(chars, int) else chars, F.size(counts))
    return F.when(n <= 0, F.lit(0)).otherwise(F.try_element_at(counts, n))


def longest_within(counts: Column, budget: int) -> Column:
    """Characters of the longest prefix that has at most ``budget`` tokens."""
    fits = F.transform(counts, lambda n, k: F.when(n <= budget, k + 1).otherwise(0))
    return F.coalesce(F.array_max(fits), F.lit(0))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document; ``fit_chars`` is the length of its longest prefix
    within the limit, read from the prefix counts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sized = docs.withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long"))
    got = prefix_counts(sized, public_tokenizers.path(MODEL), keep=["doc_id", "n_bytes"])
    counts = F.col("out.counts")
    total = count_at(counts, F.size(counts)).cast("long")
    return got.select(
        F.col("row.doc_id").alias("doc_id"), F.col("row.n_bytes").alias("n_bytes"),
        total.alias("n_tokens"), (total > LIMIT).alias("over_limit"),
        F.when(total > LIMIT, longest_within(counts, LIMIT)).otherwise(F.size(counts))
        .cast("long").alias("fit_chars"))
