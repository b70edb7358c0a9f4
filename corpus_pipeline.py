"""The corpus pipeline: quality rules, near-duplicates, decontamination, secrets, pieces.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the last
return the columns of ``documents``.
"""
from __future__ import annotations

import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contactlake.llm import op2_winnow, op4_pieces, op6_quality, op8_simhash, op9_secrets
from contactlake.llm.common import small_batches, staged, table


@F.pandas_udf(T.StringType())
def _without_lines(text: pd.Series, removed: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else op6_quality.without_lines(t, set(r))
                      for t, r in zip(text, removed)], dtype=object)


def _with_text(rows: DataFrame, columns: list[str], new: Column) -> DataFrame:
    """The input's columns, where ``new`` is not null with that text and its length."""
    changed = rows.select("row", new.alias("new"))
    values = []
    for c in columns:
        old = F.col("row").getField(c)
        value = F.coalesce("new", old) if c == "text" else \
            F.coalesce(F.length("new").cast("long"), old) if c == "n_chars" else old
        values.append(value.alias(c))
    return changed.select(*values)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines above the host's limit.

    A null or empty text fails (fewer words than the least) and goes. Very long texts are judged
    whole. Repeated rows of one host share one verdict and count once for its lines; rows that
    tie for keeping a line are equal texts, and all keep it. A null host is a host of its own.
    An empty table gives none; other columns come back as they were, and ``n_chars`` follows a
    text that lost lines."""
    small_batches(spark)
    judged = op6_quality.quality_rules(docs, share=op6_quality.MOST_SHARE).filter("kept")
    hit = F.size("removed") > 0
    text = F.when(hit, F.col("row.text"))  # only these texts are sent to Python
    return _with_text(judged, docs.columns, F.when(hit, _without_lines(text, F.col("removed"))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: the one of least id, null ids last.

    Null, empty and blank texts have fingerprint zero and are one group. Very long texts are
    hashed whole. Of repeated rows, and of rows that tie for the least id, one stays. An empty
    table gives none; all columns come back as they were."""
    return op8_simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item.

    Null and empty texts have no words and stay; very long texts are searched whole; repeated
    rows are judged alike, each by itself, so there are no ties. Items that are null or have no
    words hit nothing. An empty table gives none; all columns come back as they were."""
    found = op2_winnow.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    clean = found.filter(F.size("out.spans") == 0)
    return clean.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kinds.

    Null and empty texts have none and stay as they are; very long texts are scanned whole;
    repeated rows are masked alike. Overlapping spans are one run, named by the first (ties by
    the order of kinds). An empty table gives none; other columns come back as they were, and
    ``n_chars`` follows a masked text."""
    return _with_text(op9_secrets.find_secrets(docs, masked=True), docs.columns, F.col("out.masked"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, and whether they decode to its text. White-space
    signs of the vocabulary in a text decode to white space.

    A null text counts as empty and has no ids; very long texts are encoded whole; repeated rows
    each, alike; pieces of equal score merge from the left, as in the library. An empty table
    gives none."""
    coded = op4_pieces.encode(docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text")),
                              public_tokenizers.path(op4_pieces.MODEL), decoded=True)
    return coded.select("row.doc_id", "row.lang", "row.source", F.size("out.ids").cast("long").alias("n_tokens"),
                        F.col("out.ids").alias("ids"), (F.col("out.decoded") == F.col("row.text")).alias("lossless"))


STAGES = [("quality rules", quality), ("near-duplicates", near_duplicates),
          ("decontamination", decontaminate), ("secret scan", secrets), ("sentencepiece", pieces)]

#: near-duplicate fingerprints, spans and pieces cannot be expressed in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"stage{k}")
    return docs
