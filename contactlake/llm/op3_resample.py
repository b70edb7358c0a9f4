"""Operator 3: quality selection by importance resampling.

Two bag-of-hashed-n-grams models are fitted, one on target text and one on all text; the
importance weight of a document is the ratio of its likelihoods, and a sample without
replacement is the top k of log weights plus Gumbel noise.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contactlake.llm.common import col, map_text, pieces, small_batches, staged, table
from contactlake.llm.words import Words, byte_classes, mix

#: hashed features; documented bound of the labelled rows that the target model is fitted on
BUCKETS, TARGET_ROWS = 1 << 16, 20_000
#: weight of the mean log ratio of a document's features against the noise
SHARPNESS = 1000.0
SEED = 17
#: bins of one step of the search for the k-th largest key
BINS = 1000

WEIGHT = T.StructType([T.StructField("n_features", T.LongType()), T.StructField("log_ratio", T.DoubleType())])


#: runs of ASCII punctuation, and a number that keeps their hashes from those of words
PUNCTUATION = byte_classes(lambda b: 33 <= b < 48 or 58 <= b < 65 or 91 <= b < 97 or 123 <= b < 127, lower=False)
_APART = np.uint64(99)


def features(texts: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words, word pairs and runs of punctuation, and the text of each."""
    words, signs = Words(texts), Words(texts, PUNCTUATION)
    one, _ = words.grams(1)
    two, whole = words.grams(2)
    at = np.flatnonzero(whole)
    bucket = np.concatenate((one, two[at], mix(signs.hash + _APART))) % np.uint64(buckets)
    return bucket.astype(np.int64), np.concatenate((words.doc, words.doc[at], signs.doc))


def target_ids(labels: DataFrame, ident: str = "doc_id", rows: int = TARGET_ROWS) -> DataFrame:
    """Ids labelled as good and not toxic: at most ``rows``, those of least hash."""
    good = labels.filter((F.col("quality") == 1) & (F.col("toxic") == 0) & col(ident).isNotNull())
    return good.select(col(ident).alias("ident")).distinct().orderBy(F.xxhash64("ident", F.lit(SEED)), "ident").limit(rows)


def feature_counts(docs: DataFrame, targets: DataFrame, ident: str = "doc_id", text: str = "text",
                   buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Feature counts of all documents, and of the target documents, in one pass.

    ``targets`` is bounded by ``target_ids`` and is broadcast. Every task sends one count for
    each bucket; the driver gets ``buckets`` sums."""
    small_batches(docs.sparkSession)
    marked = docs.select(col(ident).alias("ident"), col(text).cast("string").alias("text")) \
        .join(F.broadcast(targets.withColumn("target", F.lit(True))), "ident", "left") \
        .select("text", F.coalesce("target", F.lit(False)).alias("target"))

    def run(batches):
        every, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for part in pieces(batch, 0):
                bucket, doc = features([t or "" for t in part.column(0).to_pylist()], buckets)
                every += np.bincount(bucket, minlength=buckets)
                mark = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
                target += np.bincount(bucket[mark[doc]], minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), pa.array(every), pa.array(target)],
                                         ["bucket", "n", "n_target"])

    sums = marked.mapInArrow(run, "bucket long, n long, n_target long").groupBy("bucket") \
        .agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target")).collect()
    every, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for r in sums:
        every[r["bucket"]], target[r["bucket"]] = r["n"], r["n_target"]
    return every, target


def log_ratios(every: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the log of the smoothed target share over that of all text."""
    share = [np.log(c + 1.0) - np.log(c.sum() + len(c)) for c in (target, every)]
    return share[0] - share[1]


def weights(docs: DataFrame, ratios: np.ndarray, text: str = "text", keep=None) -> DataFrame:
    """``(row, out)``: ``out.n_features`` and ``out.log_ratio``, the summed log ratio of the
    text's features (the log importance weight). Null and empty texts have none."""
    def fn(texts: list[str]) -> pa.Array:
        bucket, doc = features(texts, len(ratios))
        return pa.StructArray.from_arrays(
            [pa.array(np.bincount(doc, minlength=len(texts)).astype(np.int64)),
             pa.array(np.bincount(doc, weights=ratios[bucket], minlength=len(texts)).astype(np.float64))],
            ["n_features", "log_ratio"])

    return map_text(docs, fn, WEIGHT, text, keep)


def kth_largest(keys: DataFrame, name: str, k: int) -> float | None:
    """The k-th largest value of a column (nulls aside), by histograms of the rows in reach:
    each step keeps one of ``BINS`` bins. None if there are fewer values; k from 1."""
    rows = keys.select(col(name).alias("key")).filter(F.col("key").isNotNull())
    got = rows.agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).first()
    if got["n"] < k:
        return None
    low, high = got["low"], got["high"]
    while low < high:
        width = (high - low) / BINS
        bin_ = F.least(F.floor((F.col("key") - low) / width), F.lit(BINS - 1)) if width > 0 else F.lit(0)
        reach = rows.filter(F.col("key").between(low, high)).groupBy(bin_.alias("bin")) \
            .agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect()
        for r in sorted(reach, key=lambda r: -r["bin"]):
            if r["n"] >= k:
                break
            k -= r["n"]
        if (r["low"], r["high"]) == (low, high):  # no step between neighbouring numbers
            at_high = rows.filter(F.col("key") == high).count()
            return high if at_high >= k else low
        low, high = r["low"], r["high"]
    return low


def resample(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", keep=None,
             share: float | None = None, sharpness: float | None = SHARPNESS, seed: int = SEED,
             target_rows: int = TARGET_ROWS) -> DataFrame:
    """``(row, n_features, log_ratio, key, selected)``.

    ``selected`` marks the k documents of the largest keys, where k is ``share`` of the
    documents (default: the share of good and not toxic rows among the labels). The key is
    the log weight plus Gumbel noise drawn from a hash of id and seed. With ``sharpness``
    the log weight is that many times the mean log ratio per feature, so that long and short
    texts compete alike; with None it is the plain sum. Documents of equal key at the border
    are all selected; a text without features has no key and is not. Without labels nothing is
    on target and all ratios follow the smoothing. A null id gets the noise of its seed.
    """
    good = F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))
    if share is None:
        share = labels.agg(F.avg(good.cast("double"))).first()[0] or 0.0
    targets = target_ids(labels, rows=target_rows)
    ratios = log_ratios(*feature_counts(docs, targets, ident, text))
    columns = docs.columns if keep is None else list(keep)
    named = docs.select(F.struct(*[col(c) for c in columns]).alias("row"), col(ident).alias("ident"),
                        col(text).alias("text"))
    out = weights(named, ratios, "text", ["row", "ident"])
    n, ratio = F.col("out.n_features"), F.col("out.log_ratio")
    draw = (F.shiftrightunsigned(F.xxhash64("row.ident", F.lit(seed)), 11) + 0.5) / float(1 << 53)
    weight = ratio if sharpness is None else sharpness * ratio / n
    scored = staged(out.select("row.row", n.alias("n_features"), ratio.alias("log_ratio"),
                               F.when(n > 0, weight - F.log(-F.log(draw))).alias("key")), "weights")
    total = scored.count()
    k = round(share * total)
    cut = kth_largest(scored, "key", k) if k else float("inf")
    chosen = F.col("key").isNotNull() if cut is None else F.coalesce(F.col("key") >= cut, F.lit(False))
    return scored.withColumn("selected", chosen)


def op3_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its weight, and whether it is in the sample."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    got = resample(docs, labels, keep=["doc_id"])
    return got.select(F.col("row.doc_id").alias("doc_id"), "n_features", F.round("log_ratio", 6).alias("log_ratio"),
                      F.round("key", 6).alias("key"), F.col("selected").alias("kept"))
