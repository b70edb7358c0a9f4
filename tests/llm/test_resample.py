import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from contactlake.llm import op3_resample as op


def test_kth_largest(spark):
    rnd = random.Random(1)
    for values in ([rnd.gauss(0, 1) for _ in range(500)], [1.0] * 50 + [2.0] * 3, [5.0], [rnd.choice([1e-300, 1.0, 1e300]) for _ in range(99)],
                   [-1.0, np.nextafter(-1.0, 0.0), 0.0, -0.0]):
        frame = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "key double")
        for k in {1, 2, len(values) // 2 + 1, len(values)}:
            if k <= len(values):
                assert op.kth_largest(frame, "key", k) == sorted(values, reverse=True)[k - 1]
        assert op.kth_largest(frame, "key", len(values) + 1) is None


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def test_weights_against_brute_force(spark, make_docs, awkward):
    docs = [(10 + i, f"good words here {i}", "s") for i in range(20)] + [(50 + i, f"bad junk zz {i}", "s") for i in range(20)] + awkward
    known = labels(spark, [(10 + i, 1, 0, "") for i in range(10)] + [(50 + i, 0, 0, "") for i in range(10)] + [(None, 1, 0, ""), (1, None, None, "")])
    frame = make_docs(docs)
    every, target = op.feature_counts(frame, op.target_ids(known))
    bucket, _ = op.features([t or "" for _, t, _ in docs])
    assert (every == np.bincount(bucket, minlength=op.BUCKETS)).all()
    bucket, _ = op.features([t for i, t, _ in docs if i is not None and 10 <= i < 20])
    assert (target == np.bincount(bucket, minlength=op.BUCKETS)).all()
    rows = op.resample(frame, known, share=0.4).collect()
    assert len(rows) == len(docs)
    good = [r.log_ratio for r in rows if r.row.doc_id and 10 <= r.row.doc_id < 30]
    bad = [r.log_ratio for r in rows if r.row.doc_id and 50 <= r.row.doc_id < 70]
    assert min(good) > max(bad)
    keys = sorted((r.key for r in rows if r.key is not None), reverse=True)
    cut = keys[round(0.4 * len(rows)) - 1]
    assert all(r.selected == (r.key is not None and r.key >= cut) for r in rows)
    assert all((r.n_features == 0) == (r.key is None) for r in rows)


def test_gumbel_top_k_samples_by_weight(spark, make_docs):
    """Equal weights: every document is drawn about as often, over many seeds."""
    frame = make_docs([(i, "same text", "s") for i in range(40)])
    drawn = np.zeros(40)
    for seed in range(6):
        rows = op.resample(frame, labels(spark, []), share=0.5, seed=seed).filter("selected").select("row.doc_id").collect()
        assert len(rows) == 20
        drawn[[r.doc_id for r in rows]] += 1
    assert 0.5 < drawn.std() < 2


def test_empty_tables(spark, make_docs):
    assert op.resample(make_docs([]), labels(spark, [])).count() == 0
    assert not op.resample(make_docs([(1, "a", "s")]), labels(spark, [])).first().selected


def test_held_out_accuracy(spark):
    """The model is fitted on labelled rows of even ids and judged on those of odd ids."""
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    known = spark.read.parquet(f"{sf}/labels.parquet")
    ratios = op.log_ratios(*op.feature_counts(docs, op.target_ids(known.filter("doc_id % 2 = 0"))))
    got = op.weights(docs, ratios, keep=["doc_id"]).select("row.doc_id", (F.col("out.log_ratio") / F.col("out.n_features")).alias("w"))
    rows = got.join(known.filter("doc_id % 2 = 1"), "doc_id").filter("w is not null").collect()
    good = np.array([r.w for r in rows if r.quality == 1 and r.toxic == 0])
    rest = np.array([r.w for r in rows if r.quality == 0 or r.toxic == 1])
    ranks = np.searchsorted(np.sort(rest), good, "left") + np.searchsorted(np.sort(rest), good, "right")
    assert ranks.mean() / 2 / len(rest) > 0.85
