import math
import random
import re
from collections import Counter

import duckdb
import pytest

from contactlake.llm import op1_backoff as op

WORD = re.compile("[0-9a-z\x80-\U0010FFFF]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def grams(w, n):
    return [tuple(w[i:i + n]) for i in range(len(w) - n + 1)]


def brute(texts, order, alpha, leave_out):
    docs = [words(t) for t in texts]
    count = Counter(g for w in docs for n in range(1, order + 1) for g in grams(w, n))
    total, out = sum(map(len, docs)), []
    for w in docs:
        own = Counter(g for n in range(1, order + 1) for g in grams(w, n)) if leave_out else Counter()
        c = lambda g: count[g] - own[g]
        n_corpus = max(1, total - (len(w) if leave_out else 0))

        def score(g):
            if len(g) == 1:
                return max(c(g), alpha) / n_corpus
            return c(g) / c(g[:-1]) if c(g) > 0 else alpha * score(g[1:])

        out.append((len(w), sum(math.log(score(tuple(w[max(0, i - order + 1):i + 1]))) for i in range(len(w)))))
    return out


@pytest.mark.parametrize("order,leave_out,parts", [(3, True, 8), (3, False, 1), (1, True, 2), (5, True, 4)])
def test_against_brute_force(make_docs, awkward, monkeypatch, order, leave_out, parts):
    monkeypatch.setattr(op, "SLICE_BYTES", 2000)
    rnd = random.Random(order)
    texts = [" ".join(rnd.choice(["a", "B", "c", "d1", "é"]) for _ in range(rnd.randint(0, 60))) for _ in range(50)]
    docs = [(i, t, "s") for i, t in enumerate(texts)] + awkward
    got = op.backoff_scores(make_docs(docs), order=order, leave_out=leave_out, parts=parts).collect()
    want = brute([t for _, t, _ in docs], order, op.ALPHA, leave_out)
    key = lambda x: (str(x[0]), x[1], round(x[2], 5))
    rows = sorted(key((r.row.doc_id, r.out.n_words, r.out.log_score)) for r in got)
    assert rows == sorted(key((i, *s)) for (i, _, _), s in zip(docs, want))


def test_empty_tables(make_docs):
    assert op.backoff_scores(make_docs([])).count() == 0
    rows = op.backoff_scores(make_docs([(1, None, None), (2, "", "s")])).collect()
    assert sorted((r.row.doc_id, r.out.n_words, r.out.log_score) for r in rows) == [(1, 0, 0.0), (2, 0, 0.0)]


def test_packing():
    import numpy as np
    rnd = np.random.default_rng(1)
    v = np.unique(rnd.integers(0, 1 << 64, 1000, dtype=np.uint64))
    assert (op.unpack(op.pack(v)) == v).all() and (op.unpack(op.pack(v[:0])) == v[:0]).all()
    for top in (1, 300, 70_000, 1 << 40):
        c = rnd.integers(0, top, 50)
        assert (op.unpack_counts(op.pack_counts(c)) == c).all()


def test_query_agrees_with_sql(spark):
    sf = "/root/testdata/sf0.001"
    got = op.op1_backoff_scores(spark, sf)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{sf}/documents.parquet')")
    want = con.execute(op.ORACLE)
    names = [d[0] for d in want.description]
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == sorted(want.fetchall())
