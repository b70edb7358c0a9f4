import random
import re

import duckdb
import numpy as np

from contactlake.llm import op2_winnow as op
from contactlake.llm.words import Words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {ord("A") + i: chr(ord("a") + i) for i in range(26)}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(text, items, span=op.SPAN):
    """Hit word positions and ids of items with hits, window by window."""
    w, hit, ids = words(text), set(), set()
    for item, t in items:
        b = words(t)
        k = min(span, len(b))
        windows = {tuple(b[i:i + k]) for i in range(len(b) - k + 1)} if k else set()
        for i in range(len(w) - k + 1) if k else ():
            if tuple(w[i:i + k]) in windows:
                hit.update(range(i, i + k))
                if item is not None:
                    ids.add(str(item))
    return len(w), len(hit), sorted(ids)


def check(got, docs, items):
    rows = sorted((r.row.doc_id is None, r.row.doc_id or 0, r.out.n_words, sum(s.end - s.start for s in r.out.spans),
                   r.out["items"]) for r in got.collect())
    want = sorted((i is None, i or 0, *brute(t, items)) for i, t, _ in docs)
    assert rows == want


def corpus(seed, n=60):
    rnd = random.Random(seed)
    vocab = ["a", "b", "Cat", "dog", "été", "x1", "Z"]
    text = lambda k: "".join(rnd.choice(vocab) + rnd.choice([" ", "  ", ", ", "\n", "-"]) for _ in range(k))
    items = [(i, text(rnd.choice([1, 2, 3, 9, 10, 11, 14, 25]))) for i in range(12)] + [(90, ""), (91, None), (None, text(12))]
    docs = []
    for i in range(n):
        t = text(rnd.randint(0, 80))
        if i % 3 == 0:
            t += " " + (rnd.choice(items[:12])[1]) + " " + text(rnd.randint(0, 10))
        docs.append((i, t, "s"))
    return docs, items


def test_against_every_window(spark, make_docs, awkward):
    docs, items = corpus(1)
    docs += awkward
    items += [(7, items[0][1]), ("11", "one two"), (12, awkward[0][1])]
    bench = spark.createDataFrame([(str(i) if i is not None else None, t, 0) for i, t in items], "item_id string, text string, row int")
    for block in (op.BLOCK_BYTES, 800):  # one block, and many
        check(op.decontaminate(make_docs(docs), bench, block_bytes=block), docs, items)


def test_empty_tables(spark, make_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert op.decontaminate(make_docs([]), bench).count() == 0
    rows = op.decontaminate(make_docs([(1, "a b c", "s")]), bench).collect()
    assert rows[0].out.n_words == 3 and rows[0].out.spans == []


def test_query_agrees_with_sql(spark):
    sf = "/root/testdata/sf0.001"
    got = op.op2_decontaminate(spark, sf)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    want = con.execute(op.ORACLE)
    names = [d[0] for d in want.description]
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == sorted(want.fetchall())


def test_every_shared_span_shares_a_fingerprint():
    rnd = random.Random(5)
    for _ in range(50):
        span = [rnd.choice("abcdefgh") for _ in range(op.SPAN)]
        sides = [[rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 30))] + span
                 + [rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 30))] for _ in range(2)]
        prints = []
        for s in sides:
            w = Words([" ".join(s)])
            prints.append(set(w.grams(op.GRAM)[0][op.winnowed(w, op.GRAM, op.WINDOW)].tolist()))
        assert prints[0] & prints[1]


def test_words_of_many_texts_and_blocks(monkeypatch):
    texts = ["", "Ab cD", "x" * 5000 + " y", "é-É", "a" * 10 + " " + "b" * 10] * 3
    whole = Words(texts)
    assert [whole.word(i).decode() for i in range(len(whole.hash))] == [w for t in texts for w in words(t)]
    monkeypatch.setattr("contactlake.llm.words.BLOCK", 64)
    assert (Words(texts).hash == whole.hash).all()
    assert whole.first.tolist() == np.cumsum([0] + [len(words(t)) for t in texts]).tolist()
