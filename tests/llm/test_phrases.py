"""Phrase mining against brute force, and its SQL."""
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from contactlake.llm import op13_phrases

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least, longest=4, share=80, top=2000):
    """Rows (lang, text) to the set of result rows."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    gone = set()
    for (lang, p), a in found.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                if 100 * a >= share * f[lang, p[i:i + k]]:
                    gone.add((lang, p[i:i + k]))
    out = []
    for (lang, p), a in found.items():
        if (lang, p) not in gone:
            score, _, l, r = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                                 for k in range(1, len(p)))
            out.append((lang, " ".join(p), a, l, r, n[lang], score))
    rows = []
    for lang in {o[0] for o in out}:
        mine = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode()))
        rows += [(lang, k, *o[1:]) for k, o in enumerate(mine[:top], start=1)]
    return sorted(rows)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def texts(seed, count=150):
    rnd = random.Random(seed)
    words = ["New", "york", "É", "the", "city", "of", "x\x00y", "\xa0", "梦", "a-b"]
    glue = [" ", "  ", "\t", ". ", ",", "\n", "\x0b", " ! "]
    rows = []
    for _ in range(count):
        text = "".join(rnd.choice(words[:rnd.randint(2, 10)]) + rnd.choice(glue[:rnd.choice([2, 8])]) for _ in range(rnd.randint(0, 40)))
        rows.append((rnd.choice(["en", "de", None, "und", ""]), text))
    return rows


@pytest.mark.parametrize("seed,least,slice_bytes", [(1, 3, 8 << 20), (2, 8, 200), (3, 1, 900)])
def test_against_brute_force(spark, monkeypatch, seed, least, slice_bytes):
    monkeypatch.setattr(op13_phrases, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(op13_phrases, "PART_PAIRS", 100)
    rows = texts(seed)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    assert rows_of(op13_phrases.phrases(docs, least=least)) == brute(rows, least)
    assert rows_of(op13_phrases.phrases(docs, least=least, longest=2, top=5)) == brute(rows, least, longest=2, top=5)


def test_repeats_overlaps_and_hot_phrase(spark):
    rows = [("en", "a a a a a a")] * 40 + [("en", "w" * 50_000 + " hot pair " * 3000)] + [("en", None), (None, ""), ("en", "...")]
    got = rows_of(op13_phrases.phrases(spark.createDataFrame(rows, "lang string, text string")))
    assert got == brute(rows, 30) and got


def test_awkward_rows_and_empty_table(make_docs, awkward):
    got = rows_of(op13_phrases.phrases(make_docs(awkward), least=3))
    assert got == brute([("en", t) for _, t, _ in awkward], 3)
    assert op13_phrases.phrases(make_docs([])).count() == 0


def test_scores_beyond_64_bits(spark, monkeypatch):
    """Counts of 10^14 make products of 2 * 10^20."""
    level1 = [(0, None, None, "en", "a", "a", 3 * 10**14, [], []), (1, None, None, "en", "b", "b", 2 * 10**14, [], [])]
    level2 = [(5, 0, 1, "en", "a b", "b", 10**14 + 7, [3 * 10**14], [2 * 10**14])]
    kind = "id long, a long, b long, lang string, phrase string, last string, f long, heads array<long>, tails array<long>"
    monkeypatch.setattr(op13_phrases, "counted_phrases", lambda *_: (
        spark.createDataFrame([("en", 10**15)], "lang string, n long"),
        [spark.createDataFrame(level1, kind), spark.createDataFrame(level2, kind)]))
    row = op13_phrases.phrases(spark.createDataFrame([], "text string, lang string"), longest=2).first()
    assert row.score == 2_000_000 * (10**14 + 7) // (5 * 10**14)


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(op13_phrases, "run_hashes", lambda data, start, end: np.zeros(len(start), np.uint64))
    got = op13_phrases.words_of(["b a", "a b"], ["en", "en"])
    assert sorted(zip(got["lang"], got["word"], got["count"].tolist())) == [("en", "a", 2), ("en", "b", 2)]


def test_packed_columns():
    a, b = np.array([0, -1, 1 << 62, 5]), np.array([7, 7, 7, -(1 << 62)])
    assert op13_phrases.unpacked(op13_phrases.packed(a, b), 2).tolist() == [a.tolist(), b.tolist()]
    assert op13_phrases.unpacked(op13_phrases.packed(a[:0]), 1).shape == (1, 0)


def test_query_and_sql(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("lang", "text").collect()
    got = rows_of(op13_phrases.op13_setm_phrases(spark, sf))
    assert got == brute([tuple(r) for r in docs], op13_phrases.LEAST)
    db = duckdb.connect()
    rows = db.execute("SELECT * FROM (SELECT 'en' AS lang, 'New york. new  york city' AS text) , range(40)").df()  # noqa: F841
    db.execute("CREATE VIEW documents AS SELECT lang, text FROM rows")
    assert sorted(db.execute(op13_phrases.ORACLE).fetchall()) == brute([("en", "New york. new  york city")] * 40, 30)
