import hashlib
import random
import re

import duckdb

from contactlake.llm import op6_quality as op

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def norm(line):
    return re.sub("[0-9]+", "0", " ".join(WORD.findall(line)).lower())


def brute(docs, most, left, share=None, least_line=1):
    """Facts and verdicts of (id, text, host) rows; ``share``: of the host's distinct texts."""
    holders, texts = {}, {}
    for _, t, host in docs:
        texts.setdefault(host, set()).add(t or "")
        for x in (t or "").split("\n"):
            if len(WORD.findall(x)) >= least_line:
                holders.setdefault((host, norm(x)), set()).add(hashlib.md5((t or "").encode()).hexdigest())
    out = []
    for i, t, host in docs:
        t = t or ""
        w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        windows = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        inside = {p for k, x in enumerate(windows) if windows.count(x) > 1 for p in (k, k + 1, k + 2)}
        key = hashlib.md5(t.encode()).hexdigest()
        gone = sum(len(WORD.findall(x)) for x in lines
                   if len(WORD.findall(x)) >= least_line and len(holders[host, norm(x)]) > most
                   and (share is None or 100 * len(holders[host, norm(x)]) > share * len(texts[host]))
                   and key != min(holders[host, norm(x)]))
        failed = len(w) < op.LEAST_WORDS or 100 * len(inside) > op.MOST_REPEATED * len(w)
        out.append((str(i), len(w), sum(map(len, w)), sum(c in op.SYMBOLS for c in t), len(lines) - len(set(lines)),
                    len(inside), gone, failed, not failed and 100 * (len(w) - gone) >= left * len(w)))
    return sorted(out)


def test_against_brute_force(make_docs, awkward):
    rnd = random.Random(4)
    lines = [" ".join(rnd.choice(["ab", "Cd", "e#f", "12", "x|y", "q"]) for _ in range(rnd.randint(1, 12))) for _ in range(40)]
    docs = [(i, "\n".join(rnd.choice(lines) if rnd.random() < 0.6 else f"own {i} {k} " * 3 for k in range(rnd.randint(0, 14))),
             rnd.choice(["h0", "h0", "h1", None])) for i in range(120)]
    docs += [(1000 + i, docs[5][1], "h0") for i in range(30)]  # exact copies count once
    docs += [(i, t[:3000] if t else t, s) for i, t, s in awkward]
    got = op.quality_rules(make_docs(docs), most_documents=4).collect()
    rows = sorted((str(r.row.doc_id), *(r.out[n] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
                   r.removed_words, r.base_failed, r.kept) for r in got)
    assert rows == brute(docs, 4, op.LEAST_LEFT)
    assert any(r[6] for r in rows)


def test_a_frequent_line_stays_in_one_document(make_docs):
    own = lambda i: " ".join("abcdefghij"[i] * (k + 1) for k in range(60))
    docs = [(i, own(i) + "\nsame line 7 here", "h") for i in range(10)]
    got = op.quality_rules(make_docs(docs), most_documents=3).collect()
    assert sorted(r.removed_words for r in got) == [0] + [4] * 9 and all(r.kept for r in got)
    gone = next(r for r in got if r.removed)
    assert op.without_lines(gone.row.text, set(gone.removed)) == gone.row.text.split("\n")[0]


def test_depleted_documents_are_rejected(make_docs):
    block = "\n".join(" ".join(f"b{j}y{k}" for k in range(12)) for j in range(6))
    docs = [(i, block + f"\nown words of {i}", "h") for i in range(8)]
    got = op.quality_rules(make_docs(docs), most_documents=3).collect()
    assert sum(r.kept for r in got) == 1


def test_limit_as_a_share_of_the_host(make_docs):
    own = lambda i: " ".join(f"w{'abcdefghij'[i % 10] * (i // 10 + 1)}{'xyz'[k % 3]}{'q' * k}" for k in range(55))
    small = [(i, own(i) + "\nall rights reserved\nles." * (i < 10), "small") for i in range(40)]  # 25 % of the host
    small += [(900 + i, small[0][1], "small") for i in range(30)]  # exact copies count once
    large = [(1000 + i, own(i) + "\nsee also page 7" * (i < 12), "large") for i in range(150)]  # 8 %: ordinary
    few = [(2000 + i, own(i) + "\nof five only", "few") for i in range(5)]  # under the floor
    got = op.quality_rules(make_docs(small + large + few), share=op.MOST_SHARE).collect()
    gone = {}
    for r in got:
        if r.removed:
            gone.setdefault(r.row.source, set()).add((r.row.text, r.removed_words))
        assert r.kept
    assert set(gone) == {"small"} and len(gone["small"]) == 9 and {n for _, n in gone["small"]} == {3}
    assert not any(r.removed for r in op.quality_rules(make_docs(small)).collect())  # the absolute count


def test_pipeline_takes_the_share(spark, make_docs):
    import corpus_pipeline
    own = lambda i: " ".join("abcdefghij"[i] * (k + 1) for k in range(60))
    docs = make_docs([(i, own(i) + "\nsame boilerplate", "h") for i in range(8)])
    texts = [r.text for r in corpus_pipeline.quality(spark, docs, "").collect()]
    assert sum("boilerplate" in t for t in texts) == 1 and len(texts) == 8


def test_empty_table(make_docs):
    assert op.quality_rules(make_docs([])).count() == 0


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_words", "base_failed", "kept")


def test_query_and_sql_where_the_rule_fires(spark, tmp_path):
    """Production parameters over real documents, and lines that a quarter of a host holds."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    for k, r in enumerate(rows):
        if r["source"] == "src3" and k % 2:
            r["text"] += "\nsubscribe to our letter no %d\nles." % k
        if r["source"] == "src5" and k % 3 == 0:  # little else: depleted
            r["text"] = "\n".join(" ".join(f"x{j}y{i}" for i in range(40)) for j in range(4)) + f"\nown {k}"
    spark.createDataFrame(rows, docs.schema).write.parquet(str(tmp_path / "documents.parquet"))
    got = op.op6_quality_rules(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(op.ORACLE)
    names = [d[0] for d in want.description]
    assert set(names) == set(got.columns)
    got = got.collect()
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(want.fetchall())
    assert sorted((str(r.doc_id), *(r[n] for n in NAMES)) for r in got) == brute(
        [(r["doc_id"], r["text"], r["source"]) for r in rows], op.LEAST_DOCUMENTS, op.LEAST_LEFT, op.MOST_SHARE, op.LEAST_LINE)
    assert sum(r.removed_words > 0 for r in got) > 20 and any(not r.kept and not r.base_failed for r in got)
