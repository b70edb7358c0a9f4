import random
import re

import numpy as np
import pytest
import xxhash

from contactlake.llm import op8_simhash as op

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {ord("A") + i: chr(ord("a") + i) for i in range(26)}


def brute_print(text):
    w = WORD.findall((text or "").translate(UPPER))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(prints, radius):
    """The least member that each value reaches."""
    todo, least = set(prints), {}
    while todo:
        seen, new = set(), {min(todo)}
        while new:
            seen |= new
            new = {p for p in todo - seen if any((p ^ q).bit_count() <= radius for q in new)}
        least |= {p: min(seen) for p in seen}
        todo -= seen
    return least


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def near(rnd, x, most):
    for b in rnd.sample(range(64), rnd.randint(0, most)):
        x ^= 1 << b
    return x


def test_fingerprints():
    for t in ["", " ", "one", "one two", "A b C", "A b C d e f g h", "É é x\ty\nz", "a " * 500]:
        assert op.fingerprint(t) == brute_print(t), t


@pytest.mark.parametrize("bits,radius", [(64, 3), (64, 1), (30, 3), (9, 3), (4, 3)])
def test_pairs_in_reach_collide_in_some_table(bits, radius):
    rnd = random.Random(bits)
    tables = op.masks(list(range(bits)), radius)
    assert all(tables) and len(tables) == 2 ** (radius + 1) - 1
    for _ in range(400):
        diff = sum(1 << b for b in rnd.sample(range(bits), rnd.randint(0, radius)))
        assert any(not diff & m for m in tables)


@pytest.mark.parametrize("bucket", [2000, 3])
def test_components_of_fingerprints(spark, bucket):
    """A small bucket bound sends hot buckets through the further tables, down to stars."""
    rnd = random.Random(9)
    prints = [rnd.getrandbits(64) for _ in range(40)]
    for _ in range(60):
        prints.append(near(rnd, rnd.choice(prints), 4))
    centre = prints[0]
    prints += [centre ^ (1 << b) for b in range(8)] + [centre ^ 7, centre ^ 3, 0, 1]
    prints = sorted(set(prints))
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    links = op.links(frame, bucket=bucket)
    groups = {r.node: r.root for r in op.connected(links).collect()}
    assert all((a ^ b) & (1 << 64) - 1 and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3 for a, b in links.collect())
    want = brute_groups(prints, 3)
    for p in prints:
        for q in prints:
            same = groups.get(signed(p), signed(p)) == groups.get(signed(q), signed(q))
            assert same == (want[p] == want[q])


def test_documents(make_docs, awkward):
    rnd = random.Random(2)
    base = [" ".join(rnd.choice("abcdefghij") * rnd.randint(1, 3) for _ in range(120)) for _ in range(6)]
    docs = list(awkward)
    for i in range(40):
        w = rnd.choice(base).split()
        if rnd.random() < 0.6:
            w[rnd.randrange(len(w))] = "changed"
        docs.append((100 + i, " ".join(w), "s"))
    got = op.near_duplicates(make_docs(docs)).collect()
    assert len(got) == len(docs)
    want = brute_groups({brute_print(t) for _, t, _ in docs}, 3)
    members = {}
    for i, t, _ in docs:
        if i is not None:
            members.setdefault(want[brute_print(t)], []).append(i)
    for r in got:
        p = brute_print(r.row.text)
        assert r.fingerprint == signed(p) and r.component_id == min(members.get(want[p], [None]))
    left = op.one_of_each(make_docs(docs))
    assert left.columns == make_docs(docs).columns
    rows = left.collect()
    assert sorted(want[brute_print(r.text)] for r in rows) == sorted(set(want.values()))
    assert all(r.doc_id == min(members.get(want[brute_print(r.text)], [None])) for r in rows)


def test_empty_table(make_docs):
    assert op.near_duplicates(make_docs([])).count() == 0 and op.one_of_each(make_docs([])).count() == 0


def test_forest_links_everything_in_reach():
    values = np.array([0, 1, 3, 7, 15, 1 << 40], np.int64)
    links = op._forest(values, 1)
    assert len(links) == 5
