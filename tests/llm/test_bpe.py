"""BPE by a pair occurrence index against the tokenizers library."""
import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from contactlake.llm import op11_bpe

PATH = public_tokenizers.path(op11_bpe.MODEL)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def coder():
    return op11_bpe.Coder(op11_bpe.read_model(PATH))


def ids_of(library, texts):
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def split(flat, n):
    return [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])]


SIGNS = ["a", "b", "the", "in", "'s", "'", "'re", "'ll", "''", "'ve", "'d", " ", "  ", "\n", "\t", "é", "ñ", "1", "²", "23",
         "!", "--", "梦", "日", "\U0001F600", "́", "\x00", "\xa0", "　", "\x85", "<|endoftext|>", "<|endof", "aaaa", "It's", "\r\n"]


def test_ids_and_texts_are_the_librarys(library, coder):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(SIGNS) for _ in range(rnd.randint(0, 40))) for _ in range(4000)]
    texts += ["", "a" * 5000, " " * 5000, "é" * 3000, "ab" * 2000, "<|endoftext|>" * 3, " <|endoftext|> x", "x'"]
    want = ids_of(library, texts)
    for _ in range(2):  # the second time from the worker's memory
        ids, n = coder.encode(texts)
        assert split(ids, n) == want
    assert coder.decode(ids, n) == library.decode_batch(want, skip_special_tokens=False) == texts
    assert coder.encode([])[0].tolist() == [] and coder.encode(["", ""])[1].tolist() == [0, 0]


def test_every_character_is_split_like_the_library(library, coder):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 7 == 0)]
    texts = [f"a{chr(c)}1{chr(c)}# {chr(c)}" for c in points]
    assert split(*coder.encode(texts)) == ids_of(library, texts)


def test_any_ids_decode_like_the_library(library, coder):
    rnd = random.Random(3)
    runs = [[rnd.randrange(50_257 if rnd.random() < 0.5 else 256) for _ in range(rnd.randint(0, 8))] for _ in range(1500)]
    flat, n = np.array([i for r in runs for i in r]), np.array([len(r) for r in runs])
    assert coder.decode(flat, n) == [library.decode(r, skip_special_tokens=False) for r in runs]


@pytest.mark.parametrize("seed", range(6))
def test_merges_of_any_order(tmp_path, seed):
    """Merge lists where a merge makes a pair of a lower rank: word by word, lowest rank first."""
    rnd = random.Random(seed)
    signs = {b: c for c, b in op11_bpe.byte_signs().items()}
    vocab = {signs[b]: b for b in range(256)}
    merges, parts = [], ["a", "b", "c", "ab", "abc", "bc", "ca", "aa"]
    for p in parts + [x + y for x in parts for y in parts]:
        vocab.setdefault(p, len(vocab))
    while len(merges) < 30:
        a, b = rnd.choice(parts), rnd.choice(parts)
        if [a, b] not in merges:
            vocab.setdefault(a + b, len(vocab))
            merges.append([a, b])
    spec = json.load(open(PATH, encoding="utf-8"))
    spec["model"]["vocab"], spec["model"]["merges"], spec["added_tokens"] = vocab, merges, []
    file = tmp_path / "t.json"
    file.write_text(json.dumps(spec))
    library, coder = Tokenizer.from_file(str(file)), op11_bpe.Coder(op11_bpe.read_model(str(file)))
    assert not coder.ascending
    texts = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 30))) for _ in range(500)]
    assert split(*coder.encode(texts)) == ids_of(library, texts)


def test_other_kinds_of_files_are_refused(tmp_path):
    spec = json.load(open(PATH, encoding="utf-8"))
    spec["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        op11_bpe.read_model(str(tmp_path / "t.json"))


def test_awkward_rows(make_docs, awkward, library):
    got = op11_bpe.encode(make_docs(awkward), PATH, decoded=True).collect()
    want = sorted((str(i), ids_of(library, [t or ""])[0]) for i, t, _ in awkward)
    assert sorted((str(r.row.doc_id), r.out.ids) for r in got) == want
    for r in got:
        assert r.out.decoded == (r.row.text or "")
        assert (r.out.ends or [0])[-1] == len((r.row.text or "").encode())
        assert r.out.ends == sorted(r.out.ends)
    assert op11_bpe.encode(make_docs([]), PATH).count() == 0


def test_decode_operator(spark, library):
    rows = spark.createDataFrame([(1, ids_of(library, ["a b  c"])[0]), (2, []), (3, None), (4, [3, None, 50256, 60000])],
                                 "k int, ids array<int>")
    got = {r.row.k: r.out.text for r in op11_bpe.decode(rows, PATH).collect()}
    assert got == {1: "a b  c", 2: "", 3: "", 4: library.decode([3, 50256], skip_special_tokens=False)}


def test_query_over_a_table(spark, library):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in op11_bpe.op11_bpe_pair_index(spark, sf).collect():
        text = docs.pop(r.doc_id)
        ids = ids_of(library, [text])[0]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.n_covered) == (
            len(ids), sha(",".join(map(str, ids))), sha(text), len(text.encode()))
    assert not docs
