import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece as spm
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto
from sentencepiece import sentencepiece_pb2

from contactlake.llm import op4_pieces, op5_counts, piece_batch
from contactlake.llm.piece_model import CharsMap, PieceModel

PATH = public_tokenizers.path(op4_pieces.MODEL)


@pytest.fixture(scope="module")
def library():
    return spm.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(7)
    signs = "ab the in é ñ ▁  \n\t<>s/0x41 梦日 \U0001F600́\x00 ll"
    out = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 60))) for _ in range(600)]
    out += ["".join(rnd.choice("aeinrstlo") for _ in range(rnd.randint(60, 200))) for _ in range(10)]
    return out + ["", " ", "   ", " " * 100, "▁", "▁▁ a", "<s> hi </s> <0x41> <unk>", "a" * 3000, " " * 3000 + "x"]


def split(flat, n):
    return [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])]


def test_ids_spans_and_texts_are_the_librarys(library, texts):
    coder = piece_batch.Encoder(open(PATH, "rb").read())
    ids, begin, end, n = coder.encode(texts)
    want = library.encode(texts)
    assert split(ids, n) == want
    assert coder.decode(ids, n).to_pylist() == library.decode(want)
    for t, b, e in zip(texts, split(begin, n), split(end, n)):
        pieces = sentencepiece_pb2.SentencePieceText.FromString(library.encode(t, out_type="serialized_proto")).pieces
        assert [(p.begin, p.end) for p in pieces] == list(zip(b, e)), t
    assert [[r[0] for r in coder.model.encode(t)] for t in texts[:300]] == want[:300]


def test_any_ids_decode_like_the_library(library):
    model, rnd = PieceModel(open(PATH, "rb").read()), random.Random(3)
    for _ in range(1500):
        ids = [rnd.randrange(32_000 if rnd.random() < 0.5 else 300) for _ in range(rnd.randint(0, 8))]
        assert model.decode(ids) == library.decode(ids), ids


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_normaliser_walks_the_compiled_map(rule):
    lib = spm.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True,
                                      remove_extra_whitespaces=True)
    model = PieceModel.__new__(PieceModel)
    spec = proto.ModelProto.FromString(lib.serialized_model_proto()).normalizer_spec
    model.dummy, model.squeeze, model.chars = spec.add_dummy_prefix, spec.remove_extra_whitespaces, CharsMap(spec.precompiled_charsmap)
    rnd = random.Random(1)
    for _ in range(1000):
        t = "".join(rnd.choice("abC  é ñ\n\tｱｲ①㍿ﬁ Å가각é梦\x00​") for _ in range(rnd.randint(0, 30)))
        norm, source = model.normalise(t)
        assert norm == lib.normalize(t), t
        assert len(source) == len(norm) + 1 and source == sorted(source) and source[-1] <= len(t.encode())


def test_every_prefix_count_is_the_librarys(library, texts):
    values, n = piece_batch.Prefixes(open(PATH, "rb").read()).counts(texts)
    rnd = random.Random(2)
    for t, got in zip(texts, split(values, n)):
        assert len(got) == len(t)
        for k in range(len(t)) if len(t) < 70 else rnd.sample(range(len(t)), 20):
            assert got[k] == len(library.encode(t[:k + 1])), t[:k + 1]


def test_encode_awkward_rows(make_docs, awkward, library):
    got = op4_pieces.encode(make_docs(awkward), PATH, decoded=True).collect()
    assert len(got) == len(awkward)
    want = sorted((str(i), library.encode(t or "")) for i, t, _ in awkward)
    assert sorted((str(r.row.doc_id), r.out.ids) for r in got) == want
    assert all(r.out.decoded == library.decode(library.encode(r.row.text or "")) for r in got)
    assert op4_pieces.encode(make_docs([]), PATH).count() == 0


def test_decode_operator(spark, library):
    rows = spark.createDataFrame([(1, library.encode("a b  c")), (2, []), (3, None), (4, [3, None, 300])], "k int, ids array<int>")
    got = {r.row.k: r.out.text for r in op4_pieces.decode(rows, PATH).collect()}
    assert got == {1: "a b  c", 2: "", 3: "", 4: library.decode([3, 300])}


def test_counts_answer_truncation_and_budget(make_docs, awkward, library):
    counts = F.col("out.counts")
    got = op5_counts.prefix_counts(make_docs(awkward), PATH).select(
        "row.text", op5_counts.count_at(counts, 5).alias("at5"), op5_counts.count_at(counts, F.size(counts)).alias("all"),
        op5_counts.longest_within(counts, 3).alias("within")).collect()
    assert len(got) == len(awkward)
    for r in got:
        t = r.text or ""
        assert r.at5 == len(library.encode(t[:5])) and r["all"] == len(library.encode(t))
        if len(t) < 500:
            assert r.within == max(k for k in range(len(t) + 1) if len(library.encode(t[:k])) <= 3)


def test_queries_over_a_table(spark, library):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    counts = {r.doc_id: r for r in op5_counts.op5_token_counts(spark, sf).collect()}
    for r in op4_pieces.op4_sentencepiece(spark, sf).collect():
        ids = library.encode(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
        assert r.n_covered == len(docs[r.doc_id].encode())
        c = counts.pop(r.doc_id)
        assert (c.n_tokens, c.n_bytes, c.over_limit) == (len(ids), len(docs[r.doc_id].encode()), len(ids) > 4096)
    assert not counts
