"""Operator 1: language-model scores by stupid backoff.

N-gram counts are tables partitioned by hash. The documents are cut into slices; a slice
asks every hash partition for the counts of its distinct n-grams (sorted hashes, packed),
the partition sums all requests for a hash and answers each, and the answers are joined to
the slice, whose n-grams are scored and summed per document. Packing keeps one shuffled
n-gram near six bytes; a frequent n-gram is one entry of each slice.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contactlake.llm.common import col, pieces, small_batches, table
from contactlake.llm.words import ALNUM, Words

#: longest n-gram, and the factor of each step back to a shorter one
ORDER, ALPHA = 3, 0.4
#: text bytes of a slice (or one text)
SLICE_BYTES = 9 << 20
#: words of the corpus for each hash partition of the n-grams of one length: what one call sums
PART_WORDS = 1 << 20

SCORE = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("log_score", T.DoubleType())])


def pack(values: np.ndarray) -> bytes:
    """Ascending 64-bit values as differences, byte by byte, compressed."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_counts(values: np.ndarray) -> bytes:
    """Counts in the fewest bytes that hold the largest, compressed."""
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64)
                if not len(values) or values.max() <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + zstandard.ZstdCompressor(level=1).compress(values.astype(kind).tobytes())


def unpack_counts(data: bytes) -> np.ndarray:
    kind = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}[data[0]]
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), kind).astype(np.int64)


def distinct_grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes, their counts, the first word of every n-gram, and its
    index in the distinct ones."""
    h, whole = words.grams(n)
    at = np.flatnonzero(whole)
    values, index, counts = np.unique(h[at], return_inverse=True, return_counts=True)
    return values, counts, at, index


def own_counts(doc: np.ndarray, index: np.ndarray, distinct: int) -> np.ndarray:
    """For each n-gram, how often its document holds it."""
    _, at, counts = np.unique(doc.astype(np.int64) * max(1, distinct) + index, return_inverse=True, return_counts=True)
    return counts[at]


def slice_scores(words: Words, elsewhere: list[np.ndarray] | None, total: int, order: int, alpha: float,
                 leave_out: bool) -> np.ndarray:
    """The summed log score of each text of a slice.

    ``elsewhere`` has, per order, the counts outside the slice of its distinct n-grams. With
    ``leave_out`` a document's own n-grams do not count for it."""
    docs = len(words.first) - 1
    n_words = len(words.hash)
    own_words = np.diff(words.first)
    seen = []  # per order: the count of the n-gram that begins at each word, -1 if none does
    for n in range(1, order + 1):
        values, counts, at, index = distinct_grams(words, n)
        c = counts + (elsewhere[n - 1] if elsewhere else 0)
        c = c[index] - (own_counts(words.doc[at], index, len(values)) if leave_out else 0)
        full = np.full(n_words, -1, np.int64)
        full[at] = c
        seen.append(full)
    corpus = np.maximum(total - own_words * leave_out, 1).astype(np.float64)[words.doc]
    score = np.log(np.maximum(seen[0], alpha)) - np.log(corpus)
    for n in range(2, order + 1):  # from short to long: a longer n-gram that was seen decides
        last = np.arange(n_words)[n - 1:]
        first = last - (n - 1)
        here = seen[n - 1][first]
        last, first, here = last[here >= 0], first[here >= 0], here[here >= 0]
        context = seen[n - 2][first]
        longer = here > 0
        score[last] += np.log(alpha)
        score[last[longer]] = np.log(here[longer]) - np.log(context[longer])
    return np.bincount(words.doc, weights=score, minlength=docs) if n_words else np.zeros(docs)


def _slices(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``(slice, rows, sizes, texts)``: about ``SLICE_BYTES`` of text each, compressed."""
    slim = docs.select(F.struct(*[col(c) for c in keep]).alias("row"), col(text).cast("string").alias("text"))
    schema = T.StructType([
        T.StructField("slice", T.LongType()), T.StructField("rows", T.ArrayType(slim.schema["row"].dataType)),
        T.StructField("sizes", T.ArrayType(T.IntegerType())), T.StructField("texts", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []

        def packed() -> pa.RecordBatch:
            nonlocal number
            rows = pa.concat_arrays([b.column(0) for b in held])
            raw = [(t or "").encode() for b in held for t in b.column(1).to_pylist()]
            held.clear()
            number += 1
            whole = pa.array([0, len(raw)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.ListArray.from_arrays(whole, rows),
                 pa.array([[len(r) for r in raw]], pa.list_(pa.int32())),
                 pa.array([zstandard.ZstdCompressor(level=3).compress(b"".join(raw))], pa.binary())],
                ["slice", "rows", "sizes", "texts"])

        size = 0
        for batch in batches:
            for part in pieces(batch, 1, SLICE_BYTES // 4):
                more = sum(len(t or "") for t in part.column(1).to_pylist())
                if held and size + more > SLICE_BYTES:
                    yield packed()
                    size = 0
                held.append(part)
                size += more
        if held:
            yield packed()

    return slim.mapInArrow(run, schema)


def _texts(sizes: list[int], data: bytes) -> list[str]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    ends = np.cumsum(sizes).tolist() if sizes else []
    return [raw[b - n:b].decode() for n, b in zip(sizes, ends)]


_REQUEST = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("part", T.IntegerType()),
                         T.StructField("slice", T.LongType()), T.StructField("hashes", T.BinaryType()),
                         T.StructField("counts", T.BinaryType())])
_ANSWER = T.StructType([T.StructField("slice", T.LongType()), T.StructField("n", T.IntegerType()),
                        T.StructField("part", T.IntegerType()), T.StructField("size", T.IntegerType()),
                        T.StructField("elsewhere", T.BinaryType())])


def _requests(slices: DataFrame, order: int, parts: int) -> DataFrame:
    """The distinct n-grams of each slice, by hash partition (ranges of the hash)."""
    shift = np.uint64(64 - (parts.bit_length() - 1))

    def run(batches):
        for batch in batches:
            for number, sizes, data in zip(*(batch.column(c).to_pylist() for c in ("slice", "sizes", "texts"))):
                words = Words(_texts(sizes, data))
                for n in range(1, order + 1):
                    values, counts, _, _ = distinct_grams(words, n)
                    of = (values >> shift).astype(np.int64) if parts > 1 else np.zeros(len(values), np.int64)
                    cut = np.searchsorted(of, np.arange(parts + 1))
                    rows = [(n, p, number, pack(values[a:b]), pack_counts(counts[a:b]))
                            for p, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                            _REQUEST.names)

    # all columns are taken, so that this and the join read one and the same exchange
    return slices.mapInArrow(run, _REQUEST)


def _answer(request: pa.Table) -> pa.Table:
    """Sum the requests of one hash partition, and tell each slice the counts elsewhere."""
    hashes = [unpack(b) for b in request.column("hashes").to_pylist()]
    counts = [unpack_counts(b) for b in request.column("counts").to_pylist()]
    _, index = np.unique(np.concatenate(hashes), return_inverse=True)
    own = np.concatenate(counts)
    total = np.bincount(index, weights=own).astype(np.int64)
    rest = np.split(total[index] - own, np.cumsum([len(h) for h in hashes])[:-1])
    return pa.table([request.column("slice"), request.column("n"), request.column("part"),
                     pa.array([len(h) for h in hashes], pa.int32()),
                     pa.array([pack_counts(r) for r in rest], pa.binary())], names=_ANSWER.names)


def count_words(docs: DataFrame, text: str = "text") -> int:
    """Words of all texts."""
    def run(batches):
        n = 0
        for batch in batches:
            for part in pieces(batch, 0):
                raw = b"\0" + b"\0".join((t or "").encode() for t in part.column(0).to_pylist())
                word = ALNUM[np.frombuffer(raw, np.uint8)] != 0
                n += int(np.count_nonzero(word[1:] & ~word[:-1]))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    counted = docs.select(col(text).cast("string").alias("text")).mapInArrow(run, "n long")
    return counted.agg(F.sum("n")).first()[0] or 0


def backoff_scores(docs: DataFrame, text: str = "text", keep=None, order: int = ORDER, alpha: float = ALPHA,
                   leave_out: bool = True, parts: int | None = None) -> DataFrame:
    """``(row, out)``: ``out.n_words`` and ``out.log_score``, the sum over the words of the
    natural log of their stupid-backoff scores, counts being those of all of ``docs``.

    Words are runs of letters a-z (A-Z lower-cased), digits and characters beyond ASCII; an
    n-gram does not leave its document, and a word with a short history starts at a shorter
    n-gram. A word seen nowhere counts as ``alpha`` times seen. With ``leave_out`` the counts
    a document is scored with do not include its own (repeated rows are documents each, and
    count for each other). A null or empty text has no words and score zero. ``parts``
    (rounded to a power of two) divide the count tables; by default they grow with the words of
    the corpus, so that a partition stays at about ``PART_WORDS`` n-grams. A slice asks at most
    as many of them as it has n-grams.
    """
    spark = docs.sparkSession
    small_batches(spark, 5000)
    keep = docs.columns if keep is None else list(keep)
    total = count_words(docs, text)
    parts = 1 << max(0, (parts or -(-total // PART_WORDS)) - 1).bit_length()
    slices = _slices(docs, text, keep).repartition("slice")
    answers = _requests(slices, order, parts).groupBy("n", "part").applyInArrow(_answer, _ANSWER) \
        .groupBy("slice").agg(F.sort_array(F.collect_list(F.struct("n", "part", "size", "elsewhere"))).alias("answers"))
    joined = slices.join(answers, "slice", "left").select("rows", "sizes", "texts", "answers")
    schema = T.StructType([T.StructField("row", slices.schema["rows"].dataType.elementType), T.StructField("out", SCORE)])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                sizes, data, answers = (one.column(c)[0].as_py() for c in ("sizes", "texts", "answers"))
                words = Words(_texts(sizes, data))
                elsewhere = []
                for n in range(1, order + 1):
                    mine = [a for a in answers or () if a["n"] == n]
                    elsewhere.append(np.concatenate([unpack_counts(a["elsewhere"]) for a in mine] or [np.zeros(0, np.int64)]))
                score = slice_scores(words, elsewhere, total, order, alpha, leave_out)
                out = pa.StructArray.from_arrays([pa.array(np.diff(words.first), pa.int64()), pa.array(score)],
                                                 ["n_words", "log_score"])
                yield pa.RecordBatch.from_arrays([one.column("rows").flatten(), out], ["row", "out"])

    return joined.mapInArrow(run, schema)


def op1_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents from the n-gram counts of all other documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = backoff_scores(docs, keep=["doc_id"])
    n, s = F.col("out.n_words"), F.col("out.log_score")
    return got.select(F.col("row.doc_id").alias("doc_id"), n.alias("n_words"), F.round(s, 4).alias("log_score"),
                      F.round(F.try_divide(s, n), 6).alias("mean_log_score"))


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
p AS (SELECT r, len(w) AS own, w[i] AS c, CASE WHEN i > 1 THEN w[i - 1] END AS b, CASE WHEN i > 2 THEN w[i - 2] END AS a
  FROM d, unnest(range(1, len(w) + 1)) t(i)),
o1 AS (SELECT r, c, count(*) AS n FROM p GROUP BY r, c),
g1 AS (SELECT c, sum(n) AS n FROM o1 GROUP BY c),
o2 AS (SELECT r, b, c, count(*) AS n FROM p WHERE b IS NOT NULL GROUP BY r, b, c),
g2 AS (SELECT b, c, sum(n) AS n FROM o2 GROUP BY b, c),
o3 AS (SELECT r, a, b, c, count(*) AS n FROM p WHERE a IS NOT NULL GROUP BY r, a, b, c),
g3 AS (SELECT a, b, c, sum(n) AS n FROM o3 GROUP BY a, b, c),
s AS (SELECT o3.r, o3.a, o3.b, o3.c, g3.n - o3.n AS n3 FROM o3 JOIN g3 USING (a, b, c)),
q AS (SELECT o2.r, o2.b, o2.c, g2.n - o2.n AS n2 FROM o2 JOIN g2 USING (b, c)),
u AS (SELECT o1.r, o1.c, g1.n - o1.n AS n1 FROM o1 JOIN g1 USING (c)),
x AS (SELECT p.r, p.a, p.b, (SELECT count(*) FROM p) - own AS corpus, u.n1, v.n1 AS b1, q.n2, y.n2 AS ab2, s.n3
  FROM p JOIN u ON p.r = u.r AND p.c = u.c LEFT JOIN u v ON p.r = v.r AND p.b = v.c
  LEFT JOIN q ON p.r = q.r AND p.b = q.b AND p.c = q.c LEFT JOIN q y ON p.r = y.r AND p.a = y.b AND p.b = y.c
  LEFT JOIN s ON p.r = s.r AND p.a = s.a AND p.b = s.b AND p.c = s.c),
z AS (SELECT r, CASE WHEN n3 > 0 THEN ln(n3 / ab2)
    ELSE CASE WHEN a IS NOT NULL THEN ln({ALPHA}) ELSE 0 END + CASE WHEN n2 > 0 THEN ln(n2 / b1)
    ELSE CASE WHEN b IS NOT NULL THEN ln({ALPHA}) ELSE 0 END + ln(greatest(n1, {ALPHA}) / greatest(corpus, 1)) END END AS score
  FROM x),
t AS (SELECT r, sum(score) AS score FROM z GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, round(coalesce(score, 0), 4) AS log_score,
  round(score / len(w), 6) AS mean_log_score
FROM d LEFT JOIN t USING (r)
"""
