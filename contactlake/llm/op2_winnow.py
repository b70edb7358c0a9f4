"""Operator 2: benchmark decontamination by winnowing.

The hashes of all k-grams of an item are thinned to the minimum of every sliding window, in
documents likewise; equal fingerprints are joined and every hit is extended word by word in
both directions. Two texts that share a span of ``k + window - 1`` words choose the same
k-gram in it, so no such span is missed.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contactlake.llm.common import PIECE_BYTES, col, hex_sha256, pieces, small_batches, staged, table
from contactlake.llm.words import Words

#: words of a k-gram; k-grams of a winnowing window; the shortest span that must be found
GRAM, WINDOW = 5, 6
SPAN = GRAM + WINDOW - 1
#: text bytes of the items that are sent to the tasks at once; more items take more passes
BLOCK_BYTES = 4 << 20
#: passes that follow each other in one job
PASSES = 4


def winnowed(words: Words, gram: int, window: int) -> np.ndarray:
    """First words of the chosen k-grams: of every window of k-grams in one text the least
    hash, the last one of equals."""
    h, whole = words.grams(gram)
    n = len(h) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least, at = h[:n].copy(), np.arange(n)
    inside = whole[:n].copy()
    for j in range(1, window):
        better = h[j:j + n] <= least
        least[better] = h[j:j + n][better]
        at[better] = np.flatnonzero(better) + j
        inside &= whole[j:j + n]
    inside &= words.doc[:n] == words.doc[window - 1:window - 1 + n]
    return np.unique(at[inside])


class Index:
    """Fingerprints of a block of items."""

    def __init__(self, ids: list[str], texts: list[str], gram: int = GRAM, window: int = WINDOW):
        self.gram, self.window, self.span = gram, window, gram + window - 1
        words = Words(texts)
        first = words.first.tolist()
        lengths = np.diff(words.first)
        #: an item with fewer words than a span is one window: all its words, one k-gram
        self.short = sorted({int(n) for n in lengths if 0 < n < self.span})
        self.items = [[words.word(w) for w in range(a, b)] for a, b in zip(first, first[1:])]
        self.ids = ids
        self.tables = {}
        for n in [0, *self.short]:
            at = winnowed(words, gram, window) if n == 0 else words.first[:-1][lengths == n]
            h = words.grams(n or gram)[0][at]
            order = np.argsort(h, kind="stable")
            item = words.doc[at][order]
            self.tables[n] = h[order], item, at[order] - words.first[item]

    def hits(self, words: Words) -> list[tuple[dict[int, int], set[int]]]:
        """For each text: where its hit spans begin and end, and the items with hits."""
        found = [({}, set()) for _ in range(len(words.first) - 1)]
        for n, (known, item, place) in self.tables.items():
            if not len(known):
                continue
            h, whole = words.grams(n or self.gram)
            at = winnowed(words, self.gram, self.window) if n == 0 else np.flatnonzero(whole)
            h = h[at]
            done: dict[tuple[int, int], int] = {}  # by item and shift, the end of the last run
            low = np.searchsorted(known, h)
            same = known[np.minimum(low, len(known) - 1)] == h
            for p, k, value in zip(at[same].tolist(), low[same].tolist(), h[same].tolist()):
                doc = int(words.doc[p])
                spans, items = found[doc]
                while k < len(known) and known[k] == value:
                    same_run = (int(item[k]), p - int(place[k]))
                    if p >= done.get(same_run, 0):
                        done[same_run] = self._extend(words, doc, p, *same_run, n, spans, items)
                    k += 1
        return found

    def _extend(self, words, doc, p, item, shift, n, spans, items) -> int:
        """Grow the match of document word ``p`` and item word ``p - shift`` to its full run;
        its end."""
        text = self.items[item]
        a, b, q = p, p + (n or self.gram), p - shift
        if any(words.word(i) != text[i - shift] for i in range(a, b)):
            return p  # hashes that happen to be equal
        if n == 0:
            first, stop = int(words.first[doc]), int(words.first[doc + 1])
            while a > first and q and words.word(a - 1) == text[q - 1]:
                a, q = a - 1, q - 1
            while b < stop and q + b - a < len(text) and words.word(b) == text[q + b - a]:
                b += 1
        if n or b - a >= self.span:
            at = int(words.first[doc])
            spans[a - at] = max(b - at, spans.get(a - at, 0))
            items.add(item)
        return b


def merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
HITS = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(_SPAN)),
                     T.StructField("items", T.ArrayType(T.StringType()))])
_ARROW = pa.struct([("n_words", pa.int64()),
                    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    ("items", pa.list_(pa.string()))])


def blocks(bench: DataFrame, item: str, text: str, most: int) -> list[DataFrame]:
    """The items in parts of at most ``most`` bytes of text (or one text), by content."""
    rows = bench.select(col(item).cast("string").alias("item"), col(text).cast("string").alias("text")) \
        .filter(F.col("text").isNotNull()).distinct()
    size = F.octet_length("text") + 64
    total = rows.agg(F.sum(size)).first()[0] or 0
    n = max(1, -(-total // most))
    while n > 1:
        part = F.pmod(F.xxhash64("item", "text"), F.lit(n))
        uneven = rows.groupBy(part.alias("part")).agg(F.sum(size).alias("bytes"), F.count("*").alias("rows")) \
            .filter((F.col("bytes") > most) & (F.col("rows") > 1)).limit(1).count()
        if not uneven:
            return [rows.filter(part == i) for i in range(n)]
        n *= 2
    return [rows]


def decontaminate(docs: DataFrame, bench: DataFrame, text: str = "text", keep=None,
                  item: str = "item_id", item_text: str = "text", gram: int = GRAM,
                  window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(row, out)``: ``out.n_words``, ``out.spans`` (disjoint runs of hit words, end
    exclusive) and ``out.items`` (ids, as sorted strings, of the items with a hit).

    A window is ``gram + window - 1`` consecutive words of an item; an item of fewer words,
    but not none, is one window. The items are sent to the tasks in blocks of bounded size,
    and each block is one pass over the documents, so nothing of the documents is shuffled
    and no document or passage gathers rows. Null texts have no words. Equal items are hit
    alike and each listed; a null item id is not listed. Repeated documents each have a row.
    """
    small_batches(docs.sparkSession)
    columns = docs.columns if keep is None else list(keep)
    at = docs.select(F.struct(*[col(c) for c in columns]).alias("row"), col(text).cast("string").alias("text"),
                     F.lit(None).cast(HITS).alias("out"))
    parts = blocks(bench, item, item_text, block_bytes)
    for k, part in enumerate(parts):
        rows = part.collect()  # at most block_bytes of text
        send = docs.sparkSession.sparkContext.broadcast(
            ([r["item"] for r in rows], [r["text"] for r in rows]))
        at = at.mapInArrow(_pass(send, gram, window, last=k == len(parts) - 1), at.schema)
        if k % PASSES == PASSES - 1 and k < len(parts) - 1:
            at = staged(at, "passes")
    return at.select("row", "out")


def _pass(send, gram: int, window: int, last: bool):
    def run(batches):
        index = None
        for batch in batches:
            if index is None:
                index = Index(*send.value, gram, window)
            for part in pieces(batch, 1, PIECE_BYTES):
                words = Words([t or "" for t in part.column(1).to_pylist()])
                out = []
                for (spans, items), n, before in zip(index.hits(words), np.diff(words.first).tolist(),
                                                     part.column(2).to_pylist()):
                    old = before or {"spans": [], "items": []}
                    spans = merged([*spans.items(), *((s["start"], s["end"]) for s in old["spans"])])
                    names = {index.ids[i] for i in items if index.ids[i] is not None}
                    out.append({"n_words": n, "spans": [{"start": a, "end": b} for a, b in spans],
                                "items": sorted(names.union(old["items"]))})
                text = pa.nulls(part.num_rows, pa.string()) if last else part.column(1)
                yield pa.RecordBatch.from_arrays([part.column(0), text, pa.array(out, _ARROW)], ["row", "text", "out"])
    return run


def n_hit(out):
    return F.aggregate(out["spans"], F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of all benchmark items in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = decontaminate(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    out = F.col("out")
    return got.select(F.col("row.doc_id").alias("doc_id"), out["n_words"].alias("n_words"),
                      n_hit(out).alias("n_hit"), F.size(out["items"]).cast("long").alias("n_items"),
                      hex_sha256(F.array_join(out["items"], ",")).alias("items_sha256"),
                      (F.size(out["spans"]) > 0).alias("contaminated"))


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT *, least({SPAN}, len(w)) AS k FROM b WHERE len(w) > 0), unnest(range(1, len(w) - k + 2)) t(i)),
dw AS (SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM d, (SELECT DISTINCT k FROM bw), unnest(range(1, len(w) - k + 2)) t(i)),
hits AS (SELECT r, i, k, item FROM dw JOIN bw USING (k, s)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + k)) t(p) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
