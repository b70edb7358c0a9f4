"""Operator 8: SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position gets a vector of ``radius + 1`` bits; table v keeps the bits whose vector
has an odd inner product with v. The vectors of any ``radius`` differing bits are orthogonal
to some v, so two fingerprints within the radius agree on all the bits that this table
keeps: every such pair collides in some table. Fingerprints are compared, not documents, so
copies cost nothing, and what leaves a bucket is a forest of links, not its pairs.
"""
from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contactlake.llm.common import col, map_text, staged, table

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SHINGLE, RADIUS, SEED = 3, 3, 42
#: fingerprints of a bucket that one call compares; larger buckets are divided by further
#: tables over the bits that the first ones leave free
BUCKET = 2000
#: shingles whose bits are counted at once
BLOCK = 1 << 16
_ROW = "__llm_row_number"

FINGERPRINT = T.StructType([T.StructField("fingerprint", T.LongType())])


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the shingle hashes; unsigned."""
    words = WORD.findall(text.encode().lower())  # bytes: only A-Z change
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    n = min(shingle, len(words))
    start, end = (end - size)[:len(words) - n + 1].tolist(), end[n - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for k in range(0, len(start), BLOCK):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(start[k:k + BLOCK], end[k:k + BLOCK])], ">u8")
        ones += np.unpackbits(h.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(start))
    return int.from_bytes(bits.tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", keep=None, shingle: int = SHINGLE) -> DataFrame:
    """``(row, out)`` with ``out.fingerprint`` as a signed long; zero without words."""
    def fn(texts: list[str]) -> pa.Array:
        values = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
        return pa.StructArray.from_arrays([pa.array(values)], ["fingerprint"])

    return map_text(docs, fn, FINGERPRINT, text, keep)


def masks(bits: list[int], radius: int) -> list[int]:
    """Bit masks of the tables over the given bit positions. Positions take the nonzero
    vectors of ``radius + 1`` bits in turn, the unit vectors first: so every table keeps
    about half of the bits, and one at least."""
    count = 2 ** (radius + 1)
    vectors = sorted(range(1, count), key=lambda x: (x.bit_count(), x))
    given = {b: vectors[i % len(vectors)] for i, b in enumerate(bits)}
    return [sum(1 << b for b, x in given.items() if (x & v).bit_count() % 2) for v in range(1, count)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join what is connected within the radius; at most one fewer than values."""
    root = np.arange(len(values))
    bits = values.view(np.uint64)
    links = []
    for i in range(len(values) - 1):
        near = i + 1 + np.flatnonzero(np.bitwise_count(bits[i + 1:] ^ bits[i]) <= radius)
        for r in np.unique(root[near]).tolist():
            if r != root[i]:
                links.append((int(values[i]), int(values[near[root[near] == r][0]])))
                root[root == r] = root[i]
    return links


_LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _bucket_links(buckets: DataFrame, radius: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            links = [x for v in batch.column(0) for x in _forest(np.array(v.as_py(), np.int64), radius)]
            a, b = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return buckets.select("fps").mapInArrow(run, _LINKS)


def links(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``(a, b)`` links between the distinct fingerprints ``prints(fp)`` within the radius;
    what they connect is all that is connected.

    Buckets up to ``bucket`` fingerprints are compared in one call. A larger one is divided
    by the tables over the bits it leaves free; this halves these bits each time, and a
    bucket that leaves ``radius`` or fewer bits free is all within the radius: a star. So
    no pair is lost and no bucket is gathered beyond the bound.
    """
    spark = prints.sparkSession
    every = (1 << 64) - 1
    found = []
    frees, rows = [every], prints.select("fp")
    while frees:
        tables = [(signed(f), signed(f & ~m)) for f in frees for m in masks([b for b in range(64) if f >> b & 1], radius)]
        if len(frees) == 1:
            each = rows.select("fp", F.explode(F.array(*[F.lit(left) for _, left in tables])).alias("left"))
        else:  # at most 15 rows for each of the masks in reach, which do not depend on the data
            small = F.broadcast(spark.createDataFrame(tables, "free long, left long"))
            each = rows.join(small, "free").select("fp", "left").distinct()  # two ways to one bucket
        keyed = each.select("fp", "left", F.col("fp").bitwiseAND(F.bitwise_not("left")).alias("key"))
        sizes = keyed.groupBy("left", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a")).filter("n > 1")
        shared = staged(keyed.join(sizes, ["left", "key"]), "buckets")
        small = shared.filter(F.col("n") <= bucket).groupBy("left", "key").agg(F.collect_list("fp").alias("fps"))
        found.append(_bucket_links(small, radius))
        large = shared.filter(F.col("n") > bucket)
        found.append(large.filter((F.bit_count("left") <= radius) & (F.col("fp") != F.col("a")))
                     .select("a", F.col("fp").alias("b")))
        large = large.filter(F.bit_count("left") > radius)
        frees = [r["left"] & every for r in large.select("left").distinct().collect()]
        rows = large.select("fp", F.col("left").alias("free")).distinct()
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def connected(edges: DataFrame) -> DataFrame:
    """``(node, root)``: for each node of the links ``(a, b)``, the least node it reaches.

    Alternating large-star and small-star steps; each is a grouped minimum (partial sums per
    task) and a join, and each round is written to the shared folder. The driver sees only
    whether the links still change.
    """
    edges = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .distinct(), "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")) \
            .select("e.u", "e.v").filter("u <> v").distinct()
        edges = staged(small, "links")
        new = _state(edges)
        if new == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        state = new


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def near_duplicates(docs: DataFrame, ident: str = "doc_id", text: str = "text", keep=None,
                    shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``(row, fingerprint, root, component_id)``: ``fingerprint`` as a signed long, ``root``
    the least fingerprint that its links reach, ``component_id`` the least id in reach.

    A null text counts as empty: fingerprint zero, linked like any other. Null ids are in
    their group but never its least id, unless the group has no other. Repeated rows share a
    fingerprint. All later steps work on distinct fingerprints.
    """
    read = _read(docs, ident, text, keep, shingle)
    return read.join(_groups(read, radius, bucket), "fingerprint").select("row", "fingerprint", "root", "component_id")


def _read(docs: DataFrame, ident: str, text: str, keep, shingle: int) -> DataFrame:
    """``(row, ident, fingerprint)``, written once."""
    named = docs.select(F.struct(*[col(c) for c in (docs.columns if keep is None else keep)]).alias("row"),
                        col(ident).alias("ident"), col(text).alias("text"))
    return staged(fingerprints(named, "text", ["row", "ident"], shingle)
                  .select("row.row", "row.ident", "out.fingerprint"), "fingerprints")


def _groups(read: DataFrame, radius: int, bucket: int) -> DataFrame:
    """``(fingerprint, root, component_id)`` of the distinct fingerprints."""
    once = staged(read.groupBy("fingerprint").agg(F.min("ident").alias("least")), "prints")
    joined = connected(links(once.select(F.col("fingerprint").alias("fp")), radius, bucket))
    rooted = once.join(joined.withColumnRenamed("node", "fingerprint"), "fingerprint", "left") \
        .select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return staged(rooted.join(least, "root").select("fingerprint", "root", "component_id"), "components")


def one_of_each(docs: DataFrame, ident: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """The rows of ``docs``, one of each group: that of the least id (nulls last), the least
    text hash among equal ids. Rows are chosen by their numbers in a written table, so whole
    rows are shuffled once, when the chosen ones are taken."""
    read = _read(docs.withColumns({_ROW: F.monotonically_increasing_id()}), ident, text, None, shingle)
    narrow = read.select("fingerprint", F.struct(
        F.col("ident").isNull().alias("late"), F.col("ident").alias("id"),
        F.xxhash64(F.col("row").getField(text)).alias("hash"), F.col("row").getField(_ROW).alias("at")).alias("rank"))
    chosen = narrow.join(_groups(read, radius, bucket), "fingerprint").groupBy("root").agg(F.min("rank").alias("rank"))
    return read.join(chosen.select("rank.at"), F.col("row").getField(_ROW) == F.col("at"), "left_semi") \
        .select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, keep=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id")
