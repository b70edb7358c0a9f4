"""Operator 10: sharding by a consistent-hash ring with virtual nodes and bounded loads.

Each shard has virtual nodes on a ring; a row goes to the shard of the first node clockwise
from its key's hash. A shard has a fixed capacity: rows that overflow it continue clockwise
to the first node of a shard that has room. With capacities that sum to the rows, the loads
are at most one apart, whatever the keys.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contactlake.llm.common import col, small_batches, staged, table

#: virtual nodes of a shard; parts of each arc, so that rows of one key spread over tasks, and
#: of equal rows, so that they do
NODES, PARTS, SALTS = 64, 128, 64
SHARDS = 8


def ring(shards: int, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the virtual nodes in ring order, and the shard of each."""
    at = sorted((xxhash.xxh64_intdigest(f"{s}/{v}", 0), s) for s in range(shards) for v in range(nodes))
    return np.array([a for a, _ in at], np.uint64), np.array([s for _, s in at])


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Rows that each shard may hold: with no slack exactly the rows, at most one apart."""
    if slack > 0:
        return [-(-int(rows * (1 + slack)) // shards) + 1] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def placed(counts: list[int], owner: list[int], room: list[int]) -> list[list[tuple[int, int, int, int]]]:
    """For each arc (rows between two nodes) its runs of ranks: first, end, shard, and the
    slot of the first in its shard.

    A shard takes the rows of its own arcs first, in ring order; what overflows goes on
    clockwise in ring order. Work on the ring's arcs, whatever the number of rows."""
    room, used = list(room), [0] * len(room)
    runs: list[list[tuple[int, int, int, int]]] = [[] for _ in counts]

    def take(arc: int, at: int, shard: int) -> int:
        n = min(counts[arc] - at, room[shard])
        if n:
            runs[arc].append((at, at + n, shard, used[shard]))
            room[shard] -= n
            used[shard] += n
        return at + n

    at = [take(arc, 0, owner[arc]) for arc in range(len(counts))]
    for arc, n in enumerate(counts):
        k = arc
        while at[arc] < n:
            k = (k + 1) % len(counts)
            at[arc] = take(arc, at[arc], owner[k])
    return runs


def _hashed(docs: DataFrame, columns: list[str]) -> list:
    """The columns that can be hashed."""
    return [col(f.name) for f in docs.schema if f.name in columns
            and not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]


def assign(docs: DataFrame, ident: str = "doc_id", keep=None, shards: int = SHARDS, nodes: int = NODES,
           parts: int = PARTS, slack: float = 0.0) -> DataFrame:
    """``(row, shard, slot)``: slots are gapless from 0 in each shard.

    The key is the id; a null id is a key like any other, and rows of one key (or many, on
    one arc) are ranked in ``parts`` parts, so no task holds a hot key. Which of such rows
    overflow goes by a hash of id and kept columns: the same table gives the same shards in
    whatever files and splits it comes. Only rows that are equal in all of these are told
    apart by their position, and dealt over tasks by it. The driver handles one count per part
    of an arc (``shards * nodes * parts`` numbers), never rows. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark, 10_000)
    columns = docs.columns if keep is None else list(keep)
    rows = docs.select(F.struct(*[col(c) for c in columns]).alias("row"), F.xxhash64(col(ident)).alias("key"),
                       F.xxhash64(col(ident), *_hashed(docs, columns)).alias("same"),
                       F.monotonically_increasing_id().alias("at"))
    points, owner = ring(shards, nodes)

    def arcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = b.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
            arc = np.searchsorted(points, key) % len(points)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(arc, pa.int32())], [*b.schema.names, "arc"])

    known = rows.mapInArrow(arcs, T.StructType([*rows.schema.fields, T.StructField("arc", T.IntegerType())]))
    known = known.withColumn("part", F.pmod(F.xxhash64("same"), F.lit(parts)).cast("int")) \
        .withColumn("salt", F.pmod("at", F.lit(SALTS)).cast("int"))
    known = staged(known, "ring")

    sizes = {(r["arc"], r["part"]): r["n"] for r in known.groupBy("arc", "part").agg(F.count("*").alias("n")).collect()}
    counts = [sum(sizes.get((a, p), 0) for p in range(parts)) for a in range(len(points))]
    runs = placed(counts, owner.tolist(), capacities(sum(counts), shards, slack))
    plan = []
    for a, arc_runs in enumerate(runs):
        first = 0
        for p in range(parts):
            n = sizes.get((a, p), 0)
            if n:
                plan.append((a, p, first, [r for r in arc_runs if r[0] < first + n and r[1] > first]))
            first += n
    plan = spark.createDataFrame(plan, "arc int, part int, first long, "
                                       "runs array<struct<start:long,end:long,shard:int,slot:long>>")
    alike = ["arc", "part", "same", "salt"]
    ahead = Window.partitionBy("arc", "part").orderBy("same", "salt")
    before = known.groupBy(*alike).agg(F.count("*").alias("n")) \
        .select(*alike, (F.sum("n").over(ahead) - F.col("n")).alias("before"))
    ranked = known.withColumn("nth", F.row_number().over(Window.partitionBy(*alike).orderBy("at")) - 1) \
        .join(before, alike).join(plan, ["arc", "part"])
    rank = F.col("first") + F.col("before") + F.col("nth")
    run = F.filter("runs", lambda r: (r["start"] <= rank) & (rank < r["end"]))[0]
    return ranked.select("row", run["shard"].alias("shard"), (run["slot"] + rank - run["start"]).alias("slot"))


def op10_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards; the ring's capacities make row counts at most one apart."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                         F.crc32(text.cast("binary")).alias("text_crc32"))
    return assign(narrow).select("row.doc_id", "row.size", "row.text_crc32", F.lit("rows").alias("law"),
                                 "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
