"""Operator 13: phrase mining by relational set-oriented mining (SETM).

The occurrence relation holds, sorted by piece and position, the group of every occurrence.
Each level joins it with itself at the next position, counts the groups, keeps the frequent
ones by a semi-join, and goes on with the occurrences that are left. The occurrences of a
slice of documents are packed, so the join is a merge inside the slice (no piece lies in
two). What is counted and semi-joined across slices are its distinct groups: words in rows,
pairs of groups packed by the part that they hash to.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contactlake.llm.common import col, pieces, small_batches, staged, table
from contactlake.llm.words import mix, run_hashes
from contactlake.session import scratch_path

#: occurrences of a candidate, and words of the longest one
LEAST, LONGEST = 30, 4
#: a candidate goes if a longer one around it has this share (in a hundred) of its occurrences
SHARE, SCALE, TOP = 80, 2_000_000, 2000
UNKNOWN = "und"
#: rows and bytes of the text that make a slice
SLICE_ROWS, SLICE_BYTES = 2500, 4 << 20
#: rows of one Arrow batch; pairs that one part counts, about
GROUP_ROWS, PART_PAIRS = 10_000, 1_000_000
#: words that are compared byte by byte at once
CHECKED = 50_000
#: bits for the slices of a task, for the words of a slice and for the frequent pairs of a part
SLICE_BITS, PLACE_BITS, ID_BITS = 12, 31, 32

# Signs between pieces, and signs between words of a piece
PIECE_ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_ENDS, _APART = (np.isin(np.arange(256), np.frombuffer(s, np.uint8)) for s in (PIECE_ENDS, PIECE_ENDS + BLANKS))

_LONGS = T.ArrayType(T.LongType())


#: words of a slice (``at``: its number there) in a row each, and a row with the packed ``places``
WORD_OCCURRENCES = T.StructType([
    T.StructField("slice", T.LongType()), T.StructField("at", T.IntegerType()), T.StructField("lang", T.StringType()),
    T.StructField("word", T.StringType()), T.StructField("count", T.LongType()), T.StructField("places", T.BinaryType())])
#: pairs of a slice, packed in a row for each part that they hash to (``data``), and a row with
#: the packed ``places`` and the pairs in each part (``sizes``); a pair's number in the slice
#: goes by part, then by pair
PAIR_OCCURRENCES = T.StructType([
    T.StructField("slice", T.LongType()), T.StructField("part", T.LongType()), T.StructField("data", T.BinaryType()),
    T.StructField("places", T.BinaryType()), T.StructField("sizes", T.BinaryType())])
#: what a part answers: to each slice which of its pairs are frequent (``data``), and the pairs
FREQUENT_PAIRS = T.StructType([
    T.StructField("slice", T.LongType()), T.StructField("part", T.LongType()), T.StructField("data", T.BinaryType()),
    *[T.StructField(n, T.LongType()) for n in ("id", "a", "b", "f")]])


def packed(*columns: np.ndarray) -> bytes:
    """Columns of equally many numbers, byte by byte (high bytes are mostly alike), compressed."""
    flat = b"".join(np.ascontiguousarray(c, np.int64).view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns)
    return len(columns[0]).to_bytes(8, "little") + pa.compress(flat, "zstd", asbytes=True)


def unpacked(blob: bytes, columns: int) -> np.ndarray:
    """The columns, as rows of an array."""
    n = int.from_bytes(blob[:8], "little")
    flat = np.frombuffer(pa.decompress(blob[8:], 8 * n * columns, "zstd"), np.uint8)
    return np.ascontiguousarray(flat.reshape(columns, 8, n).transpose(0, 2, 1)).view(np.int64).reshape(columns, n)


def _batch(schema: T.StructType, **columns) -> pa.RecordBatch:
    """Rows with the given columns, and nulls elsewhere."""
    kinds = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.StringType(): pa.string(), T.BinaryType(): pa.binary()}
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], kinds[f.dataType]) if f.name in columns
                                       else pa.nulls(n, kinds[f.dataType]) for f in schema.fields], schema.names)


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> bool:
    """Whether the runs of ``size`` bytes at ``a`` and at ``b`` are equal, some runs at a time."""
    for low in range(0, len(a), CHECKED):
        n = size[low:low + CHECKED]
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        if (data[np.repeat(a[low:low + CHECKED], n) + inside] != data[np.repeat(b[low:low + CHECKED], n) + inside]).any():
            return False
    return True


def words_of(texts: list[str], langs: list[str]) -> dict[str, list | np.ndarray]:
    """The word occurrences of a slice: distinct (lang, word) with counts, and of each
    occurrence its ``item`` among them and the ``gap`` from the place before (1 inside a
    piece, more between pieces)."""
    data = np.frombuffer("".join(t + "\n" for t in texts).encode(), np.uint8)
    low = _LOWER[data]
    word = ~_APART[data]
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    start, end = edge[0::2], edge[1::2]
    if not len(start):
        return {"lang": [], "word": [], "count": np.zeros(0, np.int64), "gap": start, "item": start}
    seen = np.concatenate(([0], np.cumsum(_ENDS[data])))
    gap = np.ones(len(start), np.int64)
    gap[1:] += seen[start[1:]] != seen[end[:-1]]
    stops = np.cumsum([len(t.encode()) + 1 for t in texts])
    names = sorted(set(langs))
    code = np.array([names.index(x) for x in langs], np.uint64)[np.searchsorted(stops, start, "right")]
    key = run_hashes(low, start, end) + code * np.uint64(0x9E3779B97F4A7C15)
    _, first, item, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    size, raw = end - start, low.tobytes()
    alike = (code[first][item] == code).all() and (size[first][item] == size).all()
    if not alike or not _same_bytes(low, start, start[first][item], size):  # two words of one hash
        every = np.empty(len(start), object)
        every[:] = [(c, raw[a:b]) for c, a, b in zip(code.tolist(), start.tolist(), end.tolist())]
        _, first, item, count = np.unique(every, return_index=True, return_inverse=True, return_counts=True)
    return {"lang": [names[int(c)] for c in code[first]],
            "word": [raw[a:b].decode() for a, b in zip(start[first].tolist(), end[first].tolist())],
            "count": count, "gap": gap, "item": item}


def word_occurrences(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """The relation of all words, a row for each slice of documents."""
    small_batches(docs.sparkSession, SLICE_ROWS)
    slim = docs.select(F.coalesce(col(text).cast("string"), F.lit("")).alias("text"),
                       F.coalesce(col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << SLICE_BITS
        for batch in batches:
            for part in pieces(batch, 0, SLICE_BYTES):
                got = words_of(part.column(0).to_pylist(), part.column(1).to_pylist())
                yield _batch(WORD_OCCURRENCES, slice=[number], places=[packed(got["gap"], got["item"])])
                for low in range(0, len(got["count"]), GROUP_ROWS):
                    rows = slice(low, low + GROUP_ROWS)
                    n = len(got["count"][rows])
                    yield _batch(WORD_OCCURRENCES, slice=np.full(n, number), at=np.arange(low, low + n, dtype=np.int32),
                                 lang=got["lang"][rows], word=got["word"][rows], count=got["count"][rows])
                number += 1
                if not number % (1 << SLICE_BITS):
                    raise ValueError("a scan split of more than 4096 slices: lower spark.sql.files.maxPartitionBytes")

    return slim.mapInArrow(run, WORD_OCCURRENCES)


class Written:
    """A table in the shared checkpoint folder: cuts the lineage until it is dropped."""

    def __init__(self, df: DataFrame, name: str):
        spark = df.sparkSession
        self.path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex[:12]}")
        df.write.option("compression", "zstd").parquet(self.path)
        self.df = spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """Remove the table when what follows from it is written."""
        spark = self.df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def frequent_words(relation: DataFrame, least: int) -> DataFrame:
    """``(slice, at, id, lang, word, f)``: the words that occur ``least`` times or more over all
    slices, wherever they occur. One shuffle counts a word and gives its answer to every slice
    that holds it; it is one row of a slice, however often it occurs there. Its ``id`` is its
    first place of all; ``lang``, ``word`` and ``f`` stand there only."""
    place = F.shiftleft("slice", PLACE_BITS).bitwiseOR(F.col("at"))
    over = Window.partitionBy("lang", "word")
    got = relation.where("places IS NULL").select("lang", "word", place.alias("place"), "count") \
        .select("lang", "word", "place", F.sum("count").over(over).alias("f"), F.min("place").over(over).alias("id")) \
        .filter(F.col("f") >= least)
    first = F.col("place") == F.col("id")
    return got.select(F.shiftright("place", PLACE_BITS).alias("slice"),
                      F.col("place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int").alias("at"), "id",
                      *[F.when(first, F.col(k)).alias(k) for k in ("lang", "word", "f")])


def frequent_pairs(relation: DataFrame, least: int) -> DataFrame:
    """``FREQUENT_PAIRS``: every part counts the pairs that hash to it and answers each slice. A
    pair is one entry of a slice, and the parts are as many as keep one at ``PART_PAIRS``."""
    def fn(key: tuple, table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        got = [unpacked(blob.as_py(), 3) for blob in table.column("data")]
        sizes = [g.shape[1] for g in got]
        a, b, count = (np.concatenate(c) for c in zip(*((np.cumsum(g[0]), g[1], g[2]) for g in got)))
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
        f = np.add.reduceat(count[order], first)
        many = f >= least
        ids = np.where(many, (part << ID_BITS) + np.cumsum(many) - 1, -1)
        of_row = np.empty(len(order), np.int64)
        of_row[order] = np.repeat(ids, np.diff(np.append(first, len(order))))
        slices, answers = [], []
        for s, mine in zip(table.column("slice").to_pylist(), np.split(of_row, np.cumsum(sizes)[:-1])):
            at = np.flatnonzero(mine >= 0)
            if len(at):
                slices.append(s)
                answers.append(packed(np.diff(at, prepend=0), mine[at]))
        batches = [_batch(FREQUENT_PAIRS, slice=slices, part=[part] * len(slices), data=answers)]
        pick = first[many]
        for low in range(0, len(pick), GROUP_ROWS):
            rows = slice(low, low + GROUP_ROWS)
            batches.append(_batch(FREQUENT_PAIRS, id=ids[many][rows], a=a[pick][rows], b=b[pick][rows], f=f[many][rows]))
        return pa.Table.from_batches(batches)

    return relation.where("part IS NOT NULL").select("slice", "part", "data").groupBy("part").applyInArrow(fn, FREQUENT_PAIRS)


def pairs_of(place: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """Merge join of occurrences with those one place on: the distinct pairs (a, b) with their
    counts, and of every joint occurrence its place and pair."""
    here = np.flatnonzero(place[1:] == place[:-1] + 1)  # sorted by place: the next row or none
    known, code = np.unique(ids, return_inverse=True)
    pair = code[here].astype(np.int64) * len(known) + code[here + 1]
    pair, item, count = np.unique(pair, return_inverse=True, return_counts=True)
    a, b = np.divmod(pair, max(1, len(known)))
    return known[a], known[b], count, place[here], item


def extended(relation: DataFrame, chosen: DataFrame, parts: int) -> DataFrame:
    """The relation of the next level (``PAIR_OCCURRENCES``): only occurrences of ``chosen``
    groups are kept (a semi-join by slice and group), and merge-joined with those one place
    on. The groups of both (``a``, ``b``) name the longer phrase."""
    words = "at" in chosen.columns
    columns = ["at", "id"] if words else ["part", "data"]
    answers = chosen.where("slice IS NOT NULL").select(F.col("slice").alias("of"), *columns)
    rows = relation.where("places IS NOT NULL").select("slice", "places", *([] if words else ["sizes"]))

    def ids_of(left: pa.Table, right: pa.Table, n: int) -> np.ndarray:
        ids = np.full(n, -1, np.int64)
        if words:
            ids[right.column("at").to_numpy()] = right.column("id").to_numpy()
            return ids
        part, size = unpacked(left.column("sizes")[0].as_py(), 2)
        starts = dict(zip(part.tolist(), (np.cumsum(size) - size).tolist()))
        for p, blob in zip(right.column("part").to_pylist(), right.column("data")):
            gap, value = unpacked(blob.as_py(), 2)
            ids[starts[p] + np.cumsum(gap)] = value
        return ids

    def fn(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows:
            return none
        gap, item = unpacked(left.column("places")[0].as_py(), 2)
        got = ids_of(left, right, int(item.max()) + 1)[item]
        there = got >= 0
        a, b, count, place, item = pairs_of(np.cumsum(gap)[there], got[there])
        if not len(item):
            return none
        part = (mix(a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(b.astype(np.uint64))) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        a, b, count, part = a[order], b[order], count[order], part[order]
        first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        ends = np.append(first[1:], len(part))
        s = left.column("slice")[0].as_py()
        data = [packed(np.diff(a[i:j], prepend=0), b[i:j], count[i:j]) for i, j in zip(first.tolist(), ends.tolist())]
        return pa.Table.from_batches([
            _batch(PAIR_OCCURRENCES, slice=[s], places=[packed(np.diff(place, prepend=0), number[item])],
                   sizes=[packed(part[first], ends - first)]),
            _batch(PAIR_OCCURRENCES, slice=[s] * len(first), part=part[first], data=data)])

    none = pa.Table.from_batches([_batch(PAIR_OCCURRENCES, slice=[])])
    return rows.groupBy("slice").cogroup(answers.groupBy("of")).applyInArrow(fn, PAIR_OCCURRENCES)


def counted_phrases(docs: DataFrame, text: str, lang: str, least: int, longest: int
                    ) -> tuple[DataFrame, list[DataFrame]]:
    """Word counts by language ``(lang, n)``, and for each length from 1 its frequent phrases
    ``(id, a, b, lang, phrase, last, f, heads, tails)``: ``heads`` and ``tails`` hold the
    occurrences of the first 1, 2, ... and of the last 1, 2, ... words."""
    relation = Written(word_occurrences(docs, text, lang), "occurrences")
    totals = staged(relation.df.where("places IS NULL").groupBy("lang").agg(F.sum("count").alias("n")), "totals")
    chosen = Written(frequent_words(relation.df, least), "frequent")
    none = F.array().cast(_LONGS)
    levels = [staged(chosen.df.where("f IS NOT NULL").select(
        "id", F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b"), "lang",
        F.col("word").alias("phrase"), F.col("word").alias("last"), "f", none.alias("heads"), none.alias("tails")), "phrases1")]
    for k in range(2, longest + 1):
        kept = levels[-1].agg(F.sum("f")).first()[0] or 0  # occurrences that are joined: no fewer than pairs of all slices
        longer = Written(extended(relation.df, chosen.df, max(1, -(-kept // PART_PAIRS))), f"occurrences{k}")
        relation.drop()
        chosen.drop()
        relation = longer
        chosen = Written(frequent_pairs(relation.df, least), f"frequent{k}")
        head = levels[-1].select(F.col("id").alias("a"), "lang", "phrase", F.col("f").alias("fa"), "heads")
        tail = levels[-1].select(F.col("id").alias("b"), "last", F.col("f").alias("fb"), "tails")
        named = chosen.df.where("f IS NOT NULL").select("id", "a", "b", "f").join(head, "a").join(tail, "b")
        levels.append(staged(named.select(
            "id", "a", "b", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "f",
            F.array_append("heads", F.col("fa")).alias("heads"), F.array_append("tails", F.col("fb")).alias("tails")),
            f"phrases{k}"))
    relation.drop()
    chosen.drop()
    return totals, levels


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
            share: int = SHARE, top: int = TOP) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` phrases.

    Candidates are phrases of 2 to ``longest`` words with ``least`` occurrences or more, all of
    them counted, overlaps included. A candidate's score is that of its lowest cut, of equal
    ones the first; it goes if a longer candidate around it (dropped or not) has ``share`` in a
    hundred of its occurrences. Ties in the ranking go by occurrences, then by the phrase's
    bytes. A null or empty text has no words, a null language is ``und``; very long texts are
    one slice each; repeated rows count each; other columns are not read; an empty table gives
    no rows. Nothing is broadcast that grows with the data; what the
    driver holds is one path for each table.
    """
    totals, levels = counted_phrases(docs, text, lang, least, longest)
    scored = []
    for k, level in enumerate(levels[1:], start=2):
        cuts = []
        for j in range(1, k):
            l, r = F.col("heads")[j - 1], F.col("tails")[k - j - 1]
            score = F.expr(f"cast(cast(f as decimal(20,0)) * cast({SCALE} as decimal(8,0)) div "  # beyond 64 bits
                           f"cast(heads[{j - 1}] + tails[{k - j - 1}] as decimal(20,0)) as bigint)")
            cuts.append(F.struct(score.alias("score"), F.lit(j).alias("cut"), l.alias("l"), r.alias("r")))
        best = level.withColumn("best", F.array_min(F.array(*cuts)))
        if k < longest:
            longer = levels[k]
            around = longer.select(F.col("a").alias("id"), "f").unionByName(longer.select(F.col("b").alias("id"), "f")) \
                .groupBy("id").agg(F.max("f").alias("around"))
            best = best.join(around, "id", "left") \
                .filter(F.col("around").isNull() | (100 * F.col("around") < share * F.col("f")))
        scored.append(best.select("lang", "phrase", F.col("f").alias("a"), "best.l", "best.r", "best.score"))
    every = scored[0]
    for s in scored[1:]:
        every = every.unionByName(s)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = every.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_setm_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of every language of the documents."""
    return phrases(table(spark, sf_dir, "documents").select("text", "lang"))


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '{UNKNOWN}') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
occ AS (SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
  FROM w, unnest(range(1, {LONGEST + 1})) t(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS a FROM occ GROUP BY ALL HAVING count(*) >= {LEAST}),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cut AS (SELECT c.*, j, x.a AS l, y.a AS r, CAST({SCALE} AS HUGEINT) * c.a // (x.a + y.a) AS score
  FROM c, unnest(range(1, {LONGEST})) t(j)
  JOIN f x ON x.lang = c.lang AND x.k = j AND x.phrase = array_to_string(c.w[1:j], ' ')
  JOIN f y ON y.lang = c.lang AND y.k = c.k - j AND y.phrase = array_to_string(c.w[j + 1:], ' ') WHERE j < c.k),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM c, unnest(range(2, {LONGEST})) t(m), unnest(range(1, {LONGEST})) s(i) WHERE m < k AND i + m - 1 <= k),
gone AS (SELECT DISTINCT b.lang, b.phrase FROM best b JOIN inside i USING (lang, phrase) WHERE 100 * i.a >= {SHARE} * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
  phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM best JOIN n USING (lang) ANTI JOIN gone USING (lang, phrase)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) <= {TOP}
"""
