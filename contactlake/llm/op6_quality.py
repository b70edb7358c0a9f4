"""Operator 6: quality rules with cross-document line frequency.

Normalised lines are hashed; the distinct documents (by text) that hold a line are counted
per host; lines above the limit are removed from all but one of them, and documents that
this depletes are rejected.
"""
from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contactlake.llm.common import col, map_text, staged, table

# White space between words, and the counted symbols
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
_DIGITS = re.compile("[0-9]+")

#: least words, and most repeated words in a hundred, of the base rules
LEAST_WORDS, MOST_REPEATED = 50, 50
#: a line in more distinct documents of its host than this is removed; a document is
#: depleted if fewer words than this share in a hundred remain
MOST_DOCUMENTS, LEAST_LEFT = 100, 50
#: the limit as a share (in a hundred) of the host's distinct documents, for lines of some
#: words in some documents at least; the registered query and its SQL keep MOST_DOCUMENTS
MOST_SHARE, LEAST_DOCUMENTS, LEAST_LINE = 10, 5, 2

_LINE = T.StructType([T.StructField("hash", T.LongType()), T.StructField("words", T.IntegerType())])
FACTS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("text_key", T.StringType()), T.StructField("lines", T.ArrayType(_LINE))])
_ARROW = pa.struct([(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
                   + [("text_key", pa.string()), ("lines", pa.list_(pa.struct([("hash", pa.int64()), ("words", pa.int32())])))])


def line_hash(line: str) -> int | None:
    """Hash of a line in lower case with single spaces and every number as one sign; None
    for a line without a word."""
    words = WORD.findall(line)
    if not words:
        return None
    h = xxhash.xxh64_intdigest(_DIGITS.sub("0", " ".join(words).lower()).encode())
    return h - (1 << 64) if h >> 63 else h


def repeated_words(words: list[str]) -> int:
    """Words inside three-word windows that occur twice or more, the first included."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    inside, until = 0, 0
    for i, w in enumerate(windows):
        if count[w] > 1:
            inside += i + 3 - max(i, until)
            until = i + 3
    return inside


def facts(text: str, least_line: int = 1) -> dict:
    """Base facts, and the distinct lines of ``least_line`` words or more."""
    words = WORD.findall(text)
    seen: set[str] = set()
    lines: dict[int, int] = {}
    dup = 0
    for line in text.split("\n"):
        h = line_hash(line)
        if h is None:
            continue
        dup += line in seen
        seen.add(line)
        n = len(WORD.findall(line))
        if n >= least_line:
            lines[h] = lines.get(h, 0) + n
    return {"n_words": len(words), "word_chars": sum(map(len, words)),
            "n_symbols": sum(map(text.count, SYMBOLS)), "n_dup_lines": dup,
            "n_repeat_words": repeated_words(words),
            "text_key": hashlib.md5(text.encode(), usedforsecurity=False).hexdigest(),
            "lines": [{"hash": h, "words": n} for h, n in lines.items()]}


def base_failed():
    n, r = F.col("out.n_words"), F.col("out.n_repeat_words")
    return (n < LEAST_WORDS) | (100 * r > MOST_REPEATED * n)


def quality_rules(docs: DataFrame, host: str = "source", text: str = "text", keep=None,
                  most_documents: int = MOST_DOCUMENTS, least_left: int = LEAST_LEFT, *,
                  share: int | None = None, least_documents: int = LEAST_DOCUMENTS,
                  least_line: int = LEAST_LINE) -> DataFrame:
    """``(row, out, removed_words, removed, base_failed, kept)``: ``out`` has the base facts,
    ``removed`` the hashes of the document's lines that are to go, ``kept`` the verdict.

    Documents with equal texts on one host count once, so exact copies do not make their
    lines frequent, and share one result; of the documents that hold a line above the limit,
    the one of least text key keeps it. A null host is a host of its own; a null text counts
    as empty (and fails). Lines without a word are never removed. Texts are read once: what
    is shuffled are line hashes, and a frequent line is counted per task first.

    With ``share`` the limit follows the host in place of ``most_documents``: a line of
    ``least_line`` words or more is removed if more than ``share`` in a hundred of the host's
    distinct documents, and more than ``least_documents`` of them, hold it.
    """
    shortest = 1 if share is None else least_line
    columns = docs.columns if keep is None else list(keep)
    named = docs.select(F.struct(*[col(c) for c in columns]).alias("row"),
                        F.coalesce(F.concat(F.lit("="), col(host).cast("string")), F.lit("")).alias("host"),
                        col(text).cast("string").alias("text"))
    read = map_text(named, lambda texts: pa.array([facts(t, shortest) for t in texts], _ARROW), FACTS,
                    "text", ["row", "host"])
    read = staged(read.select("row.row", "row.host", "out"), "quality")

    once = read.select("host", F.col("out.text_key").alias("text_key"), F.explode("out.lines").alias("line"))
    once = once.select("host", "text_key", F.col("line.hash").alias("hash"), F.col("line.words").alias("words")) \
        .groupBy("host", "hash", "text_key").agg(F.first("words").alias("words"))
    frequent = once.groupBy("host", "hash") \
        .agg(F.count("*").alias("documents"), F.min("text_key").alias("keeper"))
    if share is None:
        frequent = frequent.filter(F.col("documents") > most_documents)
    else:
        hosts = read.select("host", "out.text_key").distinct().groupBy("host").agg(F.count("*").alias("all"))
        frequent = frequent.filter(F.col("documents") > least_documents).join(hosts, "host") \
            .filter(100 * F.col("documents") > share * F.col("all"))
    frequent = frequent.select("host", "hash", "keeper")
    gone = once.join(frequent, ["host", "hash"]).filter(F.col("text_key") != F.col("keeper")) \
        .groupBy("host", "text_key").agg(F.sum("words").alias("removed_words"), F.collect_list("hash").alias("removed"))
    judged = read.withColumn("text_key", F.col("out.text_key")).join(gone, ["host", "text_key"], "left")
    removed = F.coalesce("removed_words", F.lit(0))
    failed = base_failed()
    left = 100 * (F.col("out.n_words") - removed) >= least_left * F.col("out.n_words")
    return judged.select("row", "out", removed.alias("removed_words"),
                         F.coalesce("removed", F.array().cast("array<bigint>")).alias("removed"),
                         failed.alias("base_failed"), (~failed & left).alias("kept"))


def without_lines(text: str, removed: set[int]) -> str:
    """The text without the lines of the given hashes."""
    return "\n".join(x for x in text.split("\n") if line_hash(x) not in removed) if removed else text


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every document, hosts being sources."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    got = quality_rules(docs, keep=["doc_id"], share=MOST_SHARE)
    return got.select(F.col("row.doc_id").alias("doc_id"),
                      *[F.col(f"out.{n}").alias(n) for n in
                        ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                      "base_failed", "kept", "removed_words")


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS host,
    coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
win AS (SELECT r, i, array_to_string(w[i:i + 2], ' ') AS s FROM w, unnest(range(1, len(w) - 1)) t(i)),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM win) x,
    unnest(range(i, i + 3)) t(p) WHERE n > 1 GROUP BY r),
hosts AS (SELECT host, count(DISTINCT md5(t)) AS n FROM d GROUP BY host),
split AS (SELECT r, host, md5(t) AS text_key, unnest(string_split(t, chr(10))) AS l FROM d),
lines AS (SELECT r, host, text_key, l, lw, lower(array_to_string(lw, ' ')) AS low
  FROM (SELECT *, regexp_extract_all(l, '[^\x20\x09-\x0D]+') AS lw FROM split) WHERE len(lw) > 0),
dup AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM lines GROUP BY r),
norm AS (SELECT r, host, text_key, len(lw) AS words, regexp_replace(low, '[0-9]+', '0', 'g') AS line
  FROM lines WHERE len(lw) >= {LEAST_LINE}),
freq AS (SELECT host, line, min(text_key) AS keeper FROM norm JOIN hosts USING (host) GROUP BY host, line
  HAVING count(DISTINCT text_key) > {LEAST_DOCUMENTS} AND 100 * count(DISTINCT text_key) > {MOST_SHARE} * any_value(n)),
gone AS (SELECT r, sum(words) AS words FROM norm JOIN freq USING (host, line) WHERE text_key <> keeper GROUP BY r),
facts AS (SELECT doc_id, len(w) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
    CAST(coalesce(gone.words, 0) AS BIGINT) AS removed_words
  FROM d JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN gone USING (r)),
base AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM facts)
SELECT *, NOT base_failed AND 100 * (n_words - removed_words) >= {LEAST_LEFT} * n_words AS kept FROM base
"""
