"""Operator 9: secret scans.

Fixed patterns find the base spans; values in a credential context are scored by the
number of guesses that the cheapest segmentation into words, dates, repeats, keyboard walks
and brute-force spans needs, and costly values become ``guess`` spans. Words are ranked by
the documents of the corpus that hold them outside of credential values.
"""
from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contactlake.llm.common import col, hex_sha256, map_text, pieces, small_batches, staged, table
from contactlake.llm.op3_resample import kth_largest

# The base patterns, each with the shortest match that counts
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_VALUE, ACCESS_CHARS = 6, 20
KINDS = ("assign", "access", "hex", "guess")

# The credential contexts whose value (the group that matched) is scored: up to
# the closing quote, up to a blank, or the password of an address
ASSIGNED = re.compile(r"""(?ai:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|auth[_-]?key|access[_-]?key|private[_-]?key|credentials?)["']?[\x20\t]*(?::=|=>|[:=])[\x20\t]*(?:"([^"\n]+)"|'([^'\n]+)'|["']?([^\s"'`<>,;]+))""")
BEARER = re.compile(r"(?ai:\bbearer)[\x20\t]+([A-Za-z0-9+/_.=~-]+)")
ADDRESS = re.compile(r"://[^\s:/@]++:([^\s/@]++)@")
SCHEME = re.compile(r"[A-Za-z0-9+.-]")
#: a text without any of these (lower case) has no context and no assignment
TRIGGERS = ("pass", "pwd", "secret", "token", "api", "key", "credential", "bearer", "://")

# Frequent password words, most frequent first
COMMON = ("password passwd pass admin administrator root user login guest test testing secret "
          "token key apikey welcome hello master changeme default example sample demo temp "
          "letmein qwerty dragon monkey football baseball sunshine princess shadow super love "
          "summer winter spring autumn monday friday january december london paris berlin "
          "server database mysql postgres oracle redis docker cloud local host backup public "
          "private internal system service account company office home house money").split()
RANK = {w: i + 1 for i, w in enumerate(COMMON)}
LONGEST = max(map(len, COMMON))
# Letters that stand for others, and the rows of the keyboard
LEET = str.maketrans("4@310$57", "aaeiosst")
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = str.maketrans('~!@#$%^&*()_+{}:"<>?', "`1234567890-=[];',./")
DATE = re.compile(r"(?:\d{4}([-/._]?)\d{1,2}\1\d{1,2}|\d{1,2}([-/._]?)\d{1,2}\2(?:\d{4}|\d{2})|(?:19|20)\d{2})")

#: log10 of the guesses from which a value is a secret, and its shortest length
THRESHOLD, SHORTEST = 8.0, 6
#: characters of one date; the year from which years in dates are counted
DATE_CHARS, YEAR = 10, 2025
#: characters that are scored first, then four times as many, of a value to be compared
PREFIX = 64
#: guesses, as logarithms, of how often a unit is repeated, of where and how far a keyboard
#: walk goes (its keys are added), of each of its turns, and of where a segment ends
REPEAT, WALK, TURN, STEP = math.log10(8), math.log10(8), math.log10(4.6), math.log10(2)
#: a word of the corpus: 3 to 40 letters, in at least two documents; the most frequent are
#: kept, fewer than WORDS (at most 40 letters each, so about 30 MB in a Python worker)
LETTERS = re.compile(r"[^\W\d_]{3,}")
WORD_CHARS, WORD_DOCUMENTS, WORDS = 40, 2, 100_000
#: words that one task counts before it hands them on
COUNTED = 200_000
#: what may just be the next word of a sentence after "bearer" or in quotes, and log10 of the
#: guesses that each such word needs beyond the threshold (after "bearer": without a header)
NEXT_WORD = re.compile(r"(?:[^\W\d_][a-z]+|[a-z])(?:-(?:[^\W\d_][a-z]+|[a-z]))*[.,;:!?-]*")
HEADER = re.compile(r"""(?ai:authorization)["']?[\x20\t]*[:=][\x20\t]*["']?$""")
NEXT_WORD_GUESSES, HEADER_CHARS = 6.0, 40


def _neighbours() -> dict[str, frozenset[str]]:
    at = {c: (x + 0.5 * y, y) for y, row in enumerate(ROWS) for x, c in enumerate(row)}
    return {c: frozenset(d for d, (u, v) in at.items()
                         if d != c and abs(u - x) <= 1 and abs(v - y) <= 1)
            for c, (x, y) in at.items()}


NEAR = _neighbours()


def _word(s: str, ranks: dict[str, int] = RANK) -> float | None:
    """log10 guesses of a dictionary word in any case and with look-alike signs."""
    low = s.lower()
    plain = low.translate(LEET)
    rank = ranks.get(low) or ranks.get(plain)
    if rank is None:
        return None
    upper = sum(c.isupper() for c in s)
    case = 1 if not upper else 2 if upper == len(s) or s[0].isupper() and upper == 1 else 2 ** min(upper, len(s) - upper + 1)
    return math.log10(rank * case * (1 if low in ranks else 2))


def _date(s: str, today: int) -> float | None:
    if not DATE.fullmatch(s):
        return None
    years = [int(y) for y in re.findall(r"(?:19|20)\d{2}", s)]
    span = max(20, abs(today - years[0])) if years else 100
    days = 1 if len(s) == 4 and years else 365
    return math.log10(days * span * (4 if not s.isdigit() else 1))


def repetitions(value: str) -> list[tuple[int, int, int]]:
    """Maximal stretches ``(start, end, period)`` of two copies of a unit or more.

    Two copies of a unit of ``p`` characters hold one of the places 0, p, 2p, ... in the first
    copy, so it is enough to see how far the value agrees with itself ``p`` later around these."""
    n, out = len(value), []
    whole: list[int] = []  # periods of the whole value: their multiples say nothing new
    for p in range(1, n // 2 + 1):
        if any(p % w == 0 for w in whole):
            continue
        found: list[list[int]] = []
        for i in range(0, n - p, p):
            after = _agree(value, i, i + p, min(p, n - i - p))
            before = _agree_back(value, i, i + p, min(p - 1, i)) if after < p else 0
            if after + before >= p:
                low, high = i - before, i + p + after
                if found and low <= found[-1][1] - p:
                    found[-1][1] = max(high, found[-1][1])
                else:
                    found.append([low, high])
        for low, high in found:
            while low and value[low - 1] == value[low - 1 + p]:
                low -= 1
            out.append((low, high, p))
            if (low, high) == (0, n):
                whole.append(p)
    return out


def _agree(value: str, a: int, b: int, most: int) -> int:
    """How many characters from ``a`` and from ``b`` on are equal, at most ``most``."""
    if value[a:a + most] == value[b:b + most]:
        return most
    low, high = 0, most
    while high - low > 1:
        k = (low + high) // 2
        low, high = (k, high) if value[a:a + k] == value[b:b + k] else (low, k)
    return low


def _agree_back(value: str, a: int, b: int, most: int) -> int:
    """How many characters before ``a`` and before ``b`` are equal, at most ``most``."""
    low, high = 0, most + 1
    while high - low > 1:
        k = (low + high) // 2
        low, high = (k, high) if value[a - k:a] == value[b - k:b] else (low, k)
    return low


def guesses(value: str, today: int = YEAR, ranks: dict[str, int] = RANK, longest: int = LONGEST,
            enough: float = math.inf) -> float:
    """log10 of the guesses for ``value``: the cheapest of all segmentations, where segments
    multiply their guesses and each costs a factor of two (``STEP``) besides.

    A segment is a word of ``ranks`` (at most ``longest`` characters), a date, copies of the
    characters just before it (any unit, any number: ``REPEAT``), a walk of three keys or more
    over the keyboard (47 keys, ``WALK``, and ``TURN`` for each change of direction), or
    characters by brute force. With ``enough`` the answer may be any number of at least
    ``enough`` where the cheapest one is no less: mostly seen from the first characters."""
    if enough < math.inf:
        size = PREFIX
        while size < len(value):
            cost, settled = _cheapest(value[:size], today, ranks, longest, enough)
            if settled:
                return cost
            size *= 4
    return _cheapest(value, today, ranks, longest, enough)[0]


def _cheapest(value: str, today: int, ranks: dict[str, int], longest: int, enough: float) -> tuple[float, bool]:
    """``guesses`` of the value, and whether whatever follows it can only cost ``enough``."""
    n, low = len(value), value.lower().translate(SHIFTED)
    lower = "".join(x if len(x := c.lower()) == 1 else c for c in value)
    plain = lower.translate(LEET)
    best = [0.0] + [math.inf] * n
    brute = math.inf  # cheapest way that ends in a brute-force span
    keys = math.log10(len(NEAR)) + WALK + STEP
    walk, since, turns = math.inf, 1, [0] * (n + 1)  # cheapest start of a walk that goes on here, less its turns
    stretches = sorted(repetitions(value), key=lambda r: r[0] + r[2])
    running: list[tuple[int, int, int, dict[int, float]]] = []
    at, cheap = 0, 0  # next stretch; last place whose prefix costs less than enough
    for j in range(1, n + 1):
        new = math.log10(10) if value[j - 1].isdigit() else math.log10(26 if value[j - 1].isalpha() else 33)
        brute = min(brute, best[j - 1] + STEP) + min(new, 1.0)
        cost = brute
        for i in range(max(0, j - longest), j - 2):
            if lower[i:j] not in ranks and plain[i:j] not in ranks:
                continue
            got = _word(value[i:j], ranks)
            if got is not None:
                cost = min(cost, best[i] + STEP + got)
        for i in range(max(0, j - DATE_CHARS), j - 3):
            if value[i].isdigit() and value[j - 1].isdigit():
                got = _date(value[i:j], today)
                if got is not None:
                    cost = min(cost, best[i] + STEP + got)
        for start, end, p, least in running:  # copies of what stands at the same place of a unit
            if j >= start + 2 * p:
                cost = min(cost, least[j % p] + STEP + REPEAT)
        if j > 1 and low[j - 1] in NEAR.get(low[j - 2], ()):
            turns[j] = turns[j - 1] + (j - since >= 2 and low[j - 1] != low[j - 3] and _turn(low, j - 1))
            if j - since >= 2:
                i = j - 3  # a walk may begin at any key of the chain
                walk = min(walk, best[i] - turns[i + 2] * TURN)
                cost = min(cost, walk + turns[j] * TURN + keys)
        else:
            walk, since, turns[j] = math.inf, j, 0
        best[j] = cost
        while at < len(stretches) and stretches[at][0] + stretches[at][2] <= j:
            running.append((*stretches[at], defaultdict(lambda: math.inf)))
            at += 1
        running = [r for r in running if r[1] > j]
        for start, end, p, least in running:
            least[j % p] = min(least[j % p], cost)
        if cost < enough:
            cheap = j
        elif j >= 2 * (cheap + 1) + longest and since > cheap:
            return cost, True  # no segment that ends later begins at a cheap prefix
    return best[n], False


def _turn(low: str, k: int) -> bool:
    """Whether a walk changes its direction at character ``k``."""
    return _direction(low[k - 2], low[k - 1]) != _direction(low[k - 1], low[k])


def _direction(a: str, b: str) -> tuple[int, int]:
    (y, x), (v, u) = ((y, row.index(c)) for c in (a, b) for y, row in enumerate(ROWS) if c in row)
    return v - y, u - x


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the base patterns."""
    found = [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= ACCESS_CHARS]
    if _may_hold(text):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text)
                  if len(m[1]) >= ASSIGN_VALUE]
    return found


def _may_hold(text: str) -> bool:
    low = text.lower()
    return any(t in low for t in TRIGGERS)


def values(text: str) -> dict[tuple[int, int], float]:
    """The spans of the values in a credential context, and the log10 guesses that each
    needs beyond the threshold: none, but after a bare "bearer" a value that looks like the
    next word of a sentence needs ``NEXT_WORD_GUESSES``, and so does each word of a value in
    quotes that is nothing but such words."""
    found: dict[tuple[int, int], float] = {}
    if not _may_hold(text):
        return found

    def add(span: tuple[int, int], more: float = 0.0) -> None:
        found[span] = min(more, found.get(span, more))

    for m in ASSIGNED.finditer(text):
        words = m[m.lastindex].split()
        prose = len(words) > 1 and all(map(NEXT_WORD.fullmatch, words))
        if words:
            add(m.span(m.lastindex), NEXT_WORD_GUESSES * len(words) if prose else 0.0)
    for m in BEARER.finditer(text):
        bare = NEXT_WORD.fullmatch(m[1]) and not HEADER.search(text[max(0, m.start() - HEADER_CHARS):m.start()])
        add(m.span(1), NEXT_WORD_GUESSES if bare else 0.0)
    for m in ADDRESS.finditer(text):
        at = m.start() - 1
        while at >= 0 and SCHEME.match(text[at]) and not text[at].isalpha():
            at -= 1
        if at >= 0 and text[at].isascii() and text[at].isalpha():  # a scheme begins with a letter
            add(m.span(1))
    return found


def scan(text: str, threshold: float = THRESHOLD, today: int = YEAR,
         ranks: dict[str, int] = RANK, longest: int = LONGEST) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, end exclusive, by start, then kind."""
    found = base_spans(text)
    found += [("guess", a, b) for (a, b), more in values(text).items()
              if b - a >= SHORTEST and guesses(text[a:b], today, ranks, longest, threshold + more) >= threshold + more]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def prose_words(text: str) -> set[str]:
    """The distinct words of a text in lower case, without those of base spans and of values
    in a credential context: a secret does not make itself a word."""
    out = [" "]
    at = 0
    for a, b in sorted([*values(text), *((a, b) for _, a, b in base_spans(text))]):
        out += [text[at:a], " "]
        at = max(at, b)
    return {w for w in LETTERS.findall("".join([*out, text[at:]]).lower()) if len(w) <= WORD_CHARS}


def word_ranks(docs: DataFrame, text: str = "text", most: int = WORDS) -> dict[str, int]:
    """Fewer than ``most`` words with their ranks by the documents of ``docs`` that hold them
    (ties by the word), and the password words, which keep their own rank if it is less.

    Counted per task first, then by word, into a table of the checkpoint folder. Words as
    frequent as the ``most``-th are left out together, so the driver's share is bounded."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter[str] = Counter()
        for batch in batches:
            for part in pieces(batch, 0):
                for t in part.column(0).to_pylist():
                    count.update(prose_words(t or ""))
                    if len(count) >= COUNTED:
                        yield pa.RecordBatch.from_arrays([pa.array(count.keys(), pa.string()), pa.array(count.values(), pa.int64())], ["word", "n"])
                        count = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(count.keys(), pa.string()), pa.array(count.values(), pa.int64())], ["word", "n"])

    counts = docs.select(col(text).cast("string").alias("text")).mapInArrow(run, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= WORD_DOCUMENTS)
    counts = staged(counts, "words")
    cut = kth_largest(counts, "n", most)
    kept = counts if cut is None else counts.filter(F.col("n") > cut)
    ranks = {r["word"]: i + 1 for i, r in enumerate(sorted(kept.collect(), key=lambda r: (-r["n"], r["word"])))}
    return ranks | {w: min(k, ranks.get(w, k)) for w, k in RANK.items()}


_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                      T.StructField("end", T.IntegerType())])
FOUND = T.StructType([T.StructField("spans", T.ArrayType(_SPAN)), T.StructField("masked", T.StringType())])
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every run of overlapping spans replaced by the kind of its first."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()} SECRET]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find_secrets(docs: DataFrame, text: str = "text", keep=None, masked: bool = False,
                 threshold: float = THRESHOLD, today: int = YEAR,
                 ranks: dict[str, int] | None = None) -> DataFrame:
    """``(row, out)`` with ``out.spans`` (kind, start, end in code points) by start, then
    kind, and with ``masked`` the text in which they are replaced (null if there are none).

    An ``assign`` span is its whole match, a ``guess`` span the scored value. A null text
    counts as empty. Whole texts are scanned; repeated rows each; ``today`` is the year from
    which years in dates are counted (a fixed default, so that a table gives the same spans
    in any year). ``ranks`` are the ranks
    of words (default: ``word_ranks`` of all ``docs``, which are read once more for that).
    """
    ranks = word_ranks(docs, text) if ranks is None else ranks
    longest = max(map(len, ranks), default=0)

    def fn(texts: list[str]) -> pa.Array:
        found = [scan(t, threshold, today, ranks, longest) for t in texts]
        spans = pa.array([[dict(zip(("kind", "start", "end"), s)) for s in f] for f in found], _ARROW)
        clean = [mask(t, f) if masked and f else None for t, f in zip(texts, found)]
        return pa.StructArray.from_arrays([spans, pa.array(clean, pa.string())], ["spans", "masked"])

    return map_text(docs, fn, FOUND, text, keep)


def joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All secrets of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(docs, keep=["doc_id"])
    spans = F.col("out.spans")
    base = F.filter(spans, lambda s: s["kind"] != "guess")

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(F.col("row.doc_id").alias("doc_id"), count("assign"), count("access"),
                        count("hex"), hex_sha256(joined(base)).alias("base_sha256"),
                        joined(spans).alias("spans"), count("guess"))
