"""Operator 11: byte-level BPE encoding by a pair occurrence index, and decoding.

The distinct chunks of a slice lie one after another in one token array. An index maps the
rank of every pair to all its positions; active ranks are applied in ascending order, each at
all its positions at once, and the lists of the pairs that change are updated.
"""
from __future__ import annotations

import heapq
import json
import re
import uuid
from collections import defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from contactlake.llm.common import hex_sha256, map_column, map_text, table
from contactlake.llm.piece_batch import gathered
from contactlake.llm.words import run_hashes

MODEL = "byte_bpe_50k.json"
#: chunks whose ids a worker remembers; the rest are merged again
CACHE_CHUNKS, CACHE_BYTES = 250_000, 64

_INTS = T.ArrayType(T.IntegerType(), containsNull=True)
ENCODED = T.StructType([T.StructField("ids", _INTS), T.StructField("ends", _INTS),
                        T.StructField("decoded", T.StringType())])

#: classes of code points
OTHER, LETTER, NUMBER, SPACE = range(4)
# The contractions that are chunks of their own
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
_NONE = np.int32(np.iinfo(np.int32).max)


def byte_signs() -> dict[str, int]:
    """The sign that a vocabulary writes for each byte: printable bytes stand for themselves,
    the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


@cache
def class_runs() -> list[tuple[int, int, int]]:
    """(first, end, class) of the code points that are letters, numbers or white space, as the
    library's own pattern engine knows them (Unicode versions differ)."""
    out = []
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        runs = Split(Regex(pattern), "removed", invert=True)
        for base in range(0, 0x110000, 0x400):
            if not 0xD800 <= base < 0xE000:  # surrogates are no characters
                text = "".join(map(chr, range(base, base + 0x400)))
                out += [(base + a, base + b, kind) for _, (a, b) in runs.pre_tokenize_str(text)]
    return out


def read_model(path: str) -> dict:
    """What tasks need of a tokenizer file, read on the driver: ids, merges, added tokens.

    Raises for files that ask for more than byte-level BPE as in its plain form."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"]
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
           if model.get(k)]
    if model["type"] != "BPE" or odd or spec["normalizer"] or pre["type"] != "ByteLevel" \
            or pre["add_prefix_space"] or not pre.get("use_regex", True):
        raise ValueError(f"{path} is no plain byte-level BPE {odd}")
    for t in spec["added_tokens"]:
        if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
            raise ValueError(f"added token {t['content']!r} asks for more than its own text")
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    return {"vocab": model["vocab"], "merges": merges, "classes": class_runs(),
            "added": {t["content"]: t["id"] for t in spec["added_tokens"]}}


class Chunks:
    """The chunks of texts in order: ``data`` (all bytes), ``start`` and ``end`` (bytes of each
    chunk), ``fixed`` (id of an added token, else -1) and ``per_text``.

    A chunk is a contraction, or a run of letters, of numbers, or of other signs, each with one
    blank before it, or white space. The last sign of white space before another chunk is a
    chunk of its own unless it is that blank."""

    def __init__(self, classes: np.ndarray, added: dict[str, int], split: re.Pattern | None, texts: list[str]):
        parts, owner, fixed = [], [], []
        for i, t in enumerate(texts):
            for k, p in enumerate(split.split(t) if split else [t]):
                if p:
                    parts.append(p)
                    owner.append(i)
                    fixed.append(added[p] if k % 2 else -1)
        text = "".join(parts)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        n = len(points)
        kind = classes[points]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        stops = np.cumsum(sizes)
        opens = np.zeros(n + 1, bool)       # a part begins
        opens[np.concatenate(([0], stops))] = True
        special = np.repeat(np.array(fixed, np.int64) >= 0, sizes)
        cut = opens.copy()                  # a chunk begins
        cut[1:n] |= kind[1:] != kind[:-1]
        white = kind == SPACE
        ends = np.flatnonzero(white & cut[1:])          # last sign of a run of white space
        ends = ends[~opens[ends + 1]]                   # with a chunk of the same part after it
        blank = points[ends] == 32
        cut[ends] = True
        cut[ends[blank] + 1] = False                    # the blank belongs to what follows
        # contractions: an apostrophe that is a chunk, and letters after it
        sign = np.flatnonzero((points == 39) & cut[:n] & cut[1:] & ~opens[1:])
        sign = sign[kind[sign + 1] == LETTER]
        for c in CONTRACTIONS:
            at = sign[sign + len(c) < n]
            for k, letter in enumerate(c):
                at = at[(points[at + 1 + k] == ord(letter)) & ~opens[at + 1 + k]]
            cut[at + 1] = False
            cut[at + 1 + len(c)] = True
            sign = np.setdiff1d(sign, at, assume_unique=True)
        inside = np.zeros(n + 1, bool)
        inside[:n] = special
        cut &= opens | ~inside
        width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        at_byte = np.concatenate(([0], np.cumsum(width)))
        edges = np.flatnonzero(cut[:n])
        self.data = np.frombuffer(text.encode(), np.uint8)
        self.start = at_byte[edges]
        self.end = np.append(self.start[1:], len(self.data))[:len(edges)]
        part = np.searchsorted(stops, edges, "right")
        self.fixed = np.array(fixed, np.int64)[part]
        self.per_text = np.bincount(np.array(owner, np.int64)[part], minlength=len(texts)).astype(np.int64)


class PairIndex:
    """Token arrays of chunks, and the positions of every pair by its rank."""

    def __init__(self, coder: "Coder", token: np.ndarray, sizes: np.ndarray):
        self.coder, self.token = coder, token
        n = len(token)
        self.after, self.before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        ends = np.cumsum(sizes)
        self.after[ends - 1] = -1
        self.before[ends - sizes] = -1
        self.rank = np.full(n, _NONE, np.int32)  # of the pair that begins at each position
        left = np.flatnonzero(self.after >= 0)
        self.rank[left] = coder.ranks(token[left], token[left + 1])
        self.alive = np.ones(n, bool)
        self.lists: dict[int, list[np.ndarray]] = defaultdict(list)
        self.heap: list[int] = []
        self._add(left, self.rank[left])

    def _add(self, at: np.ndarray, rank: np.ndarray) -> None:
        """Append positions to the lists of their ranks."""
        real = rank != _NONE
        at, rank = at[real], rank[real]
        if not len(at):
            return
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        first = [0, *cut.tolist(), len(at)]
        for k, r in enumerate(rank[first[:-1]].tolist()):
            if r not in self.lists:
                heapq.heappush(self.heap, r)
            self.lists[r].append(at[first[k]:first[k + 1]])

    def merge(self) -> None:
        """Apply the active ranks in ascending order until none is left."""
        coder, token, after, before, rank = self.coder, self.token, self.after, self.before, self.rank
        while self.heap:
            r = heapq.heappop(self.heap)
            got = self.lists.pop(r)
            at = got[0] if len(got) == 1 else np.concatenate(got)
            at = at[rank[at] == r]  # positions whose pair has changed are stale
            if not len(at):
                continue
            if (at[1:] <= at[:-1]).any():  # several lists, or both neighbours of merges in one
                at = np.unique(at)
            later = None
            if not coder.ascending:  # what overlaps is stale afterwards, or again a pair if a lower rank took its neighbour
                at, later = self._first_of_each(at)
            elif coder.left[r] == coder.right[r]:  # pairs that overlap: from the left
                at = self._apart(at)
            other = after[at]
            beyond = after[other]
            token[at] = coder.made[r]
            self.alive[other] = False
            rank[other] = _NONE
            rank[at] = _NONE
            after[at] = beyond
            more = beyond >= 0
            before[beyond[more]] = at[more]
            right, follow = at[more], beyond[more]
            rank[right] = coder.ranks(token[right], token[follow])
            ahead = before[at]
            left = ahead[ahead >= 0]
            rank[left] = coder.ranks(token[left], token[after[left]])
            both = np.concatenate((right, left))
            self._add(both, rank[both])
            if later is not None:
                self._add(later, rank[later])

    def _apart(self, at: np.ndarray) -> np.ndarray:
        """Every second one of runs of positions that each begin where the one before ends."""
        chained = np.zeros(len(at), bool)
        chained[1:] = self.after[at[:-1]] == at[1:]
        start = np.flatnonzero(~chained)
        place = np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))
        return at[place % 2 == 0]

    def _first_of_each(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first position of each chunk, and the others: where a merge can make a pair of
        a lower rank, that pair goes before the chunk's next one."""
        _, pick = np.unique(self.chunk[at], return_index=True)
        return at[pick], np.delete(at, pick)


class Coder:
    """Encodes slices of texts, and decodes ids, for one model."""

    def __init__(self, model: dict):
        signs = byte_signs()
        vocab = model["vocab"]
        size = 1 + max([*vocab.values(), *model["added"].values()])
        self.surface: list[bytes] = [b""] * size
        for p, i in [*vocab.items(), *model["added"].items()]:
            self.surface[i] = bytes(signs[c] for c in p) if all(c in signs for c in p) else p.encode()
        self.size = np.array([len(s) for s in self.surface], np.int64)
        self.flat = np.frombuffer(b"".join(self.surface), np.uint8)
        self.of_byte = np.full(256, -1, np.int32)
        for c, b in signs.items():
            self.of_byte[b] = vocab.get(c, -1)
        self.left = np.array([vocab[a] for a, _ in model["merges"]], np.int64)
        self.right = np.array([vocab[b] for _, b in model["merges"]], np.int64)
        self.made = np.array([vocab[a + b] for a, b in model["merges"]], np.int32)
        code = self.left << 32 | self.right
        last = np.unique(code[::-1], return_index=True)[1]  # a pair listed twice has its last rank
        order = len(code) - 1 - last
        self.codes, self.code_rank = code[order], order.astype(np.int32)
        # whether a merge can only make pairs of higher ranks: no part is made later
        born = np.full(size, -1)
        np.maximum.at(born, self.made, np.arange(len(code)))
        self.ascending = bool((np.maximum(born[self.left], born[self.right]) < np.arange(len(code))).all())
        self.classes = np.zeros(0x110000, np.uint8)
        for a, b, kind in model["classes"]:
            self.classes[a:b] = kind
        self.added = model["added"]
        longest = sorted(self.added, key=len, reverse=True)
        self.split = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.known: dict[bytes, bytes] = {}

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        code = a.astype(np.int64) << 32 | b
        k = np.searchsorted(self.codes, code)
        k[k == len(self.codes)] = 0
        return np.where(self.codes[k] == code, self.code_rank[k], _NONE)

    def merged(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks that lie one after another, and the number of ids of each."""
        token = self.of_byte[data]
        if not len(token):
            return token, np.zeros(len(sizes), np.int64)
        known = token >= 0
        if not known.all():  # a byte without a token is skipped, as there is no unknown token
            chunk = np.repeat(np.arange(len(sizes)), sizes)[known]
            sizes, token = np.bincount(chunk, minlength=len(sizes)), token[known]
        full = sizes > 0
        index = PairIndex(self, token, sizes[full])
        index.chunk = np.repeat(np.arange(int(full.sum())), sizes[full])
        index.merge()
        counts = np.zeros(len(sizes), np.int64)
        counts[full] = np.bincount(index.chunk[index.alive], minlength=int(full.sum()))
        return index.token[index.alive], counts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of all texts one after another the ids, and the number of ids of each text."""
        c = Chunks(self.classes, self.added, self.split, texts)
        if not len(c.start):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        raw, size = c.data.tobytes(), c.end - c.start
        _, first, which = np.unique(run_hashes(c.data, c.start, c.end), return_index=True, return_inverse=True)
        same = (size[first][which] == size).all() and (
            c.data == c.data[np.repeat(c.start[first][which], size) + np.arange(len(c.data)) - np.repeat(c.start, size)]).all()
        if not same:  # two chunks of one hash
            every = np.array([raw[a:b] for a, b in zip(c.start.tolist(), c.end.tolist())] + [None], object)[:-1]
            _, first, which = np.unique(every, return_index=True, return_inverse=True)
        keys = [raw[a:b] for a, b in zip(c.start[first].tolist(), c.end[first].tolist())]
        known = self.known
        new = [k for k, key in enumerate(keys) if key not in known]
        ids, counts = self.merged(gathered(c.data, size, first[new]), size[first[new]]) if new else (None, [])
        fresh = {}
        if new:
            packed, stop = ids.astype(np.int32).tobytes(), 4 * np.cumsum(counts)
            fresh = {keys[k]: packed[a:b] for k, a, b in zip(new, (stop - 4 * counts).tolist(), stop.tolist())}
        runs = [known[key] if key in known else fresh[key] for key in keys]
        per = np.fromiter(map(len, runs), np.int64, len(runs)) // 4
        flat = np.frombuffer(b"".join(runs), np.int32)
        if len(known) + len(fresh) > CACHE_CHUNKS:
            known.clear()
        known.update((k, v) for k, v in fresh.items() if len(k) <= CACHE_BYTES)
        out, n = gathered(flat, per, which), per[which]
        if (c.fixed >= 0).any():  # added tokens: one id each
            mine = np.repeat(c.fixed, n)
            head = np.zeros(len(out), bool)
            head[(np.cumsum(n) - n)[n > 0]] = True
            out = np.where(mine >= 0, mine, out)[(mine < 0) | head].astype(np.int32)
            n = np.where(c.fixed >= 0, 1, n)
        running = np.concatenate(([0], np.cumsum(n)))
        cut = np.cumsum(c.per_text)
        return out.astype(np.int32), running[cut] - running[cut - c.per_text]

    def decode(self, ids: np.ndarray, n: np.ndarray) -> list[str]:
        """The texts of runs of ``n`` ids each; bytes that are no UTF-8 become U+FFFD."""
        raw = gathered(self.flat, self.size, ids).tobytes()
        ends = np.concatenate(([0], np.cumsum(self.size[ids])))
        stop = np.cumsum(n)
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[stop - n].tolist(), ends[stop].tolist())]


_loaded: dict[str, Coder] = {}


def _coder(send) -> Coder:
    """One coder per worker process and broadcast model."""
    if send.id not in _loaded:
        _loaded.clear()
        _loaded[send.id] = Coder(send.value)
    return _loaded[send.id]


class _Sent:
    """A broadcast model and a name by which workers keep what they build of it."""

    def __init__(self, docs: DataFrame, path: str):
        self.cast = docs.sparkSession.sparkContext.broadcast(read_model(path))
        self.id = uuid.uuid4().hex

    @property
    def value(self) -> dict:
        return self.cast.value


def encode(docs: DataFrame, model: str, text: str = "text", keep=None, decoded: bool = False) -> DataFrame:
    """``(row, out)`` with ``out.ids``, ``out.ends`` (the end byte of each id's piece in the
    UTF-8 text) and, with ``decoded``, ``out.decoded`` (the text of the ids; else null).

    No special tokens are added; an added token's string inside a text becomes its id, as by
    the library's default. A null or empty text has no ids. Very long texts are encoded whole;
    repeated rows are encoded each; ties cannot arise, as ranks are distinct and equal pairs go
    from left to right; an empty table gives no rows; other columns stay in ``row``. Nothing is
    shuffled, so a lost task is run again alone.
    """
    send = _Sent(docs, model)

    def fn(texts: list[str]) -> pa.Array:
        coder = _coder(send)
        ids, n = coder.encode(texts)
        ends = np.cumsum(coder.size[ids])
        stop = np.cumsum(n)
        base = np.concatenate(([0], ends))[stop - n]
        ends = (ends - np.repeat(base, n)).astype(np.int32)
        offsets = pa.array(np.concatenate(([0], stop)).astype(np.int32))
        cols = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (ids, ends)]
        back = pa.array(coder.decode(ids, n), pa.string()) if decoded else pa.nulls(len(n), pa.string())
        return pa.StructArray.from_arrays([*cols, back], ["ids", "ends", "decoded"])

    return map_text(docs, fn, ENCODED, text, keep, rows=2500, most=8 << 20)


def decode(rows: DataFrame, model: str, ids: str = "ids", keep=None) -> DataFrame:
    """``(row, out)`` with ``out.text``: the text that the id array ``ids`` decodes to, special
    tokens included. Null or empty ids give an empty text; null entries and ids outside the
    vocabulary are skipped, as by the library."""
    send = _Sent(rows, model)

    def fn(values: list) -> pa.Array:
        coder = _coder(send)
        kept = [[i for i in v or () if i is not None and 0 <= i < len(coder.surface)] for v in values]
        n = np.array([len(v) for v in kept], np.int64)
        flat = np.array([i for v in kept for i in v], np.int64)
        return pa.StructArray.from_arrays([pa.array(coder.decode(flat, n), pa.string())], ["text"])

    return map_column(rows, fn, T.StructType([T.StructField("text", T.StringType())]), ids, keep)


def op11_bpe_pair_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, and decoded again; ``n_covered`` counts the bytes under its ids,
    which are all bytes of the text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode(docs, public_tokenizers.path(MODEL), keep=["doc_id"], decoded=True)
    ids = F.col("out.ids")
    return coded.select(
        F.col("row.doc_id").alias("doc_id"),
        F.size(ids).cast("long").alias("n_tokens"),
        hex_sha256(F.array_join(ids.cast("array<string>"), ",")).alias("ids_sha256"),
        hex_sha256(F.col("out.decoded")).alias("decoded_sha256"),
        F.coalesce(F.array_max("out.ends"), F.lit(0)).cast("long").alias("n_covered"))
