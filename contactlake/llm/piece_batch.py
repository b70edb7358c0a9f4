"""Whole slices of texts at once: distinct chunks, merging in step, prefix counts in step."""
from __future__ import annotations

import numpy as np
import pyarrow as pa

from contactlake.llm.piece_model import CONTROL, SHORT, SPACE, Chunks, PieceModel
from contactlake.llm.words import mix, run_hashes

#: token pairs whose verdict a worker remembers
PAIR_ENTRIES = 1 << 20
_NONE = np.iinfo(np.int32).max
_EMPTY = ~np.uint64(0)


def gathered(flat: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` (of the given sizes) in the order of ``index``."""
    first = np.cumsum(sizes) - sizes
    took = sizes[index]
    shift = first[index] - (np.cumsum(took) - took)
    return flat[np.arange(int(took.sum())) + np.repeat(shift, took)]


class HashTable:
    """64-bit keys to values, in a few probes: each table holds what collides before it."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.levels = []
        while len(keys):
            bits = max(4, int(len(keys)).bit_length() + 2)
            slot = self._slot(keys, bits)
            held = np.full(1 << bits, _EMPTY, np.uint64)
            got = np.full(1 << bits, -1, np.int32)
            held[slot], got[slot] = keys, values
            self.levels.append((bits, held, got))
            left = held[slot] != keys
            keys, values = keys[left], values[left]

    @staticmethod
    def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
        return mix(keys + np.uint64(bits)) >> np.uint64(64 - bits)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 for keys that are absent."""
        out = np.full(len(keys), -1, np.int32)
        at = None
        for bits, held, got in self.levels:
            k = keys if at is None else keys[at]
            slot = self._slot(k, bits)
            there = held[slot]
            same = there == k
            other = ~same & (there != _EMPTY)  # an empty slot ends the search
            if at is None:
                out[same] = got[slot[same]]
                at = np.flatnonzero(other)
            else:
                out[at[same]] = got[slot[same]]
                at = at[other]
        return out


class Distinct:
    """The distinct chunks of a slice of texts, as bytes and characters.

    A chunk is a run of white space and the text up to the next one; each text gets the dummy
    prefix first, and white-space signs count as white space."""

    def __init__(self, model: PieceModel, texts: list[str]):
        raw = [(" " + t.replace(SPACE, " ")).encode() if t else b"" for t in texts]
        joined = b"".join(raw)
        size = np.array([len(r) for r in raw], np.int64)
        stops = np.cumsum(size)
        data = np.frombuffer(joined, np.uint8)
        if model.apart:
            space = data == 32
            opens = space.copy()
            opens[1:] &= ~space[:-1]
            opens[(stops - size)[size > 0]] = True
            start = np.flatnonzero(opens)
        else:
            start = (stops - size)[size > 0]
        end = np.append(start[1:], len(data))[:len(start)]
        #: chunks of each text, and for every chunk its distinct one
        self.per_text = np.diff(np.searchsorted(start, stops), prepend=0)
        if len(start):
            _, first, self.index = np.unique(run_hashes(data, start, end), return_index=True, return_inverse=True)
            if not self._equal(data, start, end - start, first[self.index]):  # two chunks of one hash
                every = [joined[a:b] for a, b in zip(start.tolist(), end.tolist())]
                _, first, self.index = np.unique(np.array(every, object), return_index=True, return_inverse=True)
        else:
            first = self.index = np.zeros(0, np.int64)
        #: bytes, byte counts, code points and character counts of the distinct chunks
        self.sizes = (end - start)[first] if len(start) else np.zeros(0, np.int64)
        every = end - start if len(start) else self.sizes
        self.data = gathered(data, every, first)
        self.text = self.data.tobytes().decode()
        self.points = np.frombuffer(self.text.encode("utf-32-le"), np.uint32)
        lead = np.concatenate(([0], np.cumsum((self.data & 0xC0) != 0x80)))
        ends = np.cumsum(self.sizes)
        self.chars = lead[ends] - lead[ends - self.sizes]

    @staticmethod
    def _equal(data, start, size, same) -> bool:
        """Whether every chunk has the bytes of the one that stands for it."""
        if not (size[same] == size).all():
            return False
        at = np.arange(len(data)) - np.repeat(start, size)
        return bool((data == data[np.repeat(start[same], size) + at]).all())

    def strings(self, which: np.ndarray) -> list[str]:
        end = np.cumsum(self.chars)
        return [self.text[b - n:b] for n, b in zip(self.chars[which].tolist(), end[which].tolist())]


class Merger:
    """Merges the chunks of a slice in step: in each round every chunk merges its best pair."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.of_char = np.full(0x110000, -1, np.int32)
        pairs = []
        for p, i in model.id.items():
            if len(p) == 1:
                self.of_char[ord(" " if p == SPACE else p)] = i
            pairs += [(model.id[p[:k]], model.id[p[k:]], i) for k in range(1, len(p))
                      if p[:k] in model.id and p[k:] in model.id]
        a, b, i = (np.array(x, np.int64) for x in zip(*pairs))
        self.pairs = HashTable(self._code(a, b), i)
        score = np.array([model.rank.get(p, 0) for p in model.pieces])
        #: place by score, equal scores alike; the last entry is that of no pair
        self.rank = np.append(np.unique(score, return_inverse=True)[1], _NONE).astype(np.int32)
        self.byte_id = np.array([model.byte_id.get(b, model.unknown) for b in range(256)], np.int32)

    @staticmethod
    def _code(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint32).astype(np.uint64)

    def merge(self, chunks: Distinct) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the distinct chunks one after another: the tokens' ids (-1: a character that is
        no piece) and characters; and the number of tokens of each chunk."""
        ids = self.of_char[chunks.points]
        first = np.cumsum(chunks.chars) - chunks.chars
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        low = 0
        for high in (2, 4, 6, 8, 10, 12, 16, 24, 40, SHORT):
            of = np.flatnonzero((chunks.chars > low) & (chunks.chars <= high))
            low = high
            if len(of):
                parts.append((of, *self._merge_group(ids, first[of], chunks.chars[of], high)))
        of = np.flatnonzero(chunks.chars > low)
        if len(of):
            got = [self.model.segment(s.replace(" ", SPACE)) for s in chunks.strings(of)]
            flat = [p for g in got for p in g]
            parts.append((of, np.array([self.model.id.get(p, -1) for p in flat], np.int32),
                          np.array([len(p) for p in flat], np.int32), np.array([len(g) for g in got])))
        if not parts:
            return ids, ids, chunks.chars
        order, sizes = np.concatenate([p[0] for p in parts]), np.concatenate([p[3] for p in parts])
        back = np.argsort(order)
        return (gathered(np.concatenate([p[1] for p in parts]), sizes, back),
                gathered(np.concatenate([p[2] for p in parts]), sizes, back), sizes[back])

    def _merge_group(self, ids, first, chars, width):
        """Chunks of at most ``width`` characters, as rows of a matrix with linked columns."""
        n, grid = len(first), np.arange(width)
        inside = grid < chars[:, None]
        token = np.full((n, width + 1), -2, np.int32)
        token[:, :width][inside] = ids[(first[:, None] + grid)[inside]]
        after = np.broadcast_to(np.append(grid + 1, width).astype(np.int8 if width < 127 else np.int32), (n, width + 1)).copy()
        before = np.broadcast_to(np.append(grid - 1, width).astype(after.dtype), (n, width + 1)).copy()
        made = np.full((n, width + 1), -1, np.int32)
        flat = self.pairs.get(self._code(token[:, :-1].ravel(), token[:, 1:].ravel()))
        made[:, :width] = flat.reshape(n, width)
        rank = self.rank[made]
        alive = np.append(inside, np.zeros((n, 1), bool), axis=1)
        done = np.arange(n)  # matrix row of each active row
        while True:
            k = rank.argmin(axis=1)
            live = np.flatnonzero(rank[np.arange(len(rank)), k] != _NONE)
            if not len(live):
                break
            if len(live) < 0.7 * len(rank):  # go on with the rows that still merge
                if len(rank) < n:
                    token_all[done], alive_all[done] = token, alive
                else:
                    token_all, alive_all = token, alive
                done = done[live]
                token, alive, rank, made = token[live], alive[live], rank[live], made[live]
                after, before, k = after[live], before[live], k[live]
                live = np.arange(len(live))
            else:
                k = k[live]
            j = after[live, k]
            jj, p = after[live, j], before[live, k]
            new = made[live, k]
            token[live, k] = new
            alive[live, j] = False
            after[live, k] = jj
            before[live, jj] = k
            rank[live, j] = _NONE
            right = self.pairs.get(self._code(new, token[live, jj]))
            made[live, k], rank[live, k] = right, self.rank[right]
            left = self.pairs.get(self._code(token[live, p], new))
            left[p < 0] = -1
            left[p == width] = -1
            made[live, p], rank[live, p] = left, self.rank[left]
            rank[live, width] = _NONE
            before[live, width] = width
        if len(rank) < n:
            token_all[done], alive_all[done] = token, alive
            token, alive = token_all, alive_all
        row, column = np.nonzero(alive)
        counts = np.bincount(row, minlength=n)
        stop = np.append(column[1:], 0)
        last = np.cumsum(counts) - 1
        stop[last] = chars
        return token[row, column], (stop - column).astype(np.int32), counts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all texts one after another: ids and end byte of each token in its text (white
        space being one byte); and the number of tokens of each text."""
        chunks = Distinct(self.model, texts)
        ids, chars, tokens = self.merge(chunks)
        width = 1 + (chunks.points > 0x7F) + (chunks.points > 0x7FF) + (chunks.points > 0xFFFF)
        ends = np.concatenate(([0], np.cumsum(width)))[np.cumsum(chars)]
        under = np.diff(ends, prepend=0)
        odd = ids < 0
        if odd.any():  # bytes of characters that are no pieces; the last one carries the span
            many = np.where(odd, under, 1)
            spread = np.repeat(np.arange(len(ids)), many)
            place = np.arange(len(spread)) - np.repeat(np.cumsum(many) - many, many)
            fall = odd[spread]
            flat = ids[spread]
            flat[fall] = self.byte_id[chunks.data[(ends - under)[spread][fall] + place[fall]]]
            under = np.where(place == many[spread] - 1, under[spread], 0)
            running = np.concatenate(([0], np.cumsum(many)))
            stop = np.cumsum(tokens)
            tokens = running[stop] - running[stop - tokens]
            ids = flat
        index = chunks.index
        flat = gathered(ids, tokens, index)
        spans = np.cumsum(gathered(under, tokens, index))
        running = np.concatenate(([0], np.cumsum(tokens[index])))
        cut = np.cumsum(chunks.per_text)
        n = running[cut] - running[cut - chunks.per_text]
        done = np.concatenate(([0], spans))[np.cumsum(n) - n]
        return flat, (spans - np.repeat(done + 1, n)).astype(np.int32), n


class Encoder:
    """Ids and source spans of texts, and texts of ids."""

    def __init__(self, blob: bytes):
        self.model = PieceModel(blob)
        self.merger = Merger(self.model) if self.model.simple else None
        self.surface = np.frombuffer(b"".join(self.model.surface), np.uint8)
        self.sizes = np.array([len(s) for s in self.model.surface], np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of all texts one after another: ids, first byte and end byte of each token in its
        text; and the number of tokens of each text.

        With an identity normaliser a byte of the text is a byte of its tokens, and slices are
        encoded in step; other models, and texts that hold the white-space sign, go through
        the recorded alignment."""
        done: dict[int, tuple] = {}
        if self.merger:
            plain = [t if SPACE not in t else "" for t in texts]
            ids, end, n = self.merger.encode(plain)
            first = np.cumsum(n) - n
            begin = np.concatenate(([0], end[:-1])).astype(np.int32)[:len(end)]
            begin[first[n > 0]] = 0
            if plain == texts:
                return ids, begin, end, n
            done = {i: (ids[a:a + k], begin[a:a + k], end[a:a + k])
                    for i, (a, k) in enumerate(zip(first, n)) if k}
        parts = [done.get(i) or np.array(self.model.encode(t), np.int32).reshape(-1, 3).T for i, t in enumerate(texts)]
        n = np.array([len(p[0]) for p in parts], np.int64)
        return (*(np.concatenate([p[k] for p in parts] or [np.zeros(0, np.int32)]) for k in range(3)), n)

    def decode(self, ids: np.ndarray, n: np.ndarray) -> pa.Array:
        """The texts of runs of ``n`` ids each: their surfaces joined."""
        data = gathered(self.surface, self.sizes, ids)
        ends = np.concatenate(([0], np.cumsum(self.sizes[ids])))
        stop = np.cumsum(n)
        begin, end = ends[stop - n], ends[stop]
        if self.model.dummy and not self.model.squeeze:
            lead = ids[np.minimum(stop - n, max(0, len(ids) - 1))] if len(ids) else np.zeros(len(n), np.int64)
            dummy = (n > 0) & (begin < end)
            dummy[dummy] = data[begin[dummy]] == 32
            if not any(self.model.types[i] == CONTROL for i in np.unique(lead[n > 0])):
                keep = np.ones(len(data), bool)
                keep[begin[dummy]] = False
                offsets = np.concatenate(([0], np.cumsum((end - begin) - dummy))).astype(np.int32)
                raw = data[keep].tobytes()
                got = pa.Array.from_buffers(pa.string(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
                try:
                    got.validate(full=True)
                    return got
                except pa.ArrowInvalid:  # byte tokens that are no characters
                    pass
        flat = ids.tolist()
        return pa.array([self.model.decode(flat[b - k:b]) for b, k in zip(stop.tolist(), n.tolist())], pa.string())


class Prefixes:
    """Token counts of every prefix of the chunks of a slice.

    Chunks of one prefix share its entry: the table is a tree of distinct prefixes, filled by
    length. The last token of a prefix is the longest piece ending there that may follow the
    last token of the prefix before it."""

    def __init__(self, blob: bytes):
        self.model = model = PieceModel(blob)
        if not (model.identity and model.dummy and SPACE in model.id):
            raise ValueError("prefix counts need an identity normaliser with a dummy prefix")
        self.chunks = Chunks(model)
        self.of_char = Merger(model).of_char
        plain = {p.replace(SPACE, " "): i for p, i in model.id.items()}
        reached = [(p, i) for p, i in plain.items() if self.chunks.split(p)]
        self.by_text = {i: p for p, i in plain.items()}
        self.longest = max(len(p) for p, _ in reached)
        points = np.frombuffer("".join(p for p, _ in reached).encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(p) for p, _ in reached])
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self._terms(points, np.arange(len(points))), dtype=np.uint64)))
        size = np.diff(ends, prepend=0)
        self.pieces = HashTable(self._hash(total, ends - size, ends), np.array([i for _, i in reached]))
        self.codes, self.verdicts = np.zeros(0, np.uint64), np.zeros(0, bool)

    _UP, _DOWN = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)

    def _terms(self, points: np.ndarray, at: np.ndarray) -> np.ndarray:
        return mix(points.astype(np.uint64) + np.uint64(1)) * self._power(self._UP, int(at.max(initial=0)) + 1)[at]

    def _hash(self, total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        down = self._power(self._DOWN, int(start.max(initial=0)) + 1)
        return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))

    def _power(self, base: int, n: int) -> np.ndarray:
        p = np.full(n, base, np.uint64)
        p[0] = 1
        return np.cumprod(p, dtype=np.uint64)

    def _follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether token b may follow token a, by id."""
        code = Merger._code(a, b)
        at = np.minimum(np.searchsorted(self.codes, code), max(0, len(self.codes) - 1))
        known = self.codes[at] == code if len(self.codes) else np.zeros(len(code), bool)
        out = np.zeros(len(code), bool)
        out[known] = self.verdicts[at[known]]
        if not known.all():
            new, back = np.unique(code[~known], return_inverse=True)
            text = self.by_text
            got = np.array([self.fresh[c] if c in self.fresh else self.fresh.setdefault(
                c, self.chunks.follows(text[c >> 32], text[c & 0xFFFFFFFF])) for c in new.tolist()], bool)
            out[~known] = got[back]
        return out

    def _remember(self) -> None:
        if self.fresh:
            codes = np.concatenate((self.codes, np.array(list(self.fresh), np.uint64)))
            verdicts = np.concatenate((self.verdicts, np.array(list(self.fresh.values()), bool)))
            order = np.argsort(codes)
            if len(order) > PAIR_ENTRIES:
                order = order[:0]
            self.codes, self.verdicts = codes[order], verdicts[order]

    def tables(self, chunks: Distinct) -> np.ndarray:
        """Of the distinct chunks one after another: the token counts of their prefixes of
        one character, two, ..."""
        self.fresh: dict[int, bool] = {}
        m, points, chars = self.model, chunks.points, chunks.chars
        first = np.cumsum(chars) - chars
        out = np.zeros(len(points), np.int32)
        within = np.arange(len(points)) - np.repeat(first, chars)
        short = chars <= SHORT
        cost_of = np.ones(len(points), np.int32)
        ids = self.of_char[points]
        odd = ids < 0
        if m.fallback:
            cost_of[odd] = (1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))[odd]
        total = np.concatenate((np.zeros(1, np.uint64),
                                np.cumsum(self._terms(points, np.minimum(within, SHORT)), dtype=np.uint64)))
        node = np.zeros(len(chars), np.int64)  # of each chunk, its prefix's entry in the level before
        levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # parent, last token, count
        for j in range(1, int(chars[short].max(initial=0)) + 1):
            of = np.flatnonzero(short & (chars >= j))
            at = first[of]
            _, pick, entry = np.unique(self._prefix(total, at, j), return_index=True, return_inverse=True)
            parent = node[of[pick]]
            node[of] = entry
            begin, size = at[pick], len(pick)
            last = ids[begin + j - 1].copy()  # a single character, unless a longer token fits
            ancestor, chain = parent, [parent]
            for back in range(2, min(j, self.longest) + 1):
                ancestor = levels[j - back][0][ancestor]
                chain.append(ancestor)
            count = np.zeros(size, np.int32)
            todo = np.arange(size)
            for n in range(min(j, self.longest), 1, -1):
                start = begin[todo] + (j - n)
                piece = self.pieces.get(self._local_hash(total, start, start + n, j - n))
                found = np.flatnonzero(piece >= 0)
                if not len(found):
                    continue
                rows, piece = todo[found], piece[found]
                if n < j:
                    before = levels[j - n - 1][1][chain[n - 1][rows]]
                    good = before < 0  # nothing merges with a character that is no piece
                    good[~good] = self._follow(before[~good], piece[~good])
                    rows, piece, found = rows[good], piece[good], found[good]
                    count[rows] = levels[j - n - 1][2][chain[n - 1][rows]] + 1
                else:
                    count[rows] = 1
                last[rows] = piece
                todo = np.delete(todo, found)
            if j > 1:
                base, prior = levels[j - 2][2][parent[todo]], levels[j - 2][1][parent[todo]]
            else:
                base, prior = 0, np.zeros(len(todo), np.int32)
            cost = cost_of[begin[todo] + j - 1]
            if not m.fallback:  # a run of unknown characters is one token
                cost = np.where((last[todo] < 0) & (prior < 0), 0, cost)
            count[todo] = base + cost
            levels.append((parent, last, count))
            out[at + j - 1] = count[entry]
        self._remember()
        long = np.flatnonzero(~short)
        strings = chunks.strings(long)
        order = sorted(range(len(long)), key=strings.__getitem__)
        for i, (_, count) in zip(order, self.chunks.solve([strings[i] for i in order])):
            out[first[long[i]]:first[long[i]] + chars[long[i]]] = count[1:]
        return out

    def _prefix(self, total: np.ndarray, at: np.ndarray, j: int) -> np.ndarray:
        return total[at + j] - total[at]

    def _local_hash(self, total, start, end, shift: int) -> np.ndarray:
        """Hash of characters that begin at place ``shift`` of their chunk."""
        down = np.uint64(pow(self._DOWN, shift, 1 << 64))
        return mix((total[end] - total[start]) * down + (end - start).astype(np.uint64))

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of all texts one after another: entry k of a text counts the tokens of its first
        k + 1 characters; and the number of characters of each text."""
        chunks = Distinct(self.model, texts)
        flat = self.tables(chunks)
        sizes, index = chunks.chars, chunks.index
        total = flat[np.cumsum(sizes) - 1]
        values = gathered(flat, sizes, index).astype(np.int64)
        before = np.concatenate(([0], np.cumsum(total[index], dtype=np.int64)))
        chars = sizes[index]
        cut = np.cumsum(chunks.per_text)
        values += np.repeat(before[:-1] - np.repeat(before[cut - chunks.per_text], chunks.per_text), chars)
        ends = np.concatenate(([0], np.cumsum(chars)))
        n = ends[cut] - ends[cut - chunks.per_text]
        keep = np.ones(len(values), bool)
        keep[(np.cumsum(n) - n)[n > 0]] = False  # the dummy prefix
        return values[keep].astype(np.int32), np.maximum(n - 1, 0)


_loaded: dict[tuple[type, int], object] = {}


def loaded(kind: type, blob: bytes):
    """One ``Encoder`` or ``Prefixes`` per worker process and model."""
    key = (kind, hash(blob))
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = kind(blob)
    return _loaded[key]
