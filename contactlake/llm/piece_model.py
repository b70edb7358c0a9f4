"""A SentencePiece BPE model in plain Python: normaliser, segmentation, decoder.

The model file is parsed once; nothing of the sentencepiece encoder is called. This module
works on one text at a time and defines the results; ``piece_batch`` does whole slices.
"""
from __future__ import annotations

import heapq
import re
import struct

from sentencepiece import sentencepiece_model_pb2 as proto

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
#: token pairs that a worker remembers; characters beyond which merging takes a heap
PAIR_ENTRIES, SHORT = 400_000, 64
NEVER = float("inf")
#: lengths of pieces shorter than a tail of so many characters
SHORTER = ((), (), (), (2,), (3, 2))


class CharsMap:
    """The compiled character map: a double-array trie whose values point at replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if size else ()
        self.texts = blob[4 + size:]

    @staticmethod
    def _jump(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[bytes, int]:
        """Replacement of the longest prefix of ``data[at:]`` in the map, and its length;
        without one, the next character as it is."""
        best, length = -1, 0
        if self.units:
            node = self._jump(self.units[0])
            for i in range(at, len(data)):
                node ^= data[i]
                if node >= len(self.units):
                    break
                unit = self.units[node]
                if unit & 0x800000FF != data[i]:
                    break
                node ^= self._jump(unit)
                if unit >> 8 & 1:
                    best, length = self.units[node] & 0x7FFFFFFF, i + 1 - at
        if length:
            return self.texts[best:self.texts.index(b"\0", best)], length
        first = data[at]
        n = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return data[at:at + n], n


class PieceModel:
    def __init__(self, blob: bytes):
        m = proto.ModelProto()
        m.ParseFromString(blob)
        if m.trainer_spec.model_type != BPE:
            raise ValueError("only BPE models are supported")
        if any(p.type in (USER_DEFINED, UNUSED) for p in m.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        if m.trainer_spec.treat_whitespace_as_suffix or not m.normalizer_spec.escape_whitespaces:
            raise ValueError("white space must be escaped and stand before a word")
        spec = m.normalizer_spec
        self.dummy, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.chars = CharsMap(spec.precompiled_charsmap)
        self.identity = not self.chars.units and not self.squeeze
        self.types = [p.type for p in m.pieces]
        self.pieces = [p.piece for p in m.pieces]
        self.id = {p.piece: i for i, p in enumerate(m.pieces) if p.type == NORMAL}
        self.rank = {p.piece: -p.score for p in m.pieces if p.type == NORMAL}
        self.longest = max(map(len, self.id))
        self.unknown = self.types.index(UNKNOWN)
        self.byte_id = {int(p.piece[1:-1], 16): i for i, p in enumerate(m.pieces) if p.type == BYTE}
        self.fallback = m.trainer_spec.byte_fallback and len(self.byte_id) == 256
        self.unk_text = m.trainer_spec.unk_surface.encode()
        #: no piece goes on with white space after other text, so a chunk begins there
        self.apart = not any(SPACE in p.lstrip(SPACE) for p in self.id)
        self.chunk = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if self.apart else "(?s:.+)")
        self.simple = self.identity and self.dummy and self.fallback and SPACE in self.id
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.surface = [self._surface(i) for i in range(len(self.pieces))]

    def _surface(self, i: int) -> bytes:
        kind = self.types[i]
        if kind == BYTE:
            return bytes([self.byte_of[i]])
        if kind in (CONTROL, UNKNOWN):
            return b"" if kind == CONTROL else self.unk_text
        return self.pieces[i].replace(SPACE, " ").encode()

    # -- normaliser ---------------------------------------------------------------------

    def normalise(self, text: str) -> tuple[str, list[int]]:
        """The normalised text, and for each of its characters (and its end) the byte of
        ``text`` that it comes from."""
        data = text.encode()
        out: list[str] = []
        source: list[int] = []
        at = 0
        if self.squeeze:
            while at < len(data):
                got, n = self.chars.longest(data, at)
                if got != b" ":
                    break
                at += n
        if at == len(data):
            return "", [at]
        if self.dummy:
            out.append(SPACE)
            source.append(at)
        after_space = self.squeeze
        while at < len(data):
            got, n = self.chars.longest(data, at)
            new = got.decode()
            if after_space:
                new = new.lstrip(" ")
            if new:
                after_space = self.squeeze and new.endswith(" ")
                new = new.replace(" ", SPACE)
                out.append(new)
                source.extend([at] * len(new))
            at += n
        norm = "".join(out)
        if self.squeeze:
            cut = len(norm.rstrip(SPACE))
            if cut < len(norm):
                at = source[cut]
                norm, source = norm[:cut], source[:cut]
        return norm, [*source, at]

    # -- segmentation -------------------------------------------------------------------

    def segment(self, chunk: str, stop: str | None = None) -> list[str]:
        """Merge the adjacent pair of best score, leftmost first, until none is a piece, or
        until the merge that would make ``stop``."""
        parts = list(chunk)
        if len(parts) > SHORT:
            return self._segment_long(parts)
        rank = self.rank.get
        pairs = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = min(pairs)
            if best == NEVER:
                break
            i = pairs.index(best)
            if parts[i] + parts[i + 1] == stop:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], NEVER)
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], NEVER)
        return parts

    def _segment_long(self, parts: list[str]) -> list[str]:
        """The same with a heap, for chunks of any length."""
        n, rank = len(parts), self.rank.get
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0 and (r := rank(parts[left] + parts[right])) is not None:
                heapq.heappush(heap, (r, left, right, parts[left] + parts[right]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, left, right, joined = heapq.heappop(heap)
            if not parts[left] or not parts[right] or parts[left] + parts[right] != joined:
                continue
            parts[left], parts[right] = joined, ""
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [p for p in parts if p]

    def tokens(self, piece: str) -> list[int]:
        """Ids of one segmented piece; unknown characters fall back to bytes."""
        if (i := self.id.get(piece)) is not None:
            return [i]
        return [self.byte_id[b] for b in piece.encode()] if self.fallback else [self.unknown]

    def encode(self, text: str) -> list[tuple[int, int, int]]:
        """Id, first byte and end byte in ``text`` of each token, through the alignment that
        the normaliser records."""
        norm, source = self.normalise(text)
        rows: list[tuple[int, int, int]] = []
        at = 0
        for chunk in self.chunk.findall(norm):
            for p in self.segment(chunk):
                begin, end = source[at], source[at + len(p)]
                at += len(p)
                got = self.tokens(p)
                if got == [self.unknown] and rows and rows[-1][0] == self.unknown:
                    rows[-1] = (self.unknown, rows[-1][1], end)  # a run of unknowns is one token
                    continue
                rows += [(i, begin, begin) for i in got[:-1]] + [(got[-1], begin, end)]
        return rows

    def decode(self, ids) -> str:
        """The text of ``ids``: bytes are joined, invalid ones become U+FFFD, and the white
        space of the dummy prefix goes."""
        ids = list(ids)
        parts = [self.surface[i] for i in ids]
        if self.dummy or self.squeeze:
            for k, i in enumerate(ids):
                if self.types[i] == CONTROL:
                    continue
                if self.types[i] == NORMAL and parts[k].startswith(b" "):
                    parts[k] = parts[k].lstrip(b" ") if self.squeeze else parts[k][1:]
                    if self.squeeze and not parts[k]:
                        continue
                break
        try:
            return b"".join(parts).decode()
        except UnicodeDecodeError:
            return self._decode_runs(ids, parts)

    def _decode_runs(self, ids: list[int], parts: list[bytes]) -> str:
        out, run = [], bytearray()
        for i, p in zip([*ids, -1], [*parts, b""]):
            if i >= 0 and self.types[i] == BYTE:
                run += p
                continue
            at = 0
            while at < len(run):  # one invalid byte becomes one replacement character
                for n in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[at:at + n]).decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    n = 1
                at += n
            run.clear()
            out.append(p.decode())
        return "".join(out)


class Chunks:
    """Segmentation of many chunks at once, by dynamic programming over prefixes.

    The last token of a prefix is the one piece ending there that may follow the last token
    of the prefix before it; two tokens may follow each other if merging their joined text
    gives just these two. The table of a prefix depends on the prefix alone, so sorted
    chunks reuse the rows of the prefix that they share with the chunk before.
    """

    def __init__(self, model: PieceModel):
        self.model = model
        #: ids of the pieces, written with plain spaces (short ASCII strings are faster)
        self.id = {p.replace(SPACE, " "): i for p, i in model.id.items()}
        chars = sorted(p for p in self.id if len(p) == 1)
        merged = sorted((p for p in self.id if len(p) > 1),
                        key=lambda p: model.rank[p.replace(" ", SPACE)])
        #: order in which tokens come to be: characters, then pieces by score
        self.order = {p: i for i, p in enumerate(chars + merged)}
        self.halves: dict[str, tuple[str, str] | None] = {}
        self.known_pairs: dict[tuple[str, str], bool] = {}
        lengths: dict[str, set[int]] = {}
        for p in merged:
            for tail in {p[-4:], p[-3:], p[-2:]}:
                lengths.setdefault(tail, set()).add(len(p))
        #: by a text's last four characters (or all of two or three), the lengths of the
        #: longer pieces that end so, then the shorter lengths
        self.lengths = {k: (*sorted((n for n in v if n >= len(k)), reverse=True),
                            *range(len(k) - 1, 1, -1)) for k, v in lengths.items()}

    def split(self, piece: str) -> tuple[str, str] | None:
        """The two tokens whose merge makes ``piece``; a character has itself twice, a piece
        that merging never reaches has None."""
        if piece not in self.halves:
            self.halves[piece] = self._split(piece)
        return self.halves[piece]

    def _split(self, piece: str) -> tuple[str, str] | None:
        if len(piece) == 1:
            return piece, piece
        if self._merged(piece) != [piece]:
            return None
        left, right = self._merged(piece, stop=piece)
        return left, right

    def _merged(self, text: str, stop: str | None = None) -> list[str]:
        stop = stop and stop.replace(" ", SPACE)
        return [p.replace(SPACE, " ") for p in self.model.segment(text.replace(" ", SPACE), stop)]

    def follows(self, a: str, b: str) -> bool:
        """Whether ``a + b`` is segmented into these two tokens (each a reachable token)."""
        key = (a, b)
        got = self.known_pairs.get(key)
        if got is None:
            if len(self.known_pairs) >= PAIR_ENTRIES:
                self.known_pairs.clear()
            if a[-1] == b[0] == " ":  # runs of white space have pieces of equal score
                got = self._merged(a + b) == [a, b]
            else:
                got = self._stable(a, b)
            self.known_pairs[key] = got
        return got

    def _stable(self, a: str, b: str) -> bool:
        """No merge across the border comes before the merges beside it: walk these back,
        the later one first."""
        order, split = self.order, self.split
        limit = len(order)
        while True:
            if order.get(a + b, limit) < limit:
                return False
            left, right = order.get(a, -1), order.get(b, -1)
            if left > right:
                limit, after = left, split(a)[1]
                if after != a:
                    a = after
                    continue
                limit, after = right + 1, split(b)[0]
                if after == b:
                    return True
                b = after
            else:
                limit, after = right + 1, split(b)[0]
                if after != b:
                    b = after
                    continue
                limit, after = left, split(a)[1]
                if after == a:
                    return True
                a = after

    def solve(self, chunks):
        """For each of the sorted ``chunks``: the last token and the token count of each of
        its prefixes (entry 0: the empty prefix). The lists are reused for the next chunk."""
        known, fallback, follows, split = self.id, self.model.fallback, self.follows, self.split
        lengths, halves = self.lengths, self.halves
        before, last, count = "", [""], [0]
        for chunk in chunks:
            k = 0
            for x, y in zip(before, chunk):
                if x != y:
                    break
                k += 1
            del last[k + 1:], count[k + 1:]
            for j in range(k + 1, len(chunk) + 1):
                for n in lengths.get(chunk[j - 4:j] if j > 3 else chunk[:j], SHORTER[min(j, 4)]):
                    if n > j:
                        continue
                    piece = chunk[j - n:j]
                    if piece in known and (halves.get(piece) or split(piece)) and (
                            n == j or follows(last[j - n], piece)):
                        cost = 1
                        break
                else:
                    n, piece = 1, chunk[j - 1]
                    if piece in known:
                        cost = 1
                    elif fallback:
                        cost = len(piece.encode())
                    else:  # a run of unknown characters is one token
                        cost = int(j == 1 or last[j - 1] in known)
                last.append(piece)
                count.append(count[j - n] + cost)
            before = chunk
            yield last, count
