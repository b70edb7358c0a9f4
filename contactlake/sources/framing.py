"""Documents and rows of landed text files, whatever lines and scan splits they cross.

A text file is read by lines and split inside. Whether a line begins inside a document (JSON)
or inside a quoted cell (CSV) follows from everything before it, so the readers work like a
prefix scan over blocks:

1. every scan split sums up what its lines do to *any* state they might begin in (a few
   numbers: brackets closed and opened, quotes left open);
2. the driver folds these sums along each file, one small row per split, and so knows the
   state and the line number at which each split begins;
3. every split cuts its lines into units (documents, elements of a page, rows). Units that
   cross splits leave fragments, which are put together by a shuffle of the fragments alone,
   and only when step 2 found a split that begins inside a unit.

A line's number counts the lines of all files before it in name order, so the position of a
record depends neither on split sizes nor on cores.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: a record that spans more bytes than this over several lines is no record: its lines are
#: kept one by one, as malformed ones
RECORD_BYTES = 16 << 20
#: bits of ``ingest_seq`` for the place inside a line; the line's number takes the rest
PLACE_BITS = 29

_STRING = re.compile(r'"(?:[^"\\]|\\.)*"')
_RESULTS = re.compile(r'"results"\s*:\s*\[')
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]\x01]')
_SCALAR = re.compile(r'(?:"(?:[^"\\]|\\.)*"|[^,])+')
_NOT_BRACKETS = re.compile(r"[^{}\[\]\x01]+")
#: the next bracket outside of strings, or the end, of a text whose strings are closed and have no escapes
_BRACKET = re.compile(r'(?:[^"{}\[\]\x01]++|"[^"]*+")*+([{}\[\]\x01]|\Z)')
#: lines without brackets and escapes whose strings are closed
_PLAIN = r'^(?:[^"{}\[\]\\\x01]*"[^"{}\[\]\\\x01]*")*[^"{}\[\]\\\x01]*$'
_OPENERS = "{[\x01"

UNIT = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("kind", T.StringType()),
    T.StructField("line", T.LongType()), T.StructField("at", T.LongType()),
    T.StructField("opens", T.BooleanType()), T.StructField("whole", T.BooleanType()),
    T.StructField("size", T.LongType()), T.StructField("last", T.LongType()), T.StructField("doc", T.StringType())])
_SUMMARY = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("lines", T.LongType()), T.StructField("closes", T.LongType()),
    T.StructField("opens", T.LongType()), T.StructField("kinds", T.StringType()),
    T.StructField("reset", T.BooleanType()), T.StructField("begins", T.BooleanType()),
    T.StructField("last", T.StringType())])


def line_columns() -> list[Column]:
    """The columns ``framed`` needs of a text read by lines."""
    return [F.make_valid_utf8("value").alias("value"), F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start")]


def ingest_seq(line: Column, at: Column) -> Column:
    """Position of a record in its batch as one number (lines first, then places in a line)."""
    return F.shiftleft(line, PLACE_BITS).bitwiseOR(F.least(at, F.lit((1 << PLACE_BITS) - 1)))


@dataclass
class State:
    """Open brackets: how many, and the kinds of the outer two ('{', '[', or the array of a
    page's results); ``last`` is the last sign that is no white space. For CSV ``depth`` is 1
    inside a quoted cell."""
    depth: int = 0
    kinds: str = ""
    last: str = ""


class Effect(NamedTuple):
    """What lines do to a state: ``closes`` brackets, then ``opens`` ones (``kinds`` of the
    first two); ``reset``: the state before is forgotten. ``begins``: the first line may only
    follow a sign after which a value can stand, else it begins a document of its own."""
    closes: int = 0
    opens: int = 0
    kinds: str = ""
    reset: bool = False
    begins: bool = False
    last: str = ""
    lines: int = 0

    def then(self, other: "Effect") -> "Effect":
        if other.reset or (other.begins and not may_follow(self.last) and self.last):
            out = other._replace(reset=True)
        elif other.closes >= self.opens:
            out = other._replace(closes=self.closes + other.closes - self.opens, reset=self.reset)
        else:
            left = self.opens - other.closes
            out = Effect(self.closes, left + other.opens, (self.kinds[:left] + other.kinds)[:2], self.reset, last=other.last)
        return out._replace(begins=self.begins if self.last else other.begins, last=other.last or self.last,
                            lines=self.lines + other.lines)

    def on(self, state: State) -> State:
        """The state after these lines."""
        if self.reset or (self.begins and state.last and not may_follow(state.last)):
            state = State()
        left = max(0, state.depth - self.closes)
        return State(left + self.opens, (state.kinds[:left] + self.kinds)[:2], self.last or state.last)


#: of effects without lines: documents of one layout have few of them
_then = lru_cache(maxsize=1 << 14)(Effect.then)


def may_follow(last: str) -> bool:
    """Whether a value may stand after this sign inside a document."""
    return last in (",", "[", ":")


class Json:
    """Lines of JSON: one document a line, several on a line, documents over many lines.

    Strings cannot hold line breaks, so a line never begins inside one. Three faults end the
    document they stand in, and the next line begins anew: a string that is not closed on its
    line, a line that opens a value where none can stand, and the end of the file."""

    @staticmethod
    def brackets(line: str) -> tuple[str, bool]:
        """The line's brackets outside of strings (an array of results has a sign of its own),
        and whether a string is left open."""
        marked = _RESULTS.sub("\x01", line)
        if "\\" not in line:  # quotes pair up
            parts = marked.split('"')
            return _NOT_BRACKETS.sub("", "".join(parts[::2])), len(parts) % 2 == 0
        bare = _STRING.sub("", marked)
        return _NOT_BRACKETS.sub("", bare), '"' in bare

    @staticmethod
    def plain(lines: pa.Array) -> np.ndarray:
        """Which lines have only scalars, so that they change nothing but the last sign."""
        plain = pc.and_(pc.match_substring_regex(lines, _PLAIN), pc.match_substring_regex(lines, "[!-~]"))
        return plain.to_numpy(zero_copy_only=False).astype(bool)

    @staticmethod
    def unmatched(brackets: str) -> tuple[int, str]:
        """Brackets closed that the line did not open, and those opened and not closed."""
        size = -1
        while size != len(brackets):
            size = len(brackets)
            brackets = brackets.replace("{}", "").replace("[]", "").replace("\x01]", "")
        closes, opens = 0, ""
        for b in brackets:
            if b in _OPENERS:
                opens += b
            elif opens:  # of another kind: the document will not parse
                opens = opens[:-1]
            else:
                closes += 1
        return closes, opens

    @classmethod
    def effect(cls, line: str) -> Effect:
        text = line.strip()
        if not text:
            return Effect(lines=1)
        brackets, torn = cls.brackets(line)
        begins = text[0] in "{["
        if torn:
            return Effect(reset=True, begins=begins, last="\n", lines=1)
        closes, opens = cls.unmatched(brackets)
        return Effect(closes, len(opens), opens[:2], False, begins, text[-1], 1)

    @classmethod
    def fold(cls, total: Effect, lines: pa.Array) -> Effect:
        """These lines after others. Of plain lines that follow each other the last one counts."""
        plain = cls.plain(lines)
        some = np.flatnonzero(~plain | ~np.append(plain[1:], False))
        out = total._replace(lines=0)
        for line, simple in zip(lines.take(pa.array(some)).to_pylist(), plain[some].tolist()):
            effect = Effect(last=line.strip()[-1]) if simple else _effect(line) if len(line) < 64 else cls.effect(line)
            out = _then(out, effect._replace(lines=0) if effect.lines else effect)
        return out._replace(lines=total.lines + len(lines))

    @classmethod
    def alone(cls, text: str, brackets: str) -> bool:
        """Whether a text of these brackets is exactly one value in brackets."""
        return text[0] + text[-1] in ("{}", "[]") and len(brackets) > 1 \
            and cls.unmatched(brackets[1:-1]) == (0, "")


@lru_cache(maxsize=1 << 14)
def _effect(line: str) -> Effect:
    """Of a short line: documents over many lines repeat those of brackets alone."""
    return Json.effect(line)._replace(lines=0)


class Csv:
    """Lines of CSV: a quote opens a cell only where the cell begins; inside it, two are one."""

    @staticmethod
    def ends_inside(line: str, inside: bool) -> bool:
        at = 0
        while True:
            if not inside:
                if line[at:at + 1] == '"':
                    inside, at = True, at + 1
            if inside:
                while True:
                    q = line.find('"', at)
                    if q < 0:
                        return True
                    at = q + 1
                    if line[at:at + 1] != '"':
                        break
                    at += 1
                inside = False
            comma = line.find(",", at)
            if comma < 0:
                return False
            at = comma + 1

    @classmethod
    def effect(cls, line: str) -> Effect:
        """As brackets of depth 1 at most: a line that ends inside whatever its beginning
        resets and opens one; one that ends outside resets; else the state is kept or turned."""
        if '"' not in line:
            return Effect(lines=1)
        out, inside = cls.ends_inside(line, False), cls.ends_inside(line, True)
        if out == inside:
            return Effect(reset=True, opens=int(out), lines=1)
        return Effect(closes=-1 if out else 0, lines=1)  # -1: inside and outside change places

    @classmethod
    def fold(cls, total: Effect, lines: pa.Array) -> Effect:
        for line in lines.to_pylist():
            total = Turns.then(total, cls.effect(line))
        return total


class Turns:
    """Effects of CSV lines: the state after them when they begin outside, and inside."""

    @staticmethod
    def then(a: Effect, b: Effect) -> Effect:
        pair = [Turns.after(b, Turns.after(a, s)) for s in (0, 1)]
        if pair[0] == pair[1]:
            return Effect(opens=pair[0], reset=True, lines=a.lines + b.lines)
        return Effect(closes=-1 if pair[0] else 0, lines=a.lines + b.lines)

    @staticmethod
    def after(e: Effect, state: int) -> int:
        return e.opens if e.reset else 1 - state if e.closes < 0 else state


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array]]:
    """(file, start, lines) of each run of lines of one scan split, in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values, files, starts = batch.columns[:3]
        other = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(starts[1:], starts[:-1]))
        cuts = np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1
        for first, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)]):
            yield files[first].as_py(), starts[first].as_py(), values[first:end]


def summaries(lines: DataFrame, kind: str) -> list:
    """Step 1: one row per scan split."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Json if kind == "json" else Csv
        at, total = None, Effect()

        def row() -> pa.RecordBatch:
            values = [*at, total.lines, total.closes, total.opens, total.kinds, total.reset, total.begins, total.last]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], _SUMMARY.names)

        for file, start, values in _pieces(batches):
            if at != (file, start):
                if at is not None:
                    yield row()
                at, total = (file, start), Effect()
            total = machine.fold(total, values)
        if at is not None:
            yield row()

    return lines.mapInArrow(run, _SUMMARY).collect()


def begins(rows: list, kind: str) -> tuple[dict[tuple[str, int], tuple[int, State]], set[str]]:
    """Step 2: the number of the first line of each split, and the state it begins in; and the
    files in which a split ends inside a unit."""
    out, number, file, state, across = {}, 0, None, State(), set()
    for r in sorted(rows, key=lambda r: (r["file"], r["start"])):
        if r["file"] != file:
            file, state = r["file"], State()
        effect = Effect(r["closes"], r["opens"], r["kinds"], r["reset"], r["begins"], r["last"], r["lines"])
        out[file, r["start"]] = (number, state)
        number += r["lines"]
        state = effect.on(state) if kind == "json" else State(Turns.after(effect, state.depth))
        if state.depth:
            across.add(file)
    return out, across


@dataclass
class Fragment:
    """What a split holds of a unit that is not closed: where it begins, whether the unit begins
    there, its texts, the characters of the unit so far and the line of the last text.
    ``spilled``: the unit is too long, and its lines went out one by one."""
    line: int
    at: int
    opens: bool
    last: int
    texts: list[str] = field(default_factory=list)
    size: int = 0
    spilled: bool = False


class Units:
    """Step 3: the units of the lines of one split, as rows of ``UNIT``."""

    def __init__(self, file: str, number: int, state: State, first: bool):
        self.file, self.number, self.state, self.first = file, number, state, first
        self.rows: list[tuple] = []
        self.open: dict[str, Fragment] = {}

    def text(self, line: int, at: int, doc: str, kind: str = "line") -> None:
        """A unit within a line."""
        if doc.strip():
            self.rows.append((self.file, kind, line, at, True, True, len(doc), line, doc))

    def begin(self, kind: str, line: int, at: int) -> None:
        self.open[kind] = Fragment(line, at, True, line)

    def add(self, kind: str, line: int, at: int, text: str) -> None:
        """More text of a unit, after the line breaks since its last text."""
        f = self.open.setdefault(kind, Fragment(line, 0, False, line))
        f.size += len(text)
        if f.spilled:
            self.text(line, at, text)
            return
        f.texts.append("\n" * (line - f.last) + text)
        f.last = line
        if f.size > RECORD_BYTES and f.opens:
            for k, x in enumerate("".join(f.texts).split("\n")):
                self.text(f.line + k, 0 if k else f.at, x)
            f.texts, f.spilled = [], True
        elif f.size > RECORD_BYTES:  # not to be held: goes on in another fragment
            self._hand_on(kind)

    def close(self, kind: str) -> None:
        f = self.open.pop(kind)
        doc = "".join(f.texts)
        if not f.opens:
            self.rows.append((self.file, kind, f.line, f.at, False, False, f.size, f.last, doc))
        elif not f.spilled:
            self.text(f.line, f.at, doc, kind)

    def _hand_on(self, kind: str) -> None:
        f = self.open[kind]
        if f.opens or f.texts:
            self.rows.append((self.file, kind, f.line, f.at, f.opens, False, f.size, f.last, "".join(f.texts)))
        self.open[kind] = Fragment(f.last, 1 << 40, False, f.last)

    def lines(self, values: pa.Array) -> None:
        for line in values.to_pylist():
            self.line(line)

    def finish(self) -> None:
        """The end of the split: what is open goes on in the next one."""
        for kind in self.open:
            self._hand_on(kind)


class JsonUnits(Units):
    """A document over several lines gives its elements (of an array, or of a page's results)
    one by one, and the object around them as its shell."""

    def line(self, line: str) -> None:
        n, state, text = self.number, self.state, line.strip()
        self.number += 1
        if not text:
            return
        if state.depth and text[0] in "{[" and not may_follow(state.last):
            self._end_document()
        paired = "\\" not in line and line.count('"') % 2 == 0
        brackets, torn = ("", False) if paired and state.depth else Json.brackets(line)
        if not state.depth and not torn and Json.alone(text, brackets):
            self.text(n, line.index(text[0]), text)
        else:
            self._walk(n, line, paired)
        state.last = text[-1]
        if torn:
            self._end_document()

    def lines(self, values: pa.Array) -> None:
        """Plain lines inside an element or a shell go to it together."""
        texts, plain = values.to_pylist(), Json.plain(values)
        turns = [0, *(np.flatnonzero(plain[1:] != plain[:-1]) + 1).tolist(), len(texts)]
        for first, end in zip(turns, turns[1:]):
            run, size = texts[first:end], 0
            f = self.open.get("shell" if self.state.depth < self._elements_at() else "element")
            if plain[first] and f and self.state.depth not in (0, self._elements_at()):
                size = sum(map(len, run))
            if not size or f.spilled or f.size + size > RECORD_BYTES:
                for line in run:
                    self.line(line)
                continue
            f.texts.append("\n" * (self.number - f.last) + "\n".join(run))
            f.size += size
            self.number += len(run)
            f.last = self.number - 1
            self.state.last = run[-1].strip()[-1]

    def _end_document(self) -> None:
        for kind in list(self.open):
            self.close(kind)
        self.state.depth, self.state.kinds = 0, ""

    def _elements_at(self) -> int:
        """The depth at which elements stand in this document; beyond any depth if nowhere."""
        kinds = self.state.kinds
        return 1 if kinds[:1] == "[" else 2 if kinds == "{\x01" else 1 << 40

    def _between(self, n: int, at: int, text: str) -> None:
        """Text that is inside no bracketed element: scalars, of a document or an array."""
        if not self.state.depth:
            self.text(n, at, text)
        elif self.state.depth == self._elements_at():
            for m in _SCALAR.finditer(text):
                self.text(n, at + m.start(), m.group().strip())
        elif text:
            self.add("shell" if self.state.depth < self._elements_at() else "element", n, at, text)

    def _walk(self, n: int, line: str, paired: bool) -> None:
        """``paired``: all strings are closed and have no escapes."""
        s, at = self.state, 0
        marked = _RESULTS.sub(lambda m: m.group()[:-1] + "\x01", line)
        for m in (_BRACKET if paired else _TOKEN).finditer(marked):
            sign, here = m.group(paired), m.start(paired)
            if not sign:
                break
            if sign[0] == '"' or not s.depth and sign in "}]":
                continue
            if sign in _OPENERS:
                if s.depth in (0, self._elements_at()):
                    self._between(n, at, line[at:here])
                    at = here
                    kind = "element" if s.depth else "shell"
                    if s.depth or sign == "{":
                        self.begin(kind, n, here)
                    else:  # an array: its elements only
                        at = here + 1
                s.depth += 1
                if s.depth <= 2:
                    s.kinds += "[" if s.depth == 1 and sign == "\x01" else sign
                if s.depth == 2 == self._elements_at():  # the shell stops inside the results
                    self.add("shell", n, at, line[at:here + 1])
                    at = here + 1
            else:
                if s.depth == self._elements_at():
                    self._between(n, at, line[at:here])
                    at = here + (s.depth == 1)  # the bracket of the results is the shell's
                    s.depth -= 1
                    s.kinds = s.kinds[:s.depth]
                    continue
                s.depth -= 1
                ended = "element" if s.depth == self._elements_at() else "" if s.depth else "shell"
                if ended:
                    self.add(ended, n, at, line[at:here + 1])
                    self.close(ended)
                    at = here + 1
                s.kinds = s.kinds[:s.depth]
        self._between(n, at, line[at:])


class CsvUnits(Units):
    """Rows of CSV, line breaks in quoted cells kept (as line feeds); the first row of a file
    is its header."""

    def line(self, line: str) -> None:
        n, quoted = self.number, '"' in line
        self.number += 1
        kind = "header" if self.first else "row"
        if self.state.depth:
            kind = next(iter(self.open), "row")
            self.add(kind, n, 0, line)
            if quoted and not Csv.ends_inside(line, True):
                self.close(kind)
                self.state.depth = 0
        elif quoted and Csv.ends_inside(line, False):
            self.begin(kind, n, 0)
            self.add(kind, n, 0, line)
            self.state.depth = 1
        else:
            self.text(n, 0, line, kind)
        if line.strip():
            self.first = False


def _units(lines: DataFrame, kind: str, known: dict, across: set[str] | None = None) -> DataFrame:
    """The whole units of all files, or the fragments of units of the files ``across``. Both
    scans are over the same files, so that both are split alike."""
    send = lines.sparkSession.sparkContext.broadcast((known, across))  # one entry for each scan split

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, at = None, None
        known, across = send.value
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.string())

        def ready() -> pa.RecordBatch:
            rows, units.rows = [r for r in units.rows if r[5] == (across is None)], []
            columns = zip(*rows) if rows else [[]] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], UNIT.names)

        for file, start, values in _pieces(batches):
            if across is not None and file not in across:
                continue
            if at != (file, start):
                if units:
                    units.finish()
                    yield ready()
                at = (file, start)
                number, state = known[at]
                units = (JsonUnits if kind == "json" else CsvUnits)(file, number, replace(state), start == 0)
            units.lines(values)
            yield ready()
        if units:
            units.finish()
            yield ready()

    return lines.mapInArrow(run, UNIT)


def framed(lines: DataFrame, kind: str) -> DataFrame:
    """``(file, line, at, doc)``: the documents (``kind`` "json") or rows ("csv") of text lines
    (``line_columns``), with the number of their first line over all files and their place in it.

    Nothing is dropped but white space, the punctuation around the elements of a document that
    spans lines, and CSV headers. A record over several lines and ``RECORD_BYTES`` is kept as
    its lines. The sums of the splits are taken when this is called, like a schema inference;
    the files are read once more by the query, and twice if a split begins inside a record."""
    known, across = begins(summaries(lines, kind), kind)
    out = _units(lines, kind, known).where("kind <> 'header'").select("file", "line", "at", "doc")
    return out.unionByName(_joined(_units(lines, kind, known, across))) if across else out


def _joined(units: DataFrame) -> DataFrame:
    """The units that left fragments, put together; those over ``RECORD_BYTES`` line by line."""
    order = Window.partitionBy("file", "kind").orderBy("line", "at")
    part = units.withColumn("unit", F.sum(F.col("opens").cast("int")).over(order))
    part = part.withColumn("size", F.sum("size").over(Window.partitionBy("file", "kind", "unit")))
    part = part.where("kind <> 'header'")

    def breaks(p, i):  # the line breaks since the fragment before
        since = F.when(i > 0, p["line"] - F.get("parts", i - 1)["last"]).otherwise(0)
        return F.repeat(F.lit("\n"), since.cast("int"))

    # the fragments of a unit that is too long stay alone: nothing holds them together
    alone = F.when(F.col("size") > RECORD_BYTES, F.struct("line", "at")).alias("alone")
    groups = part.groupBy("file", "kind", "unit", alone) \
        .agg(F.sort_array(F.collect_list(F.struct("line", "at", "last", "doc"))).alias("parts"))
    whole = F.struct(F.col("parts")[0]["line"].alias("line"), F.col("parts")[0]["at"].alias("at"),
                     F.array_join(F.transform("parts", lambda p, i: F.concat(breaks(p, i), p["doc"])), "").alias("doc"))
    lines = F.flatten(F.transform("parts", lambda p: F.filter(
        F.transform(F.split(p["doc"], "\n"), lambda x, k: F.struct(
            (p["line"] + k).alias("line"), F.lit(0).cast("long").alias("at"), x.alias("doc"))),
        lambda x: F.trim(x["doc"]) != "")))
    return groups.select("file", F.explode(F.when(F.col("alone").isNull(), F.array(whole)).otherwise(lines)).alias("u")) \
        .select("file", "u.line", "u.at", "u.doc")
