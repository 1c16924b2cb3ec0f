"""Whole records of one element from XML files that many tasks read.

Markup is told apart by state: text, comment, CDATA section, processing instruction, each inside or
outside a record. Splits are summed up for all eight (`splits`), and records are cut in the split
that closes them.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from firmloom.operators.ordinals import FILE, START
from firmloom.sources.splits import file_offsets, runs, split_maps, split_states, text_pieces, with_states

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What ends each kind of markup; text has none.
ENDS = (None, "-->", "]]>", "?>")
KINDS = {"<!--": 1, "<![CDATA[": 2, "<?": 3}
#: A state is twice the kind, and one more inside a record.
INSIDE = (1, 3, 5, 7)
PREFIX = r"(?:[\w.-]+:)?"
#: Header text kept while looking for its end.
HEADER_ROOM = 1 << 20
#: Pieces looked at together.
PIECES = 1000


class Markup:
    """Finds record tags in pieces of text."""

    def __init__(self, tag: str):
        self.tag, self.separator = tag, f"{tag}>"
        # the element's name is looked for, and what stands before and behind it then
        self.lead = re.compile(rf"<(/?){PREFIX}")
        self.rest = re.compile(r"""(?:[^"'<>]|"[^"]*"|'[^']*')*>""")

    def texts(self, values: pa.Array) -> Iterator[str]:
        """Pieces with the separators behind them, some together."""
        for at in range(0, len(values), PIECES):
            part = pc.fill_null(values.slice(at, PIECES), "")
            whole = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part.cast(pa.string()))
            yield pc.binary_join(whole, self.separator)[0].as_py() + self.separator

    def events(self, text: str, kind: int) -> tuple[list[tuple[str, int, int]], int]:
        """Record tags of pieces that start in `kind`, as (open, close or empty; from; to), and the
        kind that they end in. A tag does not reach beyond its piece, so it does not matter which
        pieces come together."""
        found, at, size = [], 0, len(text)
        find, tag = text.find, self.tag
        name = bang = mark = -1
        while True:
            if kind:
                at = find(ENDS[kind], at)
                if at < 0:
                    return found, kind
                kind, at = 0, at + len(ENDS[kind])
            # the next places of what may matter, each looked for once
            if name < at and (name := find(tag, at)) < 0:
                name = size
            if bang < at and (bang := find("<!", at)) < 0:
                bang = size
            if mark < at and (mark := find("<?", at)) < 0:
                mark = size
            if name < bang and name < mark:
                end = name + len(tag)
                after = text[end : end + 1]
                if after != ">" and after != "/" and not after.isspace():
                    at = name + 1
                    continue
                at, begin = end, text.rfind("<", 0, name)
                lead = self.lead.fullmatch(text, begin, name) if begin >= 0 else None
                if not lead:
                    continue
                stop = end + 1 if after == ">" else self._stop(text, name, end)
                if stop:
                    at = stop
                    found.append(("close" if lead[1] else "empty" if text[at - 2] == "/" else "open", begin, at))
            elif bang < mark:
                kind = next((k for start, k in KINDS.items() if text.startswith(start, bang)), 0)
                at = bang + 2
                if kind:
                    at = bang + len("<!--" if kind == 1 else "<![CDATA[")
            elif mark < size:
                kind, at = KINDS["<?"], mark + 2
            else:
                return found, 0

    def _stop(self, text: str, name: int, end: int) -> int | None:
        """End of the tag with this name, if it has one in its piece."""
        rest = self.rest.match(text, end)
        piece = text.find(self.separator, name)
        return rest.end() if rest and (piece < 0 or rest.end() <= piece + len(self.separator)) else None


class Cutter:
    """Follows one split from a known state; `done` gets (closed, text) of records, not closed ones as
    they are found out."""

    def __init__(self, state: int, prefix: str | None):
        self.kind, self.open = state >> 1, bool(state & 1)
        self.held = [prefix] if prefix is not None else []
        self.known = prefix is not None or not self.open
        self.done: list[tuple[bool, str]] = []
        self.closed = 0

    def feed(self, text: str, found: list[tuple[str, int, int]], kind: int) -> None:
        at = 0
        for what, begin, end in found:
            if self.open:
                self.held.append(text[at:begin])
                if what == "close":
                    self._finish(True)
                else:
                    self._finish(False)
            if what == "empty":
                self._finish(True)
            self.open, self.known, at = what == "open", True, end
        if self.open:
            self.held.append(text[at:])
        self.kind = kind

    def skim(self, text: str, found: list[tuple[str, int, int]], inner: int, kind: int) -> None:
        """As `feed`, but closed records are counted only: `inner` of those whose opening tag is in `found`."""
        if found:
            what, _, end = found[-1]
            self.closed += inner + (self.open and found[0][0] == "close")
            self.open, self.known = what == "open", True
            self.held = [text[end:]] if self.open else []
        elif self.open and self.known:
            self.held.append(text)
        self.kind = kind

    def _finish(self, closed: bool) -> None:
        self.done.append((closed, "".join(self.held)))
        self.closed += closed
        self.held = []

    @property
    def state(self) -> int:
        return 2 * self.kind + self.open


class Summary:
    """Sums up a split for all eight states. Cutters that have come to the same state through the same
    tag go on as one: each entry of `groups` is a cutter and, by start state, the records it was
    behind when they met."""

    def __init__(self, tag: str, header: str):
        self.markup = Markup(tag)
        self.groups = [(Cutter(state, None), {state: 0}) for state in range(8)]
        element = rf"<{PREFIX}{header}(?:\s[^>]*)?>(.*?)</{PREFIX}{header}\s*>"
        self.element, self.header, self.before, self.looking = re.compile(element, re.S), None, "", True

    def feed(self, values: pa.Array) -> None:
        at = 0
        # a header stands in front of the records: piece by piece up to the first
        while self.looking and at < len(values):
            text = (values[at].as_py() or "") + self.markup.separator
            self._look(text)
            self._skim(text)
            at += 1
        for text in self.markup.texts(values.slice(at)):
            self._skim(text)

    def _skim(self, text: str) -> None:
        seen: dict[int, tuple] = {}
        tagged = []
        for c, _ in self.groups:
            began = c.kind
            if began not in seen:
                found, kind = self.markup.events(text, began)
                kinds = [what for what, _, _ in found]
                # a closing tag closes what the tag before it opened
                inner = kinds.count("empty") + sum(a == "open" and b == "close" for a, b in zip(kinds, kinds[1:]))
                seen[began] = found, inner, kind
            found, inner, kind = seen[began]
            c.skim(text, found, inner, kind)
            if found:
                self.looking = self.looking and began > 0
                tagged.append((c, found[-1][2]))
        if len(tagged) > 1:
            self._meet(tagged)

    def _meet(self, tagged: list) -> None:
        """One group for all that have just passed the same last tag and are in the same state."""
        ends = {id(c): (c.state, end if c.open else 0) for c, end in tagged}
        first: dict[tuple, tuple] = {}
        kept = []
        for c, members in self.groups:
            key = ends.get(id(c))
            met = first.get(key) if key else None
            if met is None:
                kept.append((c, members))
                if key:
                    first[key] = c, members
            else:
                met[1].update({state: n + c.closed - met[0].closed for state, n in members.items()})
        self.groups = kept

    def _look(self, text: str) -> None:
        """The first header element stands in front of the records; comments do not count."""
        self.before = re.sub(r"<!--.*?-->", "", self.before + text, flags=re.S)
        found = self.element.search(self.before)
        if found:
            self.header = f"<r>{found[1]}</r>"
        if found or len(self.before) > HEADER_ROOM:
            self.looking, self.before = False, ""

    def result(self) -> tuple:
        by_state = {state: (c, n) for c, members in self.groups for state, n in members.items()}
        ends = [by_state[state] for state in range(8)]
        heads = ["".join(c.held) if c.open and c.known else None for c, _ in ends]
        return [c.state for c, _ in ends], [c.closed + n for c, n in ends], heads, self.header


def split_table(spark: SparkSession, path: str, tag: str, header: str) -> DataFrame:
    """One row a split (`split_maps`); the note of a file's first split is its header element."""
    from pyspark.sql import functions as F

    maps = split_maps(text_pieces(spark, path, f"{tag}>"), lambda: Summary(tag, header))
    return maps.withColumn("_note", F.when(F.col(START) == 0, F.col("_note")))


def cut_records(spark: SparkSession, path: str, tag: str, table: DataFrame) -> DataFrame:
    """(source_file, _date, row_id, body): the text inside every record, numbered from 1 in the order of
    files and places; records that are never closed have no number. `_date` is that of the file's first
    split in `table`. A file that breaks off right behind the `</` or prefix of a record's closing tag
    counts as closed there."""
    pieces = text_pieces(spark, path, f"{tag}>").drop("_name")
    states = file_offsets(split_states(table, INSIDE, False, ("_name", "_date")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        markup, cutter, number = Markup(tag), None, 0

        def rows(name: str, date: str | None) -> pa.RecordBatch:
            nonlocal number
            numbers = []
            for closed, _ in cutter.done:
                number += closed
                numbers.append(number if closed else None)
            texts = [t for _, t in cutter.done]
            cutter.done = []
            same = [pa.repeat(pa.scalar(x, pa.string()), len(texts)) for x in (name, date)]
            return pa.RecordBatch.from_arrays(
                [*same, pa.array(numbers, pa.int64()), pa.array(texts, pa.string())],
                names=["source_file", "_date", "row_id", "body"],
            )

        for (_, _, state, before, prefix, last, offset, name, date), values in runs(batches, 9):
            if cutter is None:
                cutter, number = Cutter(state, prefix), offset + before
            if values is not None:
                for text in markup.texts(values):
                    cutter.feed(text, *markup.events(text, cutter.kind))
            elif last and cutter.open:
                # the separator behind a file's last piece is not in the file
                cutter.held = ["".join(cutter.held).removesuffix(markup.separator)]
                cutter._finish(False)
            if cutter.done:
                yield rows(name, date)
            if values is None:
                cutter = None

    columns = ["value", FILE, START, "_state", "_before", "_prefix", "_last", "_offset", "_name", "_date"]
    return with_states(pieces, states).select(*columns).mapInArrow(run, "source_file string, _date string, row_id long, body string")
