"""CSV files with line breaks inside cells, read by many tasks.

A line starts either a record or inside a quoted cell, and which of the two it leaves for the next
line depends on its quotes alone, read as the parser reads them: a quote opens a cell only at its
start, two quotes stand for one, and after a closing quote the cell goes on to the next comma.
Lines without quotes change nothing, so only lines with quotes are looked at one by one.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmloom.operators.ordinals import FILE, START
from firmloom.sources.splits import file_offsets, split_maps, split_states, text_pieces, with_states, runs

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: States at the start of a line.
RECORD, CELL = 0, 1
OPTIONS = {"escape": '"', "multiLine": "true"}


def _closed(line: str, at: int) -> int:
    """The place behind the quote that closes a cell whose text goes on at `at`; -1 if none does."""
    while True:
        at = line.find('"', at)
        if at < 0:
            return -1
        if line[at + 1 : at + 2] != '"':
            return at + 1
        at += 2


def end_state(line: str, state: int) -> int:
    """The state that a line leaves."""
    at = 0
    while True:
        if state == CELL or line[at : at + 1] == '"':
            at = _closed(line, at + (state == RECORD))
            if at < 0:
                return CELL
        state, at = RECORD, line.find(",", at) + 1
        if not at:
            return RECORD


def _lines(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Places of the lines with quotes, and how many lines before each place are not blank."""
    filled = pc.greater(pc.binary_length(pc.utf8_trim_whitespace(values)), 0).to_numpy(zero_copy_only=False)
    quoted = np.flatnonzero(pc.match_substring(values, '"').to_numpy(zero_copy_only=False))
    return quoted, np.concatenate([[0], np.cumsum(filled)])


class LineMap:
    """Sums up a split for both states it may start in."""

    def __init__(self):
        self.state, self.count, self.head = [RECORD, CELL], [0, 0], [None, None]

    def feed(self, values: pa.Array) -> None:
        quoted, filled = _lines(values)
        at = 0
        for place in [*quoted.tolist(), len(values)]:
            self._plain(values, at, place, int(filled[place] - filled[at]))
            if place < len(values):
                self._line(values[place].as_py())
            at = place + 1

    def _plain(self, values: pa.Array, a: int, b: int, filled: int) -> None:
        held = None
        for k in (RECORD, CELL):
            if self.state[k] == RECORD:
                self.count[k] += filled
            elif self.head[k] is not None and a < b:
                held = held or values.slice(a, b - a).to_pylist()
                self.head[k].extend(held)

    def _line(self, line: str) -> None:
        ends = [end_state(line, s) if s in self.state else s for s in (RECORD, CELL)]
        for k in (RECORD, CELL):
            before, after = self.state[k], ends[self.state[k]]
            if after == RECORD:
                self.count[k] += 1
                self.head[k] = None
            elif before == RECORD:
                self.head[k] = [line]
            elif self.head[k] is not None:
                self.head[k].append(line)
            self.state[k] = after

    def result(self) -> tuple:
        heads = [None if h is None else "\n".join([*h, ""]) for h in self.head]
        return self.state, self.count, heads, None


class Records:
    """Cuts the records of a split whose start state is known."""

    def __init__(self, state: int, prefix: str | None):
        self.state, self.held = state, [] if prefix is None else [prefix.removesuffix("\n")]

    def feed(self, values: pa.Array) -> list[str]:
        out: list[str] = []
        quoted, _ = _lines(values)
        at = 0
        for place in [*quoted.tolist(), len(values)]:
            if at < place:
                plain = values.slice(at, place - at).to_pylist()
                if self.state == RECORD:
                    out += [x for x in plain if x.strip()]
                else:
                    self.held += plain
            if place < len(values):
                line = values[place].as_py()
                self.held.append(line)
                self.state = end_state(line, self.state)
                if self.state == RECORD:
                    out += self.rest()
            at = place + 1
        return out

    def rest(self) -> list[str]:
        """What is held, as a record."""
        found = ["\n".join(self.held)] if self.held else []
        self.held = []
        return found


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(number, record): the text of every record but each file's first, the header; numbered from 1
    in the order of files and records. Blank lines between records are left out."""
    pieces = text_pieces(spark, path, "\n")
    states = file_offsets(split_states(split_maps(pieces, LineMap), (CELL,), True), skip=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, number = None, 0
        for (_, _, state, before, prefix, last, offset), values in runs(batches, 7):
            if cutter is None:
                cutter, number = Records(state, prefix), before
            found = cutter.rest() if values is None and last else [] if values is None else cutter.feed(values)
            if found:
                # number 0 of a file is its header
                numbers = range(number, number + len(found))
                number += len(found)
                drop = int(numbers[0] == 0)
                texts = [x.removesuffix("\r") for x in found[drop:]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([offset + n for n in numbers[drop:]], pa.int64()), pa.array(texts, pa.string())], names=["number", "record"]
                )
            if values is None:
                cutter = None

    columns = ["value", FILE, START, "_state", "_before", "_prefix", "_last", "_offset"]
    return with_states(pieces, states).select(*columns).mapInArrow(run, "number long, record string")


def read_csv(spark: SparkSession, path: str, ordinal: str | None = None) -> DataFrame:
    """CSV files with a header, all columns strings, as Spark's reader gives them with `multiLine`,
    but with many tasks a file. `ordinal` adds the record's number. A cell may not be longer than a
    split (spark.sql.files.maxPartitionBytes); that is an error."""
    names = spark.read.csv(path, header=True, escape='"', multiLine=True).columns
    schema = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    # explode keeps the parser from being planned once for every column
    parsed = csv_records(spark, path).select(
        "number", F.explode(F.array(F.from_csv("record", schema, OPTIONS))).alias("r")
    )
    own = [] if ordinal is None else [F.col("number").alias(ordinal)]
    return parsed.select(*own, *[F.col("r")[n].alias(n) for n in names])
