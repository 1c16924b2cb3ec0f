"""Records of text files that many tasks read, cut where a format's own rules cut them.

A file's splits end anywhere, also inside a quoted cell, a comment or a record. So each split is
first summed up as a table: from every state it may start in, the state it ends in, how many records
end in it, and the text of the record it leaves open. Strung together in file order, a row a split,
the tables give each split its true state, the number of its first record and the text that its
first record begins with. A second scan then cuts whole records, each in the split it ends in; no
text is shuffled but those beginnings.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmloom.operators.ordinals import BROADCAST_SPLITS, FILE, START, preceding

# ship the functions themselves, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Longest text that is handed on from split to split.
LONGEST_HEAD = 1 << 24
#: Stands for a text beyond that; no file holds this character.
TOO_LONG = "￿"

_MAPS = f"{FILE} string, {START} long, _name string, _to array<int>, _count array<long>, _head array<string>, _note string"
_STATES = f"{FILE} string, {START} long, _state int, _before long, _prefix string, _last boolean, _n long"


def text_pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """What stands between separators, with file and split."""
    return spark.read.option("lineSep", separator).text(path).select(
        "value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(START),
        F.col("_metadata.file_name").alias("_name"),
    )


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Array | None]]:
    """(key values, pieces) of each stretch of one split in a task's rows, whose last `keys` columns
    tell its split; after the last stretch of a split its key comes again without pieces."""
    current = None
    for batch in batches:
        columns = [batch.column(batch.num_columns - keys + k) for k in range(keys)]
        # within a task a split's rows stand together: file and start change with the split only
        ends = [0, *_changes(columns[0], columns[1]), batch.num_rows]
        for a, b in zip(ends, ends[1:]):
            if a == b:
                continue
            key = tuple(c[a].as_py() for c in columns)
            if current is not None and key[:2] != current[:2]:
                yield current, None
            current = key
            yield key, batch.column(0).slice(a, b - a)
    if current is not None:
        yield current, None


def _changes(*columns: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    found: set[int] = set()
    for c in columns:
        if len(c) > 1:
            differ = pc.not_equal(c.slice(1), c.slice(0, len(c) - 1))
            found.update((pc.indices_nonzero(differ).to_numpy() + 1).tolist())
    return sorted(found)


def split_maps(pieces: DataFrame, summary: Callable[[], object]) -> DataFrame:
    """One row a split. `summary()` makes an object whose `feed` takes the split's pieces in order;
    its `result` is (end state by start state, records by start state, open text by start state, note)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, rows = None, []
        for key, values in runs(batches, 3):
            made = made or summary()
            if values is not None:
                made.feed(values)
                continue
            to, count, heads, note = made.result()
            heads = [h if h is None or len(h) <= LONGEST_HEAD else TOO_LONG for h in heads]
            rows.append((*key, to, count, heads, note))
            made = None
        if rows:
            kinds = (pa.string(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.string()), pa.string())
            names = [f.split()[0] for f in _MAPS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return pieces.select("value", FILE, START, "_name").mapInArrow(run, _MAPS)


def split_states(maps: DataFrame, inside: tuple[int, ...], closing: bool, keep: tuple[str, ...] = ()) -> DataFrame:
    """True start state of each split, records that end before it in its file, the text its first
    record begins with, and the records that end in it.

    `inside` are the states in which a record is open. With `closing`, a record that is still open
    at the end of a file ends there. `keep` are texts of a file's first split, given to all its splits.
    """
    layout = ", ".join([_STATES, *[f"{k} string" for k in keep]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for file, splits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                state, before, prefix = 0, 0, None
                kept = [splits[0][k] for k in keep]
                for s in splits:
                    last = s is splits[-1]
                    end, n, head = s["_to"][state], s["_count"][state], s["_head"][state]
                    n += last and closing and end in inside
                    rows.append((file, s[START], state, before, prefix, last, n, *kept))
                    if end in inside and not last and (head is None or head == TOO_LONG):
                        raise ValueError(
                            f"a record of {file} is longer than the split at byte {s[START]}: "
                            "raise spark.sql.files.maxPartitionBytes"
                        )
                    state, before, prefix = end, before + n, head if end in inside else None
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), *[pa.string()] * len(keep))
            names = [f.split()[0] for f in layout.split(", ")]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    # one short row a split: a file's splits make one row
    lists = maps.groupBy(FILE).agg(F.sort_array(F.collect_list(F.struct(START, "_to", "_count", "_head", *keep))).alias("s"))
    return lists.mapInArrow(run, layout)


def file_offsets(states: DataFrame, skip: int = 0) -> DataFrame:
    """`states` with `_offset`: records in all files before this one, `skip` of each file not counted."""
    files = states.groupBy(FILE).agg(F.greatest(F.sum("_n") - skip, F.lit(0)).alias("_n"))
    return states.drop("_n").join(preceding(files, [FILE]).drop("_n"), FILE)


def with_states(pieces: DataFrame, states: DataFrame) -> DataFrame:
    """Pieces with the state row of their split, sent to them; beyond BROADCAST_SPLITS splits joined."""
    if pieces.rdd.getNumPartitions() <= BROADCAST_SPLITS:
        states = F.broadcast(states)
    missing = F.raise_error(F.lit("a file split has no state: the files or split sizes changed in between"))
    joined = pieces.join(states, [FILE, START], "left")
    return joined.withColumn("_state", F.when(F.col("_state").isNull(), missing.cast("int")).otherwise(F.col("_state")))
