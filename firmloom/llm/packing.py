"""Shortest-pack-first packing over the histogram of lengths.

Only the histogram (one row a length, at most `capacity` rows) reaches the driver. There
the lengths are placed longest first; a packing pattern stands for as many sequences as
its count says, and placing a length updates counts of patterns, never single sequences.
The patterns are then joined back to the pieces: piece number r of a length, counted
without a global sort, belongs to the r-th place the patterns have for that length.
"""

from __future__ import annotations

import functools
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmloom.llm.bpe import byte_letters
from firmloom.llm.common import slices, stored, text_or_empty

#: Pre-tokenisation of the lower-case vocabulary with word ends; fixed value.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"


class WordIds(dict):
    """Maps a word (between ASCII white space) to its token ids as little-endian bytes.

    The vocabulary drops white space and works within words, so a text's ids are those of
    its words in order. Plain words go to the library's merge model piece by piece; words of
    other alphabets or with control or special strings go to the library whole. A cache of at
    most two generations of `room` words.
    """

    def __init__(self, path: str, room: int = 300_000):
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.model, self.room, self.old = self.library.model, room, {}
        self.letters = {b: c for c, b in byte_letters().items()}
        self.pattern = regex.compile(WORD_PATTERN)
        self.pieces: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        made = self.old.pop(word, None)
        if made is None:
            made = self._ids(word)
        if len(self) >= self.room:
            self.old = dict(self)
            self.clear()
        self[word] = made
        return made

    def _ids(self, word: str) -> bytes:
        if not word:
            return b""
        plain = word.isascii()
        if not plain and max(word) > "\u024f" or "<|" in word or min(word) < " ":
            return array("I", self.library.encode(word, add_special_tokens=False).ids).tobytes()
        word = word.lower()
        if plain:
            if word.isalpha():
                return self._piece(word)
            if word[:-1].isalpha() and word[-1] in ".,!?;:":
                return self._piece(word[:-1]) + self._piece(word[-1])
        return b"".join([self._piece(p) for p in self.pattern.findall(word)])

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            if len(self.pieces) >= self.room:
                self.pieces.clear()
            symbols = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
            found = self.pieces[piece] = array("I", [t.id for t in self.model.tokenize(symbols)]).tobytes()
        return found

    def forget(self) -> None:
        """Empty the cache: a worker process outlives its task, and the next stage needs the memory."""
        self.clear()
        self.old = {}
        self.pieces = {}

    def batch_ids(self, texts: pa.StringArray) -> Iterator[memoryview]:
        """The ids of each text. Each different word of the batch is looked up once."""
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        known = pa.array([self[w] for w in coded.dictionary.to_pylist()], pa.large_binary())
        ids = known.take(coded.indices)
        data = memoryview(ids.buffers()[2] or b"")
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(ids).to_numpy(zero_copy_only=False))])
        at = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
        bounds = ends[at].tolist()
        for a, b in zip(bounds, bounds[1:]):
            yield data[a:b]


@functools.lru_cache(maxsize=2)
def _words(path: str) -> WordIds:
    """One for each worker process; the vocabulary is kept from task to task, words are not."""
    return WordIds(path)


def token_pieces(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 4096,
    end_id: int = 2,
    keep_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Tokenise whole texts and cut each into pieces of at most `capacity` ids.

    Returns (doc_id, start, length, ids_crc32, doc_tokens[, ids binary]), one row a piece: a
    document's ids are those of its text and then `end_id`, so null or empty text gives one
    piece of one id. The checksum is over little-endian unsigned 32-bit ids.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    end = np.array([end_id], dtype="<u4").tobytes()
    layout = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(vocabulary)
        for whole in batches:
            for batch in slices(whole, 1, 4 << 20):
                rows: list[tuple] = []
                for doc_id, found in zip(batch.column(0).to_pylist(), words.batch_ids(batch.column(1))):
                    ids = bytes(found) + end
                    total = len(ids) // 4
                    for start in range(0, total, capacity):
                        part = ids[4 * start : 4 * (start + capacity)]
                        rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), total, part)[: 5 + keep_ids])
                kinds = [pa.int64()] * 5 + [pa.binary()] * keep_ids
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: 5 + keep_ids]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names
                )
        words.forget()

    return narrow.mapInArrow(run, layout)


@dataclass
class Pattern:
    """`count` sequences that hold the same lengths: runs of (length, copies, offset)."""

    count: int
    used: int
    runs: tuple[tuple[int, int, int], ...]


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Place every length of `histogram` (length: how many), longest first, into the shortest
    packs it fits; new packs are opened only where none has room. Copies of one length fill a
    pack together. Each step uses up a length or a pattern, so there are at most about twice as
    many patterns as lengths, however many pieces there are."""
    by_room: dict[int, list[Pattern]] = defaultdict(list)
    done: list[Pattern] = []

    def put(pattern: Pattern) -> None:
        room = capacity - pattern.used
        (by_room[room] if room else done).append(pattern)

    def add(base: Pattern, count: int, length: int, copies: int) -> None:
        runs = (*base.runs, (length, copies, base.used))
        put(Pattern(count, base.used + copies * length, runs))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r, found in by_room.items() if r >= length and found), default=0)
            base = by_room[room].pop() if room else Pattern(left, 0, ())
            copies = (room or capacity) // length
            full = min(base.count, left // copies)
            rest = left % copies if full < base.count and left // copies == full else 0
            if full:
                add(base, full, length, copies)
            if rest:
                add(base, 1, length, rest)
            kept = base.count - full - bool(rest)
            left -= full * copies + rest
            if room and kept:
                put(Pattern(kept, base.used, base.runs))
    return done + [p for found in by_room.values() for p in found]


def pack(pieces: DataFrame, capacity: int = 4096, salts: int = 256) -> DataFrame:
    """`pieces` (any columns, with doc_id, start and length long from 1 to `capacity`) with
    sequence_id and offset: sequences from 0 on without gaps, offsets within one without gaps.

    `pieces` is read twice (histogram, join): hand over a written table. Numbers within a
    length come from counts per (length, salt), so that a length shared by a third of all
    pieces is spread over `salts` groups. An empty table gives no rows.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(not 1 <= n <= capacity for n in histogram):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    places, taken, sequence = [], defaultdict(int), 0
    for p in pack_histogram(histogram, capacity):
        for length, copies, offset in p.runs:
            first = taken[length]
            taken[length] += p.count * copies
            places.append((length, first, taken[length], sequence, copies, offset))
        sequence += p.count
    layout = "length long, first long, last long, base long, copies long, at long"
    # At most a few rows a length: bounded by the capacity, whatever the input.
    table = F.broadcast(spark.createDataFrame(places, layout))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)).cast("int"))
    group = Window.partitionBy("length", "salt")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    starts = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    ranked = salted.withColumn("rank", F.row_number().over(group.orderBy("doc_id", "start")) - 1)
    ranked = ranked.join(starts, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("skip"))
    inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    step = F.col("rank") - F.col("first")
    return (
        ranked.alias("r")
        .join(table.alias("t"), (F.col("r.length") == F.col("t.length")) & inside)
        .select(
            *[F.col(f"r.{c}") for c in pieces.columns],
            (F.col("base") + F.expr("(rank - first) div copies")).alias("sequence_id"),
            (F.col("at") + F.pmod(step, F.col("copies")) * F.col("r.length")).alias("offset"),
        )
    )


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 2) -> DataFrame:
    """`token_pieces` and `pack` in one: every piece of every document with its place.

    Null and empty texts hold `end_id` alone; very long texts give many pieces; repeated rows
    are packed each; an empty table gives no rows.
    """
    return pack(stored(token_pieces(docs, vocabulary, capacity, end_id), "pieces"), capacity)
