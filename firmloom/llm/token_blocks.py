"""Token ids in files of patched frame-of-reference blocks.

A text is cut before each single space or line break, where the vocabulary's own pattern cuts
as well; each different chunk is encoded once. Documents are sorted by doc_id in range
partitions, and the ids of a partition, strung together, fall into blocks of 128. Of a block the
minimum is taken off, the rest is packed at the width that a share of its values fits, and the
others (the patches) follow as positions and whole values. Blocks make segments, which are the
files' rows: a segment holds its documents, the byte at which each block starts, and the blocks,
so that any run of ids is read by unpacking the blocks it touches.

The container of the segments is Parquet: Spark's writers commit whole files only, so a lost
executor leaves nothing half written, and readers need no more than a path.
"""

from __future__ import annotations

import functools
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firmloom.llm.bpe import byte_letters
from firmloom.llm.common import shared_dir, slices, text_or_empty
from firmloom.llm.token_counts import PATTERN

BLOCK = 128
#: Ids of a segment.
SEGMENT = 1 << 19
#: Bytes of text of a range partition, and most partitions: beyond, partitions grow.
PART_BYTES, MOST_PARTS = 24 << 20, 20_000
MAGIC = b"PFR1"
#: magic, ids, blocks, entries
HEAD = struct.Struct("<4sIII")
#: A document, or the part of it that a segment holds.
ENTRY = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("offset", "<i8"), ("length", "<u4"), ("total", "<i8")])
BLOCK_HEAD = 6

# ---- blocks


def pack_ids(ids: np.ndarray, share: float = 0.85) -> tuple[np.ndarray, bytes]:
    """Byte starts of the blocks of `ids` (unsigned 32-bit) and the blocks themselves.

    A block: minimum (4 bytes), width (6 bits) and bytes of a patch less one (2 bits), number of
    patches (1 byte), the low `width` bits of 128 values, positions of the patches (1 byte each),
    what their values have above those bits (as many bytes as the block's largest needs).
    The width is the smallest that the share `share` of the values fits. A short last block is
    filled up with its last value.
    """
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return np.zeros(0, dtype="<u4"), b""
    filled = np.concatenate([ids, np.full(blocks * BLOCK - len(ids), ids[-1], dtype=ids.dtype)])
    rows = filled.astype("<u4").reshape(blocks, BLOCK)
    least = rows.min(axis=1)
    rows = rows - least[:, None]
    bits = np.frexp(rows.astype(np.float64))[1].astype(np.int8)
    at = min(BLOCK - 1, max(0, int(np.ceil(share * BLOCK)) - 1))
    widths = np.partition(bits, at, axis=1)[:, at].astype(np.int64)
    patch_block, patch_place = np.nonzero(bits > widths[:, None])
    patches = np.bincount(patch_block, minlength=blocks)
    patch_bytes = np.maximum(1, (bits.max(axis=1) - widths + 7) // 8)
    sizes = BLOCK_HEAD + widths * (BLOCK // 8) + (1 + patch_bytes) * patches
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), dtype=np.uint8)
    out[starts[:, None] + np.arange(4)] = least.astype("<u4").view(np.uint8).reshape(blocks, 4)
    out[starts + 4] = widths | patch_bytes - 1 << 6
    out[starts + 5] = patches
    for width in np.unique(widths):
        if width:
            some = np.flatnonzero(widths == width)
            plain = np.unpackbits(rows[some].view(np.uint8).reshape(len(some), BLOCK, 4), axis=2, bitorder="little")
            packed = np.packbits(plain[:, :, :width].reshape(len(some), -1), axis=1, bitorder="little")
            out[starts[some][:, None] + BLOCK_HEAD + np.arange(packed.shape[1])] = packed
    if len(patch_block):
        rank = np.arange(len(patch_block)) - (np.cumsum(patches) - patches)[patch_block]
        base = (starts + BLOCK_HEAD + widths * (BLOCK // 8))[patch_block]
        out[base + rank] = patch_place
        above = rows[patch_block, patch_place] >> widths[patch_block].astype("<u4")
        size = patch_bytes[patch_block]
        for k in range(int(size.max())):
            some = size > k
            out[(base + patches[patch_block] + size * rank + k)[some]] = above[some] >> 8 * k & 255
    return starts.astype("<u4"), out.tobytes()


def unpack_ids(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that start at the bytes `starts` of `data`, 128 for each."""
    starts = starts.astype(np.int64)
    least = np.ascontiguousarray(data[starts[:, None] + np.arange(4)]).view("<u4")
    widths, patches = data[starts + 4].astype(np.int64), data[starts + 5].astype(np.int64)
    patch_bytes, widths = (widths >> 6) + 1, widths & 63
    rows = np.zeros((len(starts), BLOCK), dtype="<u4")
    for width in np.unique(widths):
        if width:
            some = np.flatnonzero(widths == width)
            packed = data[starts[some][:, None] + BLOCK_HEAD + np.arange(width * (BLOCK // 8))]
            plain = np.zeros((len(some), BLOCK, 32), dtype=np.uint8)
            plain[:, :, :width] = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(some), BLOCK, width)
            rows[some] = np.packbits(plain, axis=2, bitorder="little").view("<u4")[:, :, 0]
    count = int(patches.sum())
    if count:
        block = np.repeat(np.arange(len(starts)), patches)
        rank = np.arange(count) - (np.cumsum(patches) - patches)[block]
        base = (starts + BLOCK_HEAD + widths * (BLOCK // 8))[block]
        above, size = np.zeros(count, dtype="<u4"), patch_bytes[block]
        for k in range(int(size.max())):
            some = size > k
            above[some] |= data[(base + patches[block] + size * rank + k)[some]].astype("<u4") << 8 * k
        rows[block, data[base + rank]] |= above << widths[block].astype("<u4")
    return (rows + least).reshape(-1)


def write_segment(ids: np.ndarray, entries: list[tuple], share: float = 0.85) -> bytes:
    """A segment of the ids of `entries` (fields of ENTRY), one behind the other."""
    starts, blocks = pack_ids(ids, share)
    table = np.array(entries, dtype=ENTRY)
    return HEAD.pack(MAGIC, len(ids), len(starts), len(table)) + table.tobytes() + starts.tobytes() + blocks


class Segment:
    """A segment read back: its documents at once, its ids block by block."""

    def __init__(self, data: bytes):
        magic, self.n_ids, blocks, entries = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a segment of token blocks")
        at = HEAD.size + entries * ENTRY.itemsize
        self.entries = np.frombuffer(data, ENTRY, entries, HEAD.size)
        self.starts = np.frombuffer(data, "<u4", blocks, at)
        self.blocks = np.frombuffer(data, np.uint8, offset=at + 4 * blocks)

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids from `start` to `stop`; only the blocks that hold them are unpacked."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, dtype="<u4")
        first = start // BLOCK
        found = unpack_ids(self.blocks, self.starts[first : (stop - 1) // BLOCK + 1])
        return found[start - first * BLOCK : stop - first * BLOCK]


# ---- checksums of parts

#: The reversed polynomial of CRC-32; fixed value.
CRC_POLYNOMIAL = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of CRC-32 (bit 31 is the constant term)."""
    out = 0
    while a:
        if a & 0x80000000:
            out ^= b
        a = a << 1 & 0xFFFFFFFF
        b = b >> 1 ^ (CRC_POLYNOMIAL if b & 1 else 0)
    return out


def crc_share(part: bytes, before: int, total: int) -> int:
    """What the bytes `part` add to the CRC-32 of `total` bytes with `before` bytes in front of
    them: the exclusive or of the shares of all parts is the checksum of the whole.

    A checksum is linear but for its start value, which the first part accounts for.
    """
    if not before and len(part) == total:
        return zlib.crc32(part)
    share = zlib.crc32(part, 0xFFFFFFFF) ^ 0xFFFFFFFF
    step, behind = 0x00800000, total - before - len(part)  # step: the polynomial x ** 8
    grown, at, left = 0x80000000, 0x00800000, total
    while behind or left:
        if behind & 1:
            share = _times(share, step)
        if left & 1:
            grown = _times(grown, at)
        step, at, behind, left = _times(step, step), _times(at, at), behind >> 1, left >> 1
    return share if before else share ^ _times(0xFFFFFFFF, grown) ^ 0xFFFFFFFF


# ---- encoding

#: Texts in which some white space is not alone between other characters, or that hold the
#: marks used here or may hold special strings: the library encodes them whole.
ODD = r"[\s\x0b\x1c-\x1f\x85\p{Z}]{2}|^[\s\x0b\x1c-\x1f\x85\p{Z}]|[\s\x0b\x1c-\x1f\x85\p{Z}]$|<\||[\x00-\x08]"


class ChunkIds(dict):
    """Maps a chunk to its ids as bytes: a word that has a space before it, a line break and a
    word, or the mark "\\x01" and the word that opens a text.

    Plain words go to the library's merge model piece by piece; words of other alphabets or with
    control characters go to the library whole. A cache of two generations of at most `room`
    chunks of at most `longest` characters.
    """

    def __init__(self, path: str, room: int = 400_000, longest: int = 48):
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.wide = self.library.get_vocab_size() > 1 << 16
        self.room, self.longest = room, longest
        self.pattern = regex.compile(PATTERN)
        self.letters = {b: c for c, b in byte_letters().items()}
        self.forget()

    def forget(self) -> None:
        """A worker outlives its task, and the next stage needs the memory."""
        self.clear()
        self.old: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        made = self.old.get(chunk) or self._chunk(chunk)
        if len(chunk) <= self.longest:
            if len(self) >= self.room:
                self.old = dict(self)
                self.clear()
            self[chunk] = made
        return made

    def whole(self, text: str) -> bytes:
        return self._bytes(self.library.encode(text, add_special_tokens=False).ids)

    def _bytes(self, ids: list[int]) -> bytes:
        return array("I" if self.wide else "H", ids).tobytes()

    def _chunk(self, word: str) -> bytes:
        if word.isascii() or max(word) <= "\u024f":
            if word.isalpha():
                return self._merge(" " + word)
            if word[-1] in ".,!?;:" and word[:-1].isalpha():
                return self[word[:-1]] + self._piece(word[-1])
            if len(word) <= self.longest and min(word[1:], default=" ") >= " ":
                text = word[1:] if word[0] == "\x01" else word if word[0] == "\n" else " " + word
                return b"".join([self._piece(p) for p in self.pattern.findall(text)])
        return self.whole(word[1:] if word[0] == "\x01" else word if word[0] == "\n" else " " + word)

    def _merge(self, piece: str) -> bytes:
        symbols = "\u0120" + piece[1:] if piece[0] == " " and piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        return self._bytes([t.id for t in self.model.tokenize(symbols)])

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            if len(self.pieces) >= self.room:
                self.pieces.clear()
            found = self.pieces[piece] = self._merge(piece)
        return found

    def batch(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, in two bytes each (in four where the vocabulary needs it)."""
        out: list[bytes] = [b""] * len(texts)
        empty = pc.equal(pc.binary_length(texts), 0)
        odd = pc.match_substring_regex(texts, ODD)
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
            out[i] = self.whole(texts[i].as_py())
        places = np.flatnonzero(~pc.or_(empty, odd).to_numpy(zero_copy_only=False))
        if not len(places):
            return out
        marked = pc.binary_join_element_wise("\x01", texts.take(pa.array(places)), "")
        lists = pc.split_pattern(pc.replace_substring(marked, "\n", " \n"), " ")
        coded = lists.flatten().dictionary_encode()
        ids = pa.array([self[c] for c in coded.dictionary.to_pylist()], pa.large_binary()).take(coded.indices)
        data = memoryview(ids.buffers()[2] or b"")
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(ids).to_numpy(zero_copy_only=False))])
        at = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
        bounds = ends[at].tolist()
        for i, a, b in zip(places.tolist(), bounds, bounds[1:]):
            out[i] = bytes(data[a:b])
        return out


@functools.lru_cache(maxsize=2)
def _coder(path: str) -> ChunkIds:
    return ChunkIds(path)


# ---- files


def write_token_blocks(
    docs: DataFrame, path: str, vocabulary: str, end_id: int = 2, share: float = 0.85,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Write the ids of all texts, each followed by `end_id`, to `path` in ascending doc_id order.

    Rows of one doc_id stand in the order of a hash of their text; rows without an id come first.
    Null text is empty and gives `end_id` alone; repeated rows are written each; a very long text
    is spread over segments; an empty table gives a file without segments. `vocabulary` is the
    path of a byte-level vocabulary file on every executor.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    size = narrow.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    parts = max(1, min(MOST_PARTS, -(-size // PART_BYTES)))
    # the row number parts rows that are equal in all else, so that no id is too hot to split
    order = ["doc_id", "key", "row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary)
        end, kind = np.array([end_id], dtype="<u4"), "<u4" if coder.wide else "<u2"
        part, place, seq = TaskContext.get().partitionId(), 0, 0
        held, entries, room = [], [], SEGMENT

        def segment() -> pa.RecordBatch:
            ids = np.concatenate(held)
            return pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([seq]), pa.array([place], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.array([write_segment(ids, entries, share)], pa.binary())],
                names=["part", "seq", "place", "n_ids", "data"],
            )

        for whole in batches:
            for batch in slices(whole, 1, 8 << 20):
                for doc_id, data in zip(batch.column(0).to_pylist(), coder.batch(batch.column(1))):
                    ids = np.concatenate([np.frombuffer(data, kind), end], dtype="<u4")
                    total, offset = len(ids), 0
                    while len(ids):
                        now, ids = ids[:room], ids[room:]
                        held.append(now)
                        entries.append((doc_id or 0, doc_id is not None, offset, len(now), total))
                        offset, room = offset + len(now), room - len(now)
                        if not room:
                            yield segment()
                            place, seq = place + SEGMENT, seq + 1
                            held, entries, room = [], [], SEGMENT
        if held:
            yield segment()
        coder.forget()

    written = (
        narrow.withColumn("key", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
        .mapInArrow(run, "part long, seq long, place long, n_ids long, data binary")
    )
    # the packed bytes do not shrink further
    written.write.option("compression", "none").parquet(path)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments at `path` with the ids of all segments before each (`first`).

    A writer's partition holds its place among its own; only the sums of the partitions, at most
    MOST_PARTS rows by the writer's rule, are added up in one task and sent to the rows.
    """
    read = spark.read.schema("part long, seq long, place long, n_ids long, data binary").parquet(path)
    sums = read.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    return read.join(F.broadcast(offsets), "part").select(
        "part", "seq", (F.col("skip") + F.col("place")).alias("first"), "n_ids", "data"
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files at `path`.

    `start` counts the ids of all documents before it; the checksum is over little-endian
    unsigned 32-bit ids. Parts of a document in several segments meet in an exclusive or, so no
    task holds a long document whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                segment = Segment(data.as_py())
                ids = memoryview(segment.ids().tobytes())
                entries = segment.entries
                ends = np.cumsum(entries["length"].astype(np.int64))
                begins = ends - entries["length"]
                shares = [
                    crc_share(ids[4 * a : 4 * b], 4 * o, 4 * t)
                    for a, b, o, t in zip(begins.tolist(), ends.tolist(), entries["offset"].tolist(), entries["total"].tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(entries["doc_id"], mask=entries["known"] == 0), pa.array(first + begins - entries["offset"]),
                     pa.array(entries["total"]), pa.array(shares, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "share"],
                )

    parts = segments(spark, path).select("first", "data").mapInArrow(run, "doc_id long, start long, n_tokens long, share long")
    return parts.groupBy("doc_id", "start", "n_tokens").agg(F.bit_xor("share").alias("ids_crc32"))


def read_range(spark: SparkSession, path: str, start: int, length: int) -> DataFrame:
    """(position, id) of `length` ids from `start` on; other segments are left out by their places
    and other blocks by the index of block starts."""
    stop = start + length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                begin = max(0, start - first)
                ids = Segment(data.as_py()).ids(begin, stop - first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(first + begin, first + begin + len(ids))), pa.array(ids.astype(np.int64))],
                    names=["position", "id"],
                )

    wanted = segments(spark, path).where((F.col("first") < stop) & (F.col("first") + F.col("n_ids") > start))
    return wanted.select("first", "data").mapInArrow(run, "position long, id long")


def encode_documents(docs: DataFrame, vocabulary: str, end_id: int = 2, path: str | None = None, **columns) -> DataFrame:
    """`write_token_blocks` to `path` (a new folder in the shared one if none is given), then
    `read_documents` from there."""
    path = path or f"{shared_dir(docs.sparkSession)}/token-blocks-{uuid.uuid4().hex}"
    write_token_blocks(docs, path, vocabulary, end_id, **columns)
    return read_documents(docs.sparkSession, path)
