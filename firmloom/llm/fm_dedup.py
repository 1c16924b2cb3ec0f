"""Removal of word passages that stand elsewhere too, with FM-indexes.

A window is `width` consecutive words. All windows fall to shards by content: a window belongs to
its anchor, the group of ANCHOR words in it with the smallest hash (the leftmost of equals), and
equal windows have equal anchors. Anchors that occur once anywhere are done with. The windows of
the others come as passages: runs of windows of one document with the same anchor, so each window of
each document is in one passage. A shard holds all passages of its anchors. Their words make the text
of a compressed FM-index: the Burrows-Wheeler transform in a wavelet matrix of packed bits with
rank directories. Passages are streamed through it from right to left by backward search, which
gives the longest stretch that still occurs twice (matching statistics); stretches of `width` words
or more are reported as intervals.

Exact copies are one text throughout. An anchor with more than `most` passages would make a shard too
large: there, equal passages repeat each other whole, and the windows of the different ones are counted
one by one, both by 128-bit hashes, with the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmloom.llm.common import slices, stored, text_or_empty

#: Words of an anchor; windows must be longer.
ANCHOR = 8
#: Windows of one text that are looked at together.
STEP = 1 << 20
MULTIPLIER, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * MIX
        return h ^ (h >> np.uint64(29))


def rolling(hashes: np.ndarray, width: int, multiplier: np.uint64 = MULTIPLIER) -> np.ndarray:
    """Hash of each `width` consecutive values."""
    out = np.zeros(max(0, len(hashes) - width + 1), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            out = out * multiplier + hashes[j : j + len(out)]
    return _mix(out)


def anchor_runs(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with the same anchor: anchor hash, first window, windows in the run.

    `hashes`: one for each word of a text. Fewer than `width` words give no runs.
    """
    windows = len(hashes) - width + 1
    if windows <= 0:
        return (np.zeros(0, dtype=np.uint64), *[np.zeros(0, dtype=np.int64)] * 2)
    grams, span = rolling(hashes, ANCHOR), width - ANCHOR + 1
    parts = []
    for at in range(0, windows, STEP):
        part = grams[at : at + STEP + span - 1]
        low = (part & ~np.uint64((1 << 21) - 1)) | np.arange(len(part), dtype=np.uint64)
        size = 1
        while 2 * size <= span:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < span:
            low = np.minimum(low[: len(low) - (span - size)], low[span - size :])
        parts.append((low & np.uint64((1 << 21) - 1)).astype(np.int64) + at)
    place = np.concatenate(parts)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    return grams[place[first]], first, np.diff(np.append(first, windows))


def word_hashes(texts: list[list[bytes]]) -> list[np.ndarray]:
    coded = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode()
    known = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], dtype=np.uint64)
    flat = known[coded.indices.to_numpy()] if len(coded) else np.zeros(0, dtype=np.uint64)
    return np.split(flat, np.cumsum([len(t) for t in texts])[:-1])


class WaveletMatrix:
    """Symbols in packed bit planes, highest bit first, with counts of ones before every 64 bits."""

    def __init__(self, symbols: np.ndarray, kinds: int):
        self.bits = max(1, int(kinds - 1).bit_length())
        self.planes, self.before, self.zeros = [], [], []
        for b in range(self.bits - 1, -1, -1):
            ones = (symbols >> b & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            packed = np.concatenate([packed, np.zeros(16 - len(packed) % 8, dtype=np.uint8)]).view("<u8")
            self.planes.append(packed)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed))[:-1]]).astype(np.int64))
            self.zeros.append(len(symbols) - int(ones.sum()))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        self.base = self.follow(np.arange(kinds), np.zeros(kinds, dtype=np.int64))

    def follow(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for level, b in enumerate(range(self.bits - 1, -1, -1)):
            word = places >> 6
            mask = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.before[level][word] + np.bitwise_count(self.planes[level][word] & mask)
            places = np.where(symbols >> b & 1, self.zeros[level] + ones, places - ones)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        return self.follow(symbols, places) - self.base[symbols]


class FmIndex:
    """FM-index of passages: symbols from 1 on, each passage followed by a 0.

    Suffixes are sorted by at least their first 64 symbols, ties in any order, which is enough to
    search for anything that short: a range of the order is then the same set of suffixes.
    """

    def __init__(self, text: np.ndarray, depth: int = 64):
        n, kinds = len(text), int(text.max()) + 1
        # as many symbols to begin with as one number holds; 0 is past the end
        bits, step = kinds.bit_length(), 1
        key = text.astype(np.int64) + 1
        while 2 * step * bits < 64:
            tail = key[step:].copy()
            key <<= step * bits
            key[: n - step] |= tail
            step *= 2
        while True:
            order = np.argsort(key)
            ranked = key[order]
            rank = np.empty(n, dtype=np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
            if step >= depth or rank[order[-1]] == n - 1:
                break
            key = rank * (int(rank[order[-1]]) + 2)
            key[: n - step] += rank[step:] + 1
            step *= 2
        self.size = n
        self.text = text
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=kinds))[:-1]])
        self.tree = WaveletMatrix(text[order - 1], kinds)

    def _extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        both = self.below[np.tile(symbols, 2)] + self.tree.rank(np.tile(symbols, 2), np.concatenate([low, high]))
        return both[: len(low)], both[len(low) :]

    def reach(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """For stretches of the text from place `first` to `last`: the lowest place from which
        the part up to `last` occurs at least twice in the text (`first` at the lowest)."""
        out, who, at = last + 1, np.arange(len(first)), last.copy()
        low, high = np.zeros(len(first), dtype=np.int64), np.full(len(first), self.size, dtype=np.int64)
        while len(who):
            low, high = self._extend(self.text[at], low, high)
            twice = high - low >= 2
            out[who[twice]] = at[twice]
            on = twice & (at > first[who])
            who, at, low, high = who[on], at[on] - 1, low[on], high[on]
        return out

    def repeated(self, first: np.ndarray, last: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(stretch, from, to): the parts of `width` places or more that occur at least twice, such
        that every window that does lies in one of them."""
        found, who = [], np.arange(len(first))
        while len(who):
            start = self.reach(first[who], last)
            ok = last - start + 1 >= width
            found.append((who[ok], start[ok], last[ok]))
            # A window that begins before `start` and reaches to `last` occurs once. What is left
            # of them ends earlier, and before the first window that begins at `start`.
            last = np.minimum(last - 1, start - 2 + width)
            on = (start > first[who]) & (last - first[who] + 1 >= width)
            who, last = who[on], last[on]
        return tuple(np.concatenate(x) for x in zip(*found))


def shard_intervals(passages: list[bytes], width: int) -> list[list[tuple[int, int]]]:
    """For each passage (words joined by one space) the word intervals of which every window also
    stands elsewhere in the passages. Equal passages are indexed once and repeat each other whole."""
    number: dict[bytes, int] = {}
    place = [number.setdefault(p, len(number)) for p in passages]
    times = np.bincount(place)
    sizes = np.array([p.count(b" ") + 1 for p in number])
    coded = pa.array(b" ".join(number).split(b" "), pa.binary()).dictionary_encode()
    ends = np.cumsum(sizes + 1) - 1
    text = np.zeros(int(ends[-1]) + 1, dtype=np.int64)
    inside = np.ones(len(text), dtype=bool)
    inside[ends] = False
    text[inside] = coded.indices.to_numpy() + 1
    out: list[list[tuple[int, int]]] = [[(0, int(n))] if t > 1 else [] for n, t in zip(sizes, times)]
    once = np.flatnonzero(times == 1)
    if len(once) and len(number) > 0:
        index = FmIndex(text)
        who, a, b = index.repeated((ends - sizes)[once], ends[once] - 1, width)
        for w, x, y in zip(once[who].tolist(), a.tolist(), b.tolist()):
            origin = int(ends[w] - sizes[w])
            out[w].append((x - origin, y + 1 - origin))
    return [out[p] for p in place]


SCANNED = "doc_id long, key binary, n_words int, words_sha binary, anchors array<long>, runs array<long>"


def scan(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """One row a document: key of its text, words, hash of its words joined, anchors and their runs
    (first window * 64 + windows)."""
    text = text_or_empty(text_col)
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("key"), text.cast("binary").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2, 8 << 20):
                texts = [t.split() for t in batch.column(2).to_pylist()]
                anchors, runs = [], []
                for hashes in word_hashes(texts):
                    anchor, first, size = anchor_runs(hashes, width)
                    anchors.append(anchor.view(np.int64))
                    runs.append(first * 64 + size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([len(t) for t in texts], pa.int32()),
                     pa.array([hashlib.sha256(b" ".join(t)).digest() for t in texts], pa.binary()),
                     pa.array(anchors, pa.list_(pa.int64())), pa.array(runs, pa.list_(pa.int64()))],
                    names=["doc_id", "key", "n_words", "words_sha", "anchors", "runs"],
                )

    return narrow.mapInArrow(run, SCANNED)


def repeated_intervals(docs: DataFrame, scanned: DataFrame, width: int, shard_passages: int, most: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The different texts (key, copies), the texts that have repeated anchors (key, text) and
    the intervals in them (key, starts, n: `n` words from each start): words of which every window
    stands elsewhere too."""
    texts = stored(
        scanned.where(F.size("anchors") > 0).groupBy("key").agg(
            F.count("*").alias("copies"), F.min("doc_id").alias("doc_id"),
            F.first("anchors").alias("anchors"), F.first("runs").alias("runs"),
        ),
        "texts",
    )
    occurrences = texts.select("key", F.explode(F.arrays_zip("anchors", "runs")).alias("z")).select(
        "key", F.col("z.anchors").alias("anchor"), F.col("z.runs").alias("run")
    )
    # Written, so that the join deals both sides anew and can split a common anchor.
    repeated = stored(occurrences.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "anchors")
    hits = stored(occurrences.join(repeated, "anchor"), "hits")
    total = hits.count()
    shards = max(1, -(-total // shard_passages))
    marks = hits.groupBy("key").agg(
        F.collect_list(F.struct("run", F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int").alias("shard"), (F.col("n") > most).alias("hot"))).alias("marks")
    )
    # One row of each text: that of its smallest id, and of repeated rows any.
    wanted = marks.join(texts.select("key", F.col("doc_id").alias("rep_id")), "key")
    text = text_or_empty(text_col)
    rows = docs.select(F.unhex(F.sha2(text, 256)).alias("key"), F.col(id_col).cast("long").alias("row_id"), text.cast("binary").alias("text"))
    same = (rows["key"] == wanted["key"]) & rows["row_id"].eqNullSafe(wanted["rep_id"])
    suspects = stored(
        rows.join(wanted, same).select(wanted["key"], "text", "marks").dropDuplicates(["key"]), "suspects"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1, 4 << 20):
                rows = []
                texts = [t.split() for t in batch.column(1).to_pylist()]
                for key, split, hashes, found in zip(batch.column(0).to_pylist(), texts, word_hashes(texts), batch.column(2).to_pylist()):
                    twice, equal = None, {}
                    for m in found:
                        first, size = m["run"] >> 6, m["run"] & 63
                        if not m["hot"]:
                            rows.append((key, m["shard"], [first], b" ".join(split[first : first + size + width - 1]), None, None))
                            continue
                        if twice is None:
                            twice = np.stack([rolling(hashes, width, x) for x in (MULTIPLIER, MIX)], axis=1)
                        windows = twice[first : first + size].tobytes()
                        # equal passages of a text are one row
                        equal.setdefault(windows, []).append(first)
                    for windows, starts in equal.items():
                        hashed = [windows[i : i + 16] for i in range(0, len(windows), 16)]
                        rows.append((key, None, starts, None, hashed, xxhash.xxh3_128_digest(windows)))
                if rows:
                    kinds = (pa.binary(), pa.int32(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.binary()), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                        names=["key", "shard", "starts", "words", "hashed", "whole"],
                    )

    layout = "key binary, shard int, starts array<int>, words binary, hashed array<binary>, whole binary"
    passages = stored(suspects.mapInArrow(cut, layout), "passages")

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        rows = [
            (key, [start + a], b - a)
            for key, start, found in zip(frame["key"], frame["start"].tolist(), shard_intervals(frame["words"].tolist(), width))
            for a, b in found
        ]
        return pd.DataFrame(rows, columns=["key", "starts", "n"])

    hot = hits.where(F.col("n") > most).limit(1).count() > 0
    single = passages.where("shard is not null").select("key", "shard", F.get("starts", F.lit(0)).alias("start"), "words")
    found = single.groupBy("shard").applyInPandas(solve, "key binary, starts array<int>, n int")
    if hot:
        found = found.unionByName(_hot_intervals(passages.where("whole is not null"), width, most))
    return texts.select("key", "copies"), suspects.select("key", "text"), found


def _hot_intervals(passages: DataFrame, width: int, most: int) -> DataFrame:
    """Repeated intervals of passages (key, starts in its text, hashed: its windows' hashes, whole: hash
    of these; one row a text and passage).

    Passages that occur twice are done with; of each of these one stays to be counted, and of the
    others the windows that occur twice are reported. Passages with more than `most` rows are sent to the
    rows, which stay where they are: they are at most one in `most` rows.
    """
    times = passages.groupBy("whole").agg(
        F.count("*").alias("n"), F.max(F.size("starts")).alias("inside"), F.min("key").alias("one")
    )
    common = F.broadcast(times.where(F.col("n") > most))
    rare = times.where(F.col("n") <= most)
    own = ["key", "starts", "hashed", "whole"]
    often = passages.join(common, "whole").select(*own, "n", "inside", "one")
    seldom = passages.join(common.select("whole"), "whole", "left_anti").join(rare, "whole").select(*own, "n", "inside", "one")
    counted = often.union(seldom)
    repeats = (F.col("n") > 1) | (F.col("inside") > 1)
    length = F.size("hashed") + width - 1
    # a passage that a text repeats stays one row with all its starts
    copies = counted.where(repeats).select("key", "starts", length.alias("n"))
    windows = counted.where(F.col("one") == F.col("key")).select(
        "key", F.get("starts", F.lit(0)).alias("start"), repeats.alias("done"), F.posexplode("hashed").alias("at", "w")
    )
    twice = windows.groupBy("w").agg(F.count("*").alias("times")).where("times > 1").select("w")
    begin = F.array(F.col("start") + F.col("at"))
    single = windows.where("not done").join(twice, "w").select("key", begin.alias("starts"), F.lit(width).alias("n"))
    return copies.unionByName(single)


def without_repeats(
    docs: DataFrame, width: int = 35, shard_passages: int = 8192, most: int = 2048,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Remove every word inside a window of `width` words that starts anywhere else too.

    Returns (doc_id, n_words, n_removed, kept_sha256 hex, kept binary): one row for every row of
    `docs`; `kept` holds the words that stay joined by a space where some are removed but not all, and
    is null where all or none are. All windows are judged on the input. Words are what stands between
    ASCII white space, unchanged; null and empty texts have none, shorter texts no window. Repeated
    rows are copies of one another and lose every window. An empty table gives no rows.
    """
    if not ANCHOR < width < 64:
        raise ValueError(f"width must be above {ANCHOR} and below 64")
    scanned = stored(scan(docs, width, id_col, text_col), "scanned")
    texts, suspects, found = repeated_intervals(docs, scanned, width, shard_passages, most, id_col, text_col)
    intervals = found.groupBy("key").agg(F.collect_list(F.struct("starts", "n")).alias("parts"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1, 8 << 20):
                removed, digests, kept = [], [], []
                for text, parts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    words = text.split()
                    step = np.zeros(len(words) + 1, dtype=np.int64)
                    starts = np.array([a for p in parts for a in p["starts"]], dtype=np.int64)
                    sizes = np.repeat([p["n"] for p in parts], [len(p["starts"]) for p in parts])
                    np.add.at(step, starts, 1)
                    np.add.at(step, starts + sizes, -1)
                    stays = np.flatnonzero(np.cumsum(step[:-1]) == 0)
                    left = b" ".join([words[i] for i in stays.tolist()])
                    removed.append(len(words) - len(stays))
                    digests.append(hashlib.sha256(left).digest())
                    kept.append(left)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(removed, pa.int32()), pa.array(digests, pa.binary()), pa.array(kept, pa.binary())],
                    names=["key", "n_removed", "sha", "kept"],
                )

    cut = suspects.join(intervals, "key").select("key", "text", "parts").mapInArrow(
        remove, "key binary, n_removed int, sha binary, kept binary"
    )
    outcome = texts.join(cut, "key", "left").where("copies > 1 or n_removed > 0")
    whole = F.col("copies") > 1  # exact copies of at least one window repeat each other throughout
    all_gone = F.coalesce(whole, F.lit(False))
    nothing = F.unhex(F.sha2(F.lit(""), 256))
    return scanned.select("doc_id", "key", "n_words", "words_sha").join(outcome, "key", "left").select(
        "doc_id", "n_words",
        F.when(all_gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.lower(F.hex(F.when(all_gone, nothing).otherwise(F.coalesce("sha", "words_sha")))).alias("kept_sha256"),
        F.when(~all_gone, F.col("kept")).alias("kept"),
    )
