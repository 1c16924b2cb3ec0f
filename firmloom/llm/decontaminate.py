"""Benchmark decontamination by a distributed positional inverted index.

The training texts are indexed in segments, each the work of one task: a segment lists its
terms and, for every term, the ascending positions at which it stands. Positions run through
all documents of the segment with a gap between two documents, so that no match can reach
from one into the next. The index is a table in the shared folder and can be asked again.

Benchmark windows are looked up segment by segment: starting with the posting list of a
window's rarest term, the lists of the other terms, shifted by their offset in the window, are
intersected from rare to frequent, all windows at once. What is left are exact phrases. With
distances instead of offsets, the same lists give proximity matches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmloom.llm.common import row_key, slices, stored, text_or_empty

#: Bytes of lower-case words; everything else becomes a space. Fixed by the definition of a word.
WORD_BYTES = frozenset([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
TO_WORDS = bytes(b if b in WORD_BYTES else 0x20 for b in (bytes([n]).lower()[0] for n in range(256)))
#: Positions between two documents, so that no phrase runs on.
GAP = 64
INDEX = (
    "doc_ids array<long>, row_keys array<long>, n_words array<int>, terms binary, ends binary, positions binary"
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TO_WORDS).split()


def build_index(docs: DataFrame, segment_bytes: int = 8 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a segment of about `segment_bytes` of text (a longer text is a segment of its own):
    ids and word counts of its documents in order, its terms (sorted, one a line), where the posting
    list of each ends, and the lists themselves as 32-bit steps, one after the other."""
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), row_key(text_col).alias("row_key"),
        text_or_empty(text_col).cast("binary").alias("text"),
    )

    def segment(batch: pa.RecordBatch) -> tuple:
        counts, parts = [], []
        for text in batch.column(2):
            # words of one text at a time: as Python objects they take some ten times its size
            parts.append(pa.array(words_of(text.as_py()), pa.binary()))
            counts.append(len(parts[-1]))
        words = pa.chunked_array(parts, pa.binary()).combine_chunks()
        del parts
        coded = words.dictionary_encode()
        del words
        terms = coded.dictionary.to_numpy(zero_copy_only=False)
        order = np.argsort(terms)
        rank = np.empty(len(terms), dtype=np.int32)
        rank[order] = np.arange(len(terms), dtype=np.int32)
        codes = rank[coded.indices.to_numpy()] if len(terms) else np.zeros(0, dtype=np.int32)
        n = np.array(counts, dtype=np.int64)
        where = np.arange(len(codes), dtype=np.int64) + np.repeat(np.arange(len(n)) * GAP, n)
        by_term = np.argsort(codes, kind="stable")
        lists = where[by_term].astype(np.int32)
        ends = np.cumsum(np.bincount(codes, minlength=len(terms))).astype(np.int32)
        steps = np.diff(lists, prepend=np.int32(0))
        steps[ends[:-1]] = lists[ends[:-1]]  # every list starts anew
        return (
            batch.column(0), batch.column(1), pa.array(n, pa.int32()), b"\n".join(terms[order].tolist()),
            ends.tobytes(), steps.tobytes(),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2, segment_bytes):
                ids, keys, n, terms, ends, steps = segment(batch)
                lists = [
                    pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (ids, keys, n)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*lists, *[pa.array([x], pa.binary()) for x in (terms, ends, steps)]],
                    names=["doc_ids", "row_keys", "n_words", "terms", "ends", "positions"],
                )

    return narrow.mapInArrow(run, INDEX)


@dataclass
class Windows:
    """Windows of consecutive words of the items of one block."""

    items: list  # id of each item
    terms: list[bytes]  # distinct
    item: np.ndarray  # of each window
    words: np.ndarray  # windows x width: number of the term, -1 behind a shorter window
    size: np.ndarray  # words of each window


def windows_of(items: list[tuple], width: int) -> Windows:
    """`items`: (id, text as bytes). Items without words have no window."""
    number: dict[bytes, int] = {}
    ids, item, rows, size = [], [], [], []
    for item_id, text in items:
        codes = [number.setdefault(w, len(number)) for w in words_of(text or b"")]
        for start in range(max(1, len(codes) - width + 1) if codes else 0):
            part = codes[start : start + width]
            item.append(len(ids))
            size.append(len(part))
            rows.append(part + [-1] * (width - len(part)))
        ids.append(item_id)
    shape = (len(rows), width)
    return Windows(
        ids, list(number), np.array(item, dtype=np.int64), np.array(rows, dtype=np.int64).reshape(shape),
        np.array(size, dtype=np.int64),
    )


class Segment:
    """Posting lists of the wanted terms of one segment."""

    def __init__(self, row: dict, wanted: list[bytes]):
        self.n = np.array(row["n_words"], dtype=np.int64)
        self.starts = np.cumsum(self.n + GAP) - self.n - GAP
        ends = np.frombuffer(row["ends"], dtype=np.int32).astype(np.int64)
        steps = np.frombuffer(row["positions"], dtype=np.int32)
        here = {t: i for i, t in enumerate(row["terms"].split(b"\n"))} if len(ends) else {}
        self.span = int(self.starts[-1] + self.n[-1]) + 2 * GAP if len(self.n) else 1
        parts, sizes = [], np.zeros(len(wanted), dtype=np.int64)
        for number, term in enumerate(wanted):
            i = here.get(term)
            if i is not None:
                part = np.cumsum(steps[(ends[i - 1] if i else 0) : ends[i]], dtype=np.int64)
                parts.append(part + number * self.span)
                sizes[number] = len(part)
        #: All lists in one ascending array: a term's positions stand behind number * span.
        self.lists = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
        self.sizes = sizes
        self.first = np.cumsum(sizes) - sizes

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, side="right") - 1

    def nearest(self, terms: np.ndarray, positions: np.ndarray) -> np.ndarray:
        """Distance from each position to the nearest posting, in the same document, of the term beside it."""
        at = np.searchsorted(self.lists, terms * self.span + positions)
        doc = self.document(positions)
        low, high = self.starts[doc], self.starts[doc] + self.n[doc]
        best = np.full(len(positions), self.span)
        for side in (at - 1, at):
            ok = (side >= self.first[terms]) & (side < self.first[terms] + self.sizes[terms])
            found = self.lists[np.where(ok, side, 0)] - terms * self.span if len(self.lists) else side
            ok &= (found >= low) & (found < high)
            best = np.where(ok, np.minimum(best, np.abs(found - positions)), best)
        return best

    def matches(self, w: Windows, slop: int | None = None, most: int = 1 << 20) -> Iterator[tuple]:
        """(window, position) of exact phrases, position that of the first word; with `slop`, of
        occurrences of a window's rarest term that have every other term of the window within
        (words of the window + slop) words. At most about `most` postings are looked at together."""
        if not len(w.words):
            return
        sizes = np.where(w.words >= 0, self.sizes[w.words], np.iinfo(np.int64).max)
        alive = np.flatnonzero(sizes.min(axis=1) > 0)
        order = np.argsort(sizes[alive], axis=1, kind="stable")
        lead = w.words[alive, order[:, 0]]
        load = np.cumsum(self.sizes[lead])
        for part in np.split(np.arange(len(alive)), np.searchsorted(load, np.arange(most, load[-1], most)) if len(load) else []):
            counts = self.sizes[lead[part]]
            local = np.repeat(part, counts)
            inside = np.arange(len(local)) - np.repeat(np.cumsum(counts) - counts, counts)
            anchor = self.lists[self.first[lead[local]] + inside] - lead[local] * self.span
            start = anchor - order[local, 0]
            for r in range(1, w.words.shape[1]):
                if not len(local):
                    break
                offset = order[local, r]
                term = w.words[alive[local], offset]
                real = term >= 0
                if slop is None:
                    key = np.where(real, term, 0) * self.span + start + offset
                    at = np.minimum(np.searchsorted(self.lists, key), len(self.lists) - 1)
                    ok = ~real | ((self.lists[at] == key) & (start >= 0))
                else:
                    reach = w.size[alive[local]] + slop
                    ok = ~real | (self.nearest(np.where(real, term, 0), anchor) <= reach)
                local, start, anchor = local[ok], start[ok], anchor[ok]
            if len(local):
                yield alive[local], start if slop is None else anchor


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple]]:
    """The items in blocks of about `block_bytes`, so that what goes to the tasks is bounded."""
    rows = items.count(), items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-(rows[1] + 64 * rows[0]) // block_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        yield [(r[0], bytes(r[1]) if r[1] is not None else None) for r in items.where(part == k).collect()]


def phrase_matches(
    index: DataFrame, items: DataFrame, width: int = 10, slop: int | None = None,
    block_bytes: int = 16 << 20, item_col: str = "item_id", text_col: str = "text",
) -> DataFrame:
    """Look all windows of `width` words of `items` up in an index.

    Returns (doc_id, row_key, n_words, n_hit, items array<string>, spans array<struct<item_id,
    start, words>>), one row for every indexed document, those without a match included. n_hit
    counts its words inside occurrences; spans are the occurrences (first word from 0, words).
    With `slop`, occurrences are proximity matches (`Segment.matches`), at the rarest term and of
    one word. An item of fewer words is one window, one without words none. Items go to the tasks
    in blocks of `block_bytes`, one pass over the index each; repeated items and ties all count.
    """
    texts = items.select(F.col(item_col).cast("string").alias("item_id"), F.col(text_col).cast("binary").alias("text"))
    layout = (
        "doc_id long, row_key long, n_words int, spans array<struct<item_id:string,start:int,words:int>>"
    )
    passes = []
    for block in _blocks(texts, block_bytes):
        w = windows_of(block, width)

        def run(batches: Iterator[pa.RecordBatch], w: Windows = w) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    segment = Segment(row, w.terms)
                    spans: dict[int, list] = {}
                    for window, start in segment.matches(w, slop):
                        doc = segment.document(start)
                        size = w.size[window] if slop is None else np.ones(len(window), dtype=np.int64)
                        for d, i, s, n in zip(doc.tolist(), w.item[window].tolist(), (start - segment.starts[doc]).tolist(), size.tolist()):
                            spans.setdefault(d, []).append({"item_id": w.items[i], "start": s, "words": n})
                    yield pa.RecordBatch.from_pandas(
                        pd.DataFrame({"doc_id": pd.Series(row["doc_ids"], dtype="object"), "row_key": row["row_keys"], "n_words": row["n_words"],
                                      "spans": [spans.get(d, []) for d in range(len(row["doc_ids"]))]}),
                        schema=pa.schema([
                            ("doc_id", pa.int64()), ("row_key", pa.int64()), ("n_words", pa.int32()),
                            ("spans", pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int32()), ("words", pa.int32())]))),
                        ]),
                        preserve_index=False,
                    )

        passes.append(index.mapInArrow(run, layout))
    found = passes[0]
    if len(passes) > 1:
        # The passes of one document meet again: each gives it one row, in the order of repeated rows.
        found = passes[0]
        for more in passes[1:]:
            found = found.unionByName(more)
        n = len(passes)
        grouped = found.groupBy("doc_id", "row_key", "n_words").agg(
            F.flatten(F.collect_list("spans")).alias("all"), (F.count("*") / n).cast("int").alias("copies")
        )
        found = grouped.select(
            "doc_id", "row_key", "n_words", F.array_distinct("all").alias("spans"),
            F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
        ).drop("copy")
    # Overlapping occurrences count once: in order of start, each adds what lies behind the last end.
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("a"), (s["start"] + s["words"]).alias("b"))))
    covered = F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(acc["end"], s["a"]))).alias("n"),
            F.greatest(acc["end"], s["b"]).alias("end"),
        ),
    )["n"]
    return found.select(
        "doc_id", "row_key", "n_words", covered.alias("n_hit"),
        F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["item_id"]))).alias("items"), "spans",
    )


def contamination(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`phrase_matches` of `items` in a new index of `docs`, with `contaminated` (n_hit > 0).

    Null and empty texts have no words and are clean; null item ids count as items but are named
    by no list; repeated rows give a row each; empty tables give no rows or no matches.
    """
    index = stored(build_index(docs, id_col=id_col, text_col=text_col), "index")
    return phrase_matches(index, items, width).withColumn("contaminated", F.col("n_hit") > 0)


def without_contaminated(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` in which no window of an item occurs, unchanged."""
    bad = (
        contamination(docs, items, width, id_col, text_col).where("contaminated")
        .select(F.col("doc_id").alias("__id"), F.col("row_key").alias("__key")).distinct()
    )
    match = F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (row_key(text_col) == F.col("__key"))
    return docs.join(bad, match, "left_anti")
