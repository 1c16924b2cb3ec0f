"""Exact token counts of every prefix of a text, by prefix dynamic programming.

The pre-tokenisation pattern cuts before every single space between two other
characters, so a text falls into chunks (a space and what follows it) that are encoded
independently. `PrefixBpe` gives the token count of each prefix of a piece; strung
together these are the counts of all prefixes of the text. They are kept as the
differences from one character to the next (mostly 0 or 1), so that truncation and
budget questions need a running sum and no encoder.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmloom.llm.bpe import PrefixBpe
from firmloom.llm.common import slices, text_or_empty

#: The pattern of byte-level vocabularies; fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Contractions of three characters: cut after two they are two pieces.
LONG_CONTRACTIONS = ("'re", "'ve", "'ll")


class PrefixCounter(dict):
    """Maps a chunk to the count differences of its prefixes: a line break and a word, or a word
    that stands for itself with a space before it.

    Chunks that may not stand alone (empty, or more white space at an end) map to None. The
    dictionary is a cache of at most two generations of `room` chunks.
    """

    def __init__(self, path: str, room: int = 300_000):
        super().__init__()
        self.bpe, self.room, self.old = PrefixBpe(path), room, {}
        self.pattern = regex.compile(PATTERN)
        self.spaces = frozenset(c for c in map(chr, range(0x3001)) if regex.match(r"\s", c))
        self.two_spaces = regex.compile(r"\s\s")
        self.pieces: dict[str, bytes | None] = {}
        with open(path, encoding="utf-8") as f:
            special = [t["content"] for t in json.load(f)["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def __missing__(self, chunk: str) -> bytes | None:
        made = self.old.pop(chunk, 0)
        if made == 0:
            made = None
            word = chunk[1:] if chunk[:1] == "\n" else chunk
            if word and not word[0].isspace() and not word[-1].isspace() and not self.two_spaces.search(word):
                parts = [self._steps(p) for p in self.pattern.findall(chunk if word is not chunk else " " + chunk)]
                made = None if None in parts else b"".join(parts)
        if len(self) >= self.room:
            self.old = dict(self)
            self.clear()
        self[chunk] = made
        return made

    def _piece(self, piece: str) -> list[int]:
        """Token count of every prefix (in characters) of one piece."""
        data = piece.encode()
        found = self.bpe.counts(data)
        if len(data) > len(piece):
            found = [n for n, b in zip(found, [*data[1:], 0]) if b & 0xC0 != 0x80]
        if piece in LONG_CONTRACTIONS:
            found[1] = 2
        return found

    def _steps(self, piece: str) -> bytes | None:
        """Differences of `_piece` as bytes; None where one does not fit a byte."""
        found = self.pieces.get(piece, 0)
        if found == 0:
            counts = self._piece(piece)
            try:
                found = bytes([counts[0], *[(b - a) & 255 if -128 <= b - a < 128 else 256 for a, b in zip(counts, counts[1:])]])
            except ValueError:
                found = None
            if len(self.pieces) >= self.room:
                self.pieces.clear()
            self.pieces[piece] = found
        return found

    def prefix_counts(self, text: str) -> list[int]:
        """Token count of every prefix of a text without special strings.

        A run of white space is one piece where the text ends with it, but gives its last
        character away where more text follows: its end is counted anew.
        """
        out: list[int] = []
        total, base, run = 0, 0, ""
        for piece in self.pattern.findall(text):
            counts = self._piece(piece)
            if piece[0] in self.spaces and piece[-1] in self.spaces:
                if run:
                    out.extend(base + self._piece(run + piece[: m + 1])[-1] for m in range(len(piece)))
                else:
                    base = total
                    out.extend(total + c for c in counts)
                run += piece
            else:
                at = len(out)
                out.extend(total + c for c in counts)
                if run and piece[0] in self.spaces:
                    out[at] = base + self._piece(run + piece[0])[-1]
                run = ""
            total += counts[-1]
        return out

    def deltas(self, text: str) -> np.ndarray:
        """Differences of the token counts of all prefixes, one for each character."""
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        out, at = [], 0
        for found in self.special.finditer(text):
            before = text[at : found.start()]
            head = self._plain(before)
            # Cut inside the special string, it is ordinary text behind what stands before it.
            begun = np.array(self.prefix_counts(before + found[0][:-1])[len(before) :], dtype=np.int64)
            done = int(head.sum())
            out += [head, np.diff(np.concatenate([[done], begun, [done + 1]]))]
            at = found.end()
        return np.concatenate([*out, self._plain(text[at:])])

    def _plain(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=np.int8)
        # Line breaks become chunks of their own; where one stood beside a space, a chunk is empty.
        chunks = text.replace("\n", " \n").split(" ")
        parts = [self[c] for c in chunks[1:]]
        first = chunks[0]
        if None in parts or not first or first[-1].isspace():
            return np.diff(np.array(self.prefix_counts(text), dtype=np.int64), prepend=0)
        head = np.diff(np.array(self.prefix_counts(first), dtype=np.int64), prepend=0)
        rest = np.frombuffer(b"".join(parts), dtype=np.int8)
        return np.concatenate([head.astype(np.int8) if np.abs(head).max() < 128 else head, rest])


@functools.lru_cache(maxsize=2)
def _counter(path: str) -> PrefixCounter:
    """One for each worker process, kept from task to task."""
    return PrefixCounter(path)


def _narrow(counts: list[int]) -> bytes:
    """Differences as bytes: a 0 and one byte each, or a 1 and two bytes each where one needs it."""
    steps = np.diff(np.array(counts, dtype=np.int64), prepend=0)
    return b"\0" + steps.astype(np.int8).tobytes() if np.abs(steps).max(initial=0) < 128 else b"\1" + steps.astype(np.int16).tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.int16 if data[0] else np.int8, offset=1)


def counts_of(prefix_deltas: bytes) -> np.ndarray:
    """Token counts of all prefixes of 1, 2, ... characters, from the stored column."""
    return np.cumsum(_wide(prefix_deltas), dtype=np.int64)


def tokens_at(prefix_deltas: bytes, chars: int) -> int:
    """Tokens of the text cut off after `chars` characters."""
    return int(_wide(prefix_deltas)[:chars].sum(dtype=np.int64))


def cut_at(prefix_deltas: bytes, budget: int) -> int:
    """The longest prefix, in characters, of at most `budget` tokens."""
    fits = np.flatnonzero(counts_of(prefix_deltas) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def prefix_token_counts(
    docs: DataFrame, vocabulary: str, budget: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, chars_in_budget, prefix_deltas) for every row of `docs`.

    `vocabulary` is the path of a byte-level vocabulary on every executor. `prefix_deltas`
    holds the exact count at every character (see `counts_of`, `tokens_at`, `cut_at`);
    `chars_in_budget` is the longest prefix of at most `budget` tokens. Null text counts as
    empty: 0 everywhere. Other columns of `docs` are left out; repeated rows stay.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for whole in batches:
            for batch in slices(whole, 1, 4 << 20):
                sizes, totals, cuts, kept = [], [], [], []
                for data in batch.column(1).to_pylist():
                    steps = counter.deltas(data.decode())
                    counts = np.cumsum(steps, dtype=np.int64)
                    total = int(counts[-1]) if len(counts) else 0
                    sizes.append(len(data))
                    totals.append(total)
                    fits = np.flatnonzero(counts <= budget) if total > budget else ()
                    cuts.append(len(counts) if total <= budget else int(fits[-1]) + 1 if len(fits) else 0)
                    kept.append(
                        (b"\0" + steps.tobytes()) if steps.dtype == np.int8 else _narrow(counts.tolist())
                    )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()),
                     pa.array(cuts, pa.int64()), pa.array(kept, pa.binary())],
                    names=["doc_id", "n_bytes", "n_tokens", "chars_in_budget", "prefix_deltas"],
                )

    return narrow.mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, chars_in_budget long, prefix_deltas binary"
    )
