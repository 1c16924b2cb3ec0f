"""Longest common subsequence lengths for many string pairs at once.

Bit-parallel recurrence (Crochemore et al. 2001, Hyyro 2004) run with numpy
over whole Arrow batches: one machine word per 64 characters of the shorter
string, one vector step per character of the longer one. Any length is exact.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

# ship the functions themselves, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PAIRS = 50_000  # pairs whose words are compared at once
_CELLS = 400_000  # matrix cells per slice: keeps one step inside the processor cache


def _codes(strings: pa.Array, lengths: np.ndarray) -> np.ndarray:
    """Characters as a zero-padded matrix, one row per string."""
    width = int(lengths.max())
    if pc.all(pc.string_is_ascii(strings)).as_py():
        strings = strings.cast(pa.large_string())
        first = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset :][: len(strings)]
        data = np.frombuffer(strings.buffers()[2] or b"", np.uint8)
        column = np.arange(width)
        index = np.minimum(first[:, None] + column, len(data) - 1)
        return np.where(column < lengths[:, None], data[index], 0).astype(np.uint32)
    rows = np.array(strings.to_pylist(), dtype=f"U{width}")
    return rows.view(np.uint32).reshape(len(rows), width)


def _slice_lengths(short: pa.Array, long: pa.Array, ls: np.ndarray, ll: np.ndarray) -> np.ndarray:
    a, b = _codes(short, ls), _codes(long, ll)
    count, words = len(a), (a.shape[1] + 63) // 64
    # number the characters of the shorter strings; 0 is padding or not there
    symbol = np.zeros(max(int(a.max()), int(b.max())) + 1, np.int32)
    symbol[a] = 1
    symbol[0] = 0
    symbol[symbol > 0] = np.arange(1, int(symbol.sum()) + 1)
    width = int(symbol.max()) + 1
    base = np.arange(count, dtype=np.int32) * width
    at, bt = symbol[a.T] + base, symbol[b.T] + base
    masks = np.zeros((words, count * width), np.uint64)
    for position, cell in enumerate(at):
        masks[position // 64, cell] |= np.uint64(1 << (position % 64))
    masks[:, base] = 0
    state = np.full((words, count), ~np.uint64(0))
    for cell in bt:
        carry = None
        for word in range(words):
            row, mask = state[word], masks[word].take(cell)
            total = row + (row & mask)
            if words > 1:
                over = total < row
                if carry is not None:
                    total += carry
                    over |= total < carry
                carry = over.astype(np.uint64)
            state[word] = total | (row & ~mask)
    return 64 * words - np.bitwise_count(state).sum(axis=0, dtype=np.int64)


def lcs_of_pairs(left: pa.Array, right: pa.Array, own: np.ndarray | None = None) -> np.ndarray:
    """LCS length of left[own[i]] and right[i]; without `own`, of left[i] and right[i]."""
    result = np.zeros(len(right), np.int32)
    if not len(right):
        return result
    own = np.arange(len(right)) if own is None else own
    size = [pc.fill_null(pc.utf8_length(x), 0).to_numpy(zero_copy_only=False) for x in (left, right)]
    size[0] = size[0][own]
    swap = size[0] > size[1]
    ls, ll = np.minimum(*size), np.maximum(*size)
    order = np.flatnonzero(ls > 0)
    order = order[np.lexsort((ll[order], (ls[order] - 1) // 64))]
    both = pa.chunked_array([left, right]).combine_chunks()
    start = 0
    while start < len(order):
        # rows of similar width share a slice; the slice ends where the
        # padded matrices or the mask table would outgrow the cell budget
        word = (ls[order[start]] - 1) // 64 + 1
        cells = np.maximum(ll[order[start:]], 64 * word) * np.arange(1, len(order) - start + 1)
        fits = (cells <= _CELLS) & ((ls[order[start:]] - 1) // 64 + 1 == word)
        stop = start + max(1, len(fits) if fits.all() else int(np.argmin(fits)))
        pick = order[start:stop]
        mine, theirs = own[pick], pick + len(left)
        result[pick] = _slice_lengths(
            both.take(pa.array(np.where(swap[pick], theirs, mine))),
            both.take(pa.array(np.where(swap[pick], mine, theirs))),
            ls[pick],
            ll[pick],
        )
        start = stop
    return result


@arrow_udf(IntegerType())
def lcs_length(left: pa.Array, right: pa.Array) -> pa.Array:
    return pa.array(lcs_of_pairs(left, right), pa.int32())


def _words(text: str) -> tuple[list[str], set[str]]:
    """Distinct words of a name, ordered and as a set."""
    words = {w for w in text.split(" ") if w}
    return sorted(words), words


def _set_lengths(names: list[str], others: list[str]) -> list[np.ndarray]:
    """Lengths of the shared words of each pair, of the words only one side has, and the LCS length of those rests."""
    seen = {text: _words(text) for text in {*names, *others}}
    shared, left, right = [], [], []
    for name, other in zip(names, others):
        (mine, own), (theirs, its) = seen[name], seen[other]
        both = own & its
        shared.append(sum(map(len, both)) + max(len(both) - 1, 0))
        left.append(" ".join([w for w in mine if w not in both]))
        right.append(" ".join([w for w in theirs if w not in both]))
    common = lcs_of_pairs(pa.array(left, pa.string()), pa.array(right, pa.string()))
    return [np.array(shared), *(np.fromiter(map(len, x), np.int64, len(x)) for x in (left, right)), common]


LENGTHS = ("sort_lcs", "shared", "own", "other", "set_lcs")


@arrow_udf(ArrayType(StructType([StructField(f, IntegerType()) for f in LENGTHS])))
def score_lengths(name: pa.Array, others: pa.Array) -> pa.Array:
    """What both token scores of a name with every element of an array need; names with their words in order."""
    own = pc.list_parent_indices(others).to_numpy(zero_copy_only=False)
    flat = others.flatten()
    found = [np.zeros(len(flat), np.int32) for _ in LENGTHS]
    found[0][:] = lcs_of_pairs(name, flat, own)
    mine = name.to_pylist()
    for start in range(0, len(flat), _PAIRS):
        at = slice(start, start + _PAIRS)
        lengths = _set_lengths([mine[i] for i in own[at]], flat[at].to_pylist())
        for column, values in zip(found[1:], lengths):
            column[at] = values
    sizes = pc.fill_null(pc.list_value_length(others), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(x, pa.int32()) for x in found], LENGTHS))
