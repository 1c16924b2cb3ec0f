"""The best-scoring of many names for each of many others, without scoring them all.

Inverted lists of tokens give the words a pair shares, and letter counts bound its common
subsequence, so every pair has an upper bound of its score at the price of a few vector steps.
Names are then scored in order of their bounds until no bound left can win. Scores are those of
`firmloom.functions.similarity`, number for number.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql.functions import arrow_udf

from firmloom.functions.lcs import lcs_of_pairs

# ship the functions themselves, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Names and sources looked at together: bounds the table of bounds at 16 MB.
NAMES, SOURCES = 4096, 512
#: Letters told apart; all others share one counter, which keeps bounds valid.
LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789"
SCORES = "array<struct<source:int,name:int,token_sort_ratio:double,token_set_ratio:double>>"


class Words:
    """Token sets, sorted strings, lengths and letter counts of a list of cleaned names."""

    def __init__(self, names: list[str]):
        split = [n.split(" ") for n in names]
        self.ordered = pa.array([" ".join(sorted(t)) for t in split], pa.string())
        self.sets = [sorted({w for w in t if w}) for t in split]
        self.lengths = np.array([len(n) for n in names])
        self.gaps = np.array([len(t) - 1 for t in split])
        self.count = np.array([len(s) for s in self.sets])
        self.size = np.array([sum(map(len, s)) for s in self.sets])
        counts = np.zeros((len(LETTERS) + 1, len(names)), dtype=np.int32)
        for k, letter in enumerate(LETTERS):
            counts[k] = [n.count(letter) for n in names]
        counts[-1] = self.lengths - self.gaps - counts.sum(axis=0)
        self.letters = counts.astype(np.uint16) if counts.max(initial=0) < 1 << 16 else counts

    def lists(self) -> dict[str, np.ndarray]:
        """Inverted lists: the places of the names that hold a token."""
        found: dict[str, list[int]] = {}
        for place, tokens in enumerate(self.sets):
            for token in tokens:
                found.setdefault(token, []).append(place)
        return {t: np.array(p) for t, p in found.items()}


def ratio(total, common):
    return 100.0 * (1.0 - (total - 2 * common) / np.maximum(total, 1))


def set_score(shared, left, right, common):
    """`similarity.set_ratio` of four lengths; names here are never empty."""
    gap = shared > 0
    total = 2 * (shared + gap) + left + right
    whole = np.where(total > 0, 100.0 * (1.0 - (left + right - 2 * common) / np.maximum(total, 1)), 0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        one = 100.0 * (1.0 - (left + 1) / (2 * shared + gap + left))
        other = 100.0 * (1.0 - (right + 1) / (2 * shared + gap + right))
    score = np.where(gap, np.maximum(whole, np.maximum(one, other)), whole)
    return np.where(gap & ((left == 0) | (right == 0)), 100.0, score)


def _joined(size, count):
    """Length of words of `size` letters joined by spaces."""
    return size + np.maximum(count - 1, 0)


def bounds(source: Words, at: int, names: Words, lists: dict[str, np.ndarray]) -> np.ndarray:
    """Upper bounds of the combined score of one source with every name."""
    shared_count = np.zeros(len(names.sets), dtype=np.int64)
    shared_size = np.zeros(len(names.sets), dtype=np.int64)
    for token in source.sets[at]:
        places = lists.get(token)
        if places is not None:
            shared_count[places] += 1
            shared_size[places] += len(token)
    own = source.letters[:, at]
    used = np.flatnonzero(own)
    letters = np.minimum(names.letters[used], own[used, None]).sum(axis=0, dtype=np.int64)
    length = int(source.lengths[at])
    common = np.minimum(letters + np.minimum(source.gaps[at], names.gaps), np.minimum(length, names.lengths))
    sort = ratio(length + names.lengths, common)
    left_count, right_count = source.count[at] - shared_count, names.count - shared_count
    left = _joined(source.size[at] - shared_size, left_count)
    right = _joined(names.size - shared_size, right_count)
    gaps = np.maximum(np.minimum(left_count, right_count) - 1, 0)
    rest = np.minimum(np.minimum(left, right), letters - shared_size + gaps)
    return np.maximum(sort, set_score(_joined(shared_size, shared_count), left, right, rest))


def exact(source: Words, at: np.ndarray, names: Words, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both scores of the pairs (at[i], to[i])."""
    common = lcs_of_pairs(source.ordered, names.ordered.take(pa.array(to)), at)
    sort = ratio(source.lengths[at] + names.lengths[to], common)
    left, right, shared = [], [], []
    for i, j in zip(at.tolist(), to.tolist()):
        mine, theirs = source.sets[i], names.sets[j]
        both = set(mine).intersection(theirs)
        shared.append(len(" ".join(both)))
        left.append(" ".join(w for w in mine if w not in both))
        right.append(" ".join(w for w in theirs if w not in both))
    rest = lcs_of_pairs(pa.array(left, pa.string()), pa.array(right, pa.string()))
    lengths = [np.fromiter(map(len, x), dtype=np.int64, count=len(x)) for x in (left, right)]
    return sort, set_score(np.array(shared, dtype=np.int64), *lengths, rest)


class Best:
    """The `k` best names of each source so far: by score, of equal scores by the names' first rows."""

    def __init__(self, sources: int, k: int):
        self.k = k
        self.score = np.full((sources, k), -1.0)
        self.first = np.full((sources, k), np.iinfo(np.int64).max)
        self.name = np.full((sources, k), -1)
        self.parts = np.zeros((sources, k, 2))

    def can_win(self, rows: slice, bound: np.ndarray, first: np.ndarray) -> np.ndarray:
        least, last = self.score[rows, -1:], self.first[rows, -1:]
        return (bound > least) | ((bound == least) & (first[None, :] < last))

    def add(self, at: np.ndarray, name: np.ndarray, first: np.ndarray, sort: np.ndarray, sets: np.ndarray) -> None:
        """New scored names, `at` ascending."""
        score = np.maximum(sort, sets)
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        for a, b in zip(starts, [*starts[1:], len(at)]):
            i = at[a]
            new_score = np.concatenate([self.score[i], score[a:b]])
            new_first = np.concatenate([self.first[i], first[a:b]])
            pick = np.lexsort((new_first, -new_score))[: self.k]
            self.score[i], self.first[i] = new_score[pick], new_first[pick]
            self.name[i] = np.concatenate([self.name[i], name[a:b]])[pick]
            self.parts[i] = np.concatenate([self.parts[i], np.column_stack([sort[a:b], sets[a:b]])])[pick]


def best_names(sources: list[str], names: list[str], firsts: list[int], k: int) -> list[dict]:
    """The `k` names of highest combined score for each source, ties to the smaller of `firsts`."""
    best = Best(len(sources), k)
    mine = [(s, Words(sources[s : s + SOURCES])) for s in range(0, len(sources), SOURCES)]
    for n in range(0, len(names), NAMES):
        theirs, first = Words(names[n : n + NAMES]), np.array(firsts[n : n + NAMES], dtype=np.int64)
        lists = theirs.lists()
        for s, source in mine:
            rows = slice(s, s + len(source.sets))
            table = np.stack([bounds(source, i, theirs, lists) for i in range(len(source.sets))])
            step = 4 * k
            while True:
                # the best bounds not yet scored that can win; more of them with each turn
                open_ = np.where(best.can_win(rows, table, first), table, -np.inf)
                step = min(step, open_.shape[1])
                pick = np.argpartition(-open_, step - 1, axis=1)[:, :step]
                at = np.repeat(np.arange(len(source.sets)), step)
                to = pick.ravel()
                live = open_[at, to] > -np.inf
                if not live.any():
                    break
                at, to = at[live], to[live]
                sort, sets = exact(source, at, theirs, to)
                table[at, to] = -np.inf
                best.add(at + s, to + n, first[to], sort, sets)
                step *= 4
    found = best.name >= 0
    return [
        {"source": int(i), "name": int(best.name[i, j]), "token_sort_ratio": float(best.parts[i, j, 0]), "token_set_ratio": float(best.parts[i, j, 1])}
        for i, j in zip(*np.nonzero(found))
    ]


def best_of(k: int):
    """Arrow function of (sources, names, firsts), arrays, giving SCORES: `best_names` of each row."""

    @arrow_udf(SCORES)
    def scored(sources: pa.Array, names: pa.Array, firsts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("source", pa.int32()), ("name", pa.int32()), ("token_sort_ratio", pa.float64()), ("token_set_ratio", pa.float64())]))
        rows = zip(sources.to_pylist(), names.to_pylist(), firsts.to_pylist())
        return pa.array([best_names(*row, k) for row in rows], kind)

    return scored
