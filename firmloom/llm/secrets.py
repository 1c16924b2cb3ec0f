"""Secret scans: fixed patterns, and formats learned from what they find by grammar inference.

The credentials that the patterns find are the labelled examples. A prefix tree of a bounded
sample of each kind is generalised: states whose continuations are statistically compatible
(Hoeffding bounds on ending and on every next character, followed down the tree) are merged,
which leaves a small probabilistic automaton per kind. Every long run of key characters in
every text that no pattern covers is a candidate; it is reported where an automaton explains it
as well as its examples and much better than the character pairs of ordinary text do.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmloom.llm.common import row_key, slices, stored, text_or_empty

#: The patterns of the base scan and the order of kinds; fixed values.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")  # AKIA and more, 16 characters at least
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "format")
#: Without one of these, in lower case, a text holds no assignment.
ASSIGN_HINTS = (b"passw", b"secret", b"token", b"api")
HEX_BYTES = re.compile(HEX.pattern.encode())

#: Candidates: runs of key characters of this length at least.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
CANDIDATE_BYTES = re.compile(CANDIDATE.pattern.encode())
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
NUMBER = np.full(256, len(LETTERS), dtype=np.int64)
NUMBER[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))
WIDTH = len(LETTERS) + 1  # one more for all other bytes
#: Pairs of characters numbered at a time: they take some thirty times the text.
PAIRS = 1 << 18


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value) of the base scan, by start and then kind."""
    found = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def scan(data: bytes) -> tuple[list, list]:
    """Base spans, and (start, end, value) of the candidates that touch none of them."""
    low = data.lower()
    base = any(h in low for h in ASSIGN_HINTS) or b"AKIA" in data or HEX_BYTES.search(data)
    if not base and not CANDIDATE_BYTES.search(data):
        return [], []
    text = data.decode()
    spans, free, at = base_spans(text) if base else [], [], 0
    for m in CANDIDATE.finditer(text):
        while at < len(spans) and max(s[2] for s in spans[at : at + 1]) <= m.start():
            at += 1
        if not any(a < m.end() and m.start() < b for a, _, b, _ in spans[at:]):
            free.append((m.start(), m.end(), m[0]))
    return spans, free


@dataclass
class Automaton:
    """A probabilistic automaton: per state arrivals, endings and counted transitions."""

    seen: list[int] = field(default_factory=lambda: [0])
    ends: list[int] = field(default_factory=lambda: [0])
    counts: list[dict[str, int]] = field(default_factory=lambda: [{}])
    to: list[dict[str, int]] = field(default_factory=lambda: [{}])

    def add(self, value: str) -> None:
        state = 0
        self.seen[0] += 1
        for c in value:
            self.counts[state][c] = self.counts[state].get(c, 0) + 1
            if c not in self.to[state]:
                self.to[state][c] = len(self.seen)
                self.seen.append(0)
                self.ends.append(0)
                self.counts.append({})
                self.to.append({})
            state = self.to[state][c]
            self.seen[state] += 1
        self.ends[state] += 1

    def _compatible(self, a: int, b: int, bound: float) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.seen[a], self.seen[b]
            if not n or not m:
                continue
            most = bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ends[a] / n - self.ends[b] / m) > most:
                return False
            left, right = self.counts[a], self.counts[b]
            if any(abs(left.get(c, 0) / n - right.get(c, 0) / m) > most for c in {*left, *right}):
                return False
            todo += [(self.to[a][c], s) for c, s in self.to[b].items() if c in self.to[a]]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Merge the tree below b into a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.seen[a] += self.seen[b]
            self.ends[a] += self.ends[b]
            for c, n in self.counts[b].items():
                self.counts[a][c] = self.counts[a].get(c, 0) + n
            for c, s in self.to[b].items():
                if c in self.to[a]:
                    todo.append((self.to[a][c], s))
                else:
                    self.to[a][c] = s

    def merge_states(self, alpha: float = 0.01) -> Automaton:
        """Merge compatible states, in order from the root; `alpha` is the risk of each test."""
        bound = math.sqrt(0.5 * math.log(2 / alpha))
        red, edge = [0], sorted((c, 0) for c in self.to[0])
        done = {0}
        while edge:
            c, parent = edge.pop(0)
            state = self.to[parent][c]
            if state in done:
                continue
            match = next((r for r in red if self._compatible(r, state, bound)), None)
            if match is None:
                red.append(state)
                done.add(state)
                edge += sorted((x, state) for x in self.to[state])
            else:
                self.to[parent][c] = match
                self._fold(match, state)
                edge += sorted((x, r) for r in red for x, s in self.to[r].items() if s not in done and (x, r) not in edge)
        return self

    def score(self, value: str) -> float:
        """Log-likelihood a character, the ending left out; unseen characters cost a smoothed share."""
        state, total = 0, 0.0
        for c in value:
            n = self.seen[state]
            total += math.log((self.counts[state].get(c, 0) + 0.5 / len(LETTERS)) / (n + 0.5))
            state = self.to[state].get(c, 0)
        return total / max(1, len(value))


@dataclass
class Formats:
    """Automata of the kinds with enough examples, the background and each kind's two limits."""

    automata: list[Automaton]
    limits: list[tuple[float, float]]
    pairs: np.ndarray  # log-probability of a character after another in ordinary text

    def background(self, value: str) -> float:
        codes = NUMBER[np.frombuffer(value.encode(), dtype=np.uint8)]
        return float(self.pairs[np.concatenate([[WIDTH - 1], codes[:-1]]), codes].mean())

    def likely(self, value: str) -> bool:
        for automaton, (least, gain) in zip(self.automata, self.limits):
            score = automaton.score(value)
            if score >= least and score - self.background(value) >= gain:
                return True
        return False


def fit(examples: list[tuple[str, str]], pair_counts: np.ndarray, fewest: int = 20) -> Formats:
    """`examples`: (kind, value). Kinds with fewer than `fewest` get no automaton.

    A candidate must reach the lowest example's likelihood (but for the lowest 1 % and a tenth of a
    nat) and half the examples' median gain over the background.
    """
    smooth = pair_counts.astype(float) + 0.5
    pairs = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    made = Formats([], [], pairs)
    for kind in KINDS[:3]:
        values = sorted(v for k, v in examples if k == kind)
        if len(values) < fewest:
            continue
        tree = Automaton()
        for v in values:
            tree.add(v)
        automaton = tree.merge_states()
        scores = np.array([automaton.score(v) for v in values])
        gains = scores - np.array([made.background(v) for v in values])
        made.automata.append(automaton)
        made.limits.append((float(np.quantile(scores, 0.01)) - 0.1, max(0.5, float(np.median(gains)) / 2)))
    return made


SCANNED = (
    "doc_id long, row_key long, spans array<struct<start:int,kind:int,end:int,value:string>>, "
    "free array<struct<start:int,end:int,value:string>>, pairs array<long>"
)
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))
_FREE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document with its base spans and candidates, and one row a task with the counts of
    character pairs in all its texts (`pairs`, null in documents' rows)."""
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), row_key(text_col).alias("row_key"),
        text_or_empty(text_col).cast("binary").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(WIDTH * WIDTH, dtype=np.int64)
        names = ["doc_id", "row_key", "spans", "free", "pairs"]
        pairs = pa.list_(pa.int64())
        for whole in batches:
            for batch in slices(whole, 2, 8 << 20):
                texts = batch.column(2).to_pylist()
                data = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
                for at in range(0, len(data) - 1, PAIRS):
                    codes = NUMBER[data[at : at + PAIRS + 1]]
                    counts += np.bincount(codes[:-1] * WIDTH + codes[1:], minlength=WIDTH * WIDTH)
                found = [scan(t) for t in texts]
                spans = [[dict(start=a, kind=k, end=b, value=v) for a, k, b, v in s] for s, _ in found]
                free = [[dict(start=a, end=b, value=v) for a, b, v in f] for _, f in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(spans, _SPAN), pa.array(free, _FREE),
                     pa.nulls(len(texts), pairs)], names=names,
                )
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, _SPAN), pa.nulls(1, _FREE),
             pa.array([counts.tolist()], pairs)], names=names,
        )

    return narrow.mapInArrow(run, SCANNED)


def learn_formats(scanned: DataFrame, examples: int = 2000, longest: int = 128) -> Formats:
    """Fit the automata on at most `examples` different credentials a kind, of at most `longest`
    characters, drawn by hash; the background counts cover all texts."""
    names = F.element_at(F.array(*map(F.lit, KINDS)), F.col("s.kind") + 1)
    values = (
        scanned.select(F.explode("spans").alias("s")).select(names.alias("kind"), F.col("s.value").alias("value"))
        .where(F.length("value") <= longest).distinct()
    )
    sample = [
        (r.kind, r.value)
        for kind in KINDS[:3]
        for r in values.where(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(examples).collect()
    ]
    rows = scanned.where("pairs is not null").select(F.posexplode("pairs")).groupBy("pos").agg(F.sum("col").alias("n"))
    counts = np.zeros(WIDTH * WIDTH)
    for r in rows.where("n > 0").collect():
        counts[r.pos] = r.n
    return fit(sample, counts.reshape(WIDTH, WIDTH))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row_key, spans array<struct<start, kind, end>>) for every row of `docs`.

    Spans are in code points, end exclusive, kinds by number in KINDS, in order of start and kind.
    Base spans always stay; added ones touch none of them. Null and empty texts have none; without
    enough labelled credentials nothing is added; repeated rows stay; an empty table gives no rows.
    """
    scanned = stored(scan_documents(docs, id_col, text_col), "scanned")
    formats = learn_formats(scanned)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(
                free=[[c for c in free if formats.likely(c["value"])] for free in frame["free"]]
            )

    some = scanned.where(F.size("free") > 0)
    rest = scanned.where("pairs is null and size(free) = 0")
    scored = some.select("doc_id", "row_key", "spans", "free").mapInPandas(run, SCANNED.rpartition(",")[0])
    cut = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    more = F.transform("free", lambda s: F.struct(s["start"].alias("start"), F.lit(3).alias("kind"), s["end"].alias("end")))
    both = scored.select("doc_id", "row_key", F.array_sort(F.concat(cut, more)).alias("spans"))
    return both.unionByName(rest.select("doc_id", "row_key", cut.alias("spans")))


def redact(docs: DataFrame, mark: str = "[secret]", id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """`docs` with every secret in `text_col` replaced by `mark` (overlapping ones by one mark), and
    `length_col`, where it is there and not null, set to the new length. All other columns and all
    rows stay as they are; null text stays null."""
    formats = learn_formats(stored(scan_documents(docs, id_col, text_col), "scanned"))

    def clean(data: str | None) -> str | None:
        if not data:
            return data
        spans, free = scan(data.encode())
        found = sorted([(a, b) for a, _, b, _ in spans] + [(a, b) for a, b, v in free if formats.likely(v)])
        if not found:
            return data
        out, at = [], 0
        for a, b in found:
            if a >= at:
                out += [data[at:a], mark]
            at = max(at, b)
        return "".join([*out, data[at:]])

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        return texts.map(clean)

    before = docs.schema[text_col]
    out = docs.withColumn(text_col, cleaned(F.col(text_col).cast("string")).cast(before.dataType))
    if length_col in docs.columns:
        now = F.when(F.col(length_col).isNotNull(), F.length(text_col)).cast(docs.schema[length_col].dataType)
        out = out.withColumn(length_col, now)
    return out
