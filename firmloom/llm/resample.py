"""Quality selection by importance resampling.

Hashed n-gram models of the target (a bounded sample of documents labelled good) and of the raw text
(all documents) count in how many documents each feature stands. A feature's log ratio compares target
and raw, smoothed, and times the probability that the two differ at all, so that every feature counts and
rare ones little. The log weight of a document is the mean of its features' log ratios, stated for a text
of LENGTH features, so that it does not fall with length. Each document is left out of the counts that
weigh it, which makes the labelled ones fit to choose the cut. Gumbel noise on the log weights and a cut
at the k-th largest sum draw k documents without replacement in proportion to their weights.

Features are lower-case words, pairs of words in a row, character n-grams of words, what is left of a word
without letters and digits (its marks), and runs of one word; each kind has its own buckets. A feature counts
once a document; marks and runs that stand in it 4, 16 and 64 times are features of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmloom.llm.common import row_key, slices, stored, text_or_empty

#: Buckets of each kind of feature: words, pairs of words, character n-grams of each length, marks.
BUCKETS, GRAMS = 1 << 18, (4, 5)
KINDS = 3 + len(GRAMS)
WIDTH = KINDS * BUCKETS
#: Text whose features are in memory at once: they take some hundred times its size, and a worker process
#: keeps what it once took.
BATCH_BYTES = 1 << 18
#: Runs of one word that are features, and how often marks and runs stand in a text to be one more feature.
RUNS, OFTEN = (3, 4, 5, 6, 8), (1, 4, 16, 64)
#: Beforehand, one feature in so many differs between target and raw text; what smooths its ratio.
ODD, SMOOTH = 1 / 100, 0.5
#: What losing a good document counts against keeping a bad one when the cut is chosen.
LOSS = 3.0
#: Log weights are stated for a text with this many features.
LENGTH = 1000.0

_PLAIN = bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
_MARKS = bytes(b for b in range(0x21, 0x7F) if b not in _PLAIN)


def _grams(bare: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the character n-grams of words, word after word, and how many each has; a word begins with a space."""
    text = (b" " + b" ".join(bare)).decode(errors="replace") if bare else ""
    chars = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    space = chars == 32
    starts = max(0, len(chars) - n + 1)
    inside, mixed = np.ones(starts, dtype=bool), np.zeros(starts, dtype=np.uint64)
    for k in range(n):
        inside &= ~space[k : k + starts] if k else True
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + chars[k : k + starts]
    word = (np.cumsum(space)[:starts] - 1)[inside]
    mixed = mixed[inside]
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9), np.bincount(word, minlength=len(bare))


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the features of each text, each once a text, and the text each belongs to."""
    words = [t.lower().split() for t in texts]
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    owner = np.repeat(np.arange(len(texts)), sizes)
    coded = pa.array([w for row in words for w in row], pa.binary()).dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    digest = xxhash.xxh64_intdigest
    known = coded.dictionary.to_pylist()
    bare = [w.strip(_MARKS) for w in known]
    hashes = np.array([digest(w) if w else 0 for w in bare], dtype=np.uint64)
    left = [w.translate(None, _PLAIN) for w in known]
    marks = np.array([digest(w, 1) % BUCKETS + (KINDS - 1) * BUCKETS if w else -1 for w in left], dtype=np.int64)

    once = np.unique(owner * max(1, len(known)) + codes)
    of, code = np.divmod(once, max(1, len(known)))
    parts = [(of[hashes[code] != 0], (hashes[code] % np.uint64(BUCKETS)).astype(np.int64)[hashes[code] != 0])]
    for k, size in enumerate(GRAMS):
        mixed, counts = _grams(bare, size)
        flat, begins = (mixed >> np.uint64(40)).astype(np.int64) % BUCKETS + (2 + k) * BUCKETS, np.cumsum(counts) - counts
        n = counts[code]
        inside = np.arange(int(n.sum())) + np.repeat(begins[code] - np.cumsum(n) + n, n)
        parts.append((np.repeat(of, n), flat[inside]))
    pair = (owner[1:] == owner[:-1]) & (hashes[codes[1:]] != 0) & (hashes[codes[:-1]] != 0)
    mixed = (hashes[codes[:-1]] * np.uint64(0x9E3779B97F4A7C15) + hashes[codes[1:]]) >> np.uint64(20)
    parts.append((owner[1:][pair], (mixed % np.uint64(BUCKETS)).astype(np.int64)[pair] + BUCKETS))
    begin = np.flatnonzero(np.diff(owner * max(1, len(known)) + codes, prepend=-1))
    run = np.arange(len(codes)) + 1 - np.repeat(begin, np.diff(begin, append=len(codes)))
    marked = [(owner[marks[codes] >= 0], marks[codes][marks[codes] >= 0])]
    marked += [(owner[run == n], np.full(int((run == n).sum()), WIDTH - 1 - k * len(OFTEN))) for k, n in enumerate(RUNS)]
    seen, times = np.unique(np.concatenate([o * WIDTH + b for o, b in marked]), return_counts=True)
    first = (KINDS - 1) * BUCKETS
    for k, least in enumerate(OFTEN):
        at = seen[times >= least]
        parts.append((at // WIDTH, first + (at % WIDTH - first + k * (BUCKETS // len(OFTEN))) % BUCKETS))
    found = np.sort(np.concatenate([o * WIDTH + b for o, b in parts]))
    found = found[np.diff(found, prepend=-1) > 0]
    return found % WIDTH, found // WIDTH


def log_ratios(raw: np.ndarray, target: np.ndarray, part: float) -> np.ndarray:
    """Log of how much more often the target holds a feature than its `part` of the raw documents would,
    times the probability that the two differ at all given both counts: rare features tell little."""
    expected = np.maximum(raw, 0) * part
    count = np.maximum(target, 0)
    ratio = np.log((count + SMOOTH) / (expected + SMOOTH))
    top = int(count.max(initial=0)) + 2
    steps = np.log(np.arange(top) + SMOOTH)
    rising = np.concatenate([[0.0], np.cumsum(steps)])[count]
    odd = SMOOTH * np.log(SMOOTH / (SMOOTH + expected)) + rising + count * np.log(np.maximum(expected, 1e-12) / (SMOOTH + expected))
    same = count * np.log(np.maximum(expected, 1e-12)) - expected
    return ratio / (1 + np.exp(np.clip(same - odd + np.log((1 - ODD) / ODD), -500, 500)))


@dataclass
class Ratios:
    """Log ratios by bucket, for documents in the target sample and for others; each without the document itself."""

    inside: np.ndarray
    others: np.ndarray

    def weights(self, texts: list[bytes], in_target: np.ndarray) -> np.ndarray:
        buckets, owners = features(texts)
        logs = np.where(in_target[owners], self.inside[buckets], self.others[buckets])
        counts = np.bincount(owners, minlength=len(texts))
        return np.bincount(owners, logs, minlength=len(texts)) * (LENGTH / np.maximum(counts, 1))


def no_ratios() -> Ratios:
    return Ratios(np.zeros(WIDTH, dtype=np.float32), np.zeros(WIDTH, dtype=np.float32))


def labelled(labels: DataFrame, most: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """Ids of documents labelled good (quality 1 and not toxic) and of those labelled otherwise, at most
    `most` of each, drawn by hash. An id with several labels is good if all are."""
    one = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).alias("good")
    )
    ids = []
    for kind in (True, False):
        drawn = one.where(F.col("good") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        ids.append(np.sort(drawn.select("doc_id").toPandas()["doc_id"].to_numpy(dtype=np.int64)))
    return ids[0], ids[1]


def _contains(ids: np.ndarray, column: pa.Array) -> np.ndarray:
    asked = column.fill_null(0).to_numpy(zero_copy_only=False)
    at = np.minimum(np.searchsorted(ids, asked), max(0, len(ids) - 1))
    hit = ids[at] == asked if len(ids) else np.zeros(len(asked), dtype=bool)
    return hit & ~column.is_null().to_numpy(zero_copy_only=False)


def fit(docs: DataFrame, good: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> Ratios:
    """Count features over all documents (raw) and those with an id in `good` (target). Each task adds up
    its own counts; at most WIDTH + 1 rows of sums reach the driver."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).cast("binary").alias("text"))
    width = WIDTH + 1  # the last one counts documents

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(width, dtype=np.int64), np.zeros(width, dtype=np.int64)
        for whole in batches:
            for batch in slices(whole, 1, BATCH_BYTES):
                buckets, owners = features(batch.column(1).to_pylist())
                inside = _contains(good, batch.column(0))
                raw += np.bincount(buckets, minlength=width)
                target += np.bincount(buckets[inside[owners]], minlength=width)
                raw[-1] += len(inside)
                target[-1] += inside.sum()
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(raw[used]), pa.array(target[used])], names=["bucket", "raw", "target"]
        )

    counts = narrow.mapInArrow(run, "bucket int, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")
    ).toArrow()
    buckets = counts["bucket"].to_numpy()
    raw, target = np.zeros(width, dtype=np.int64), np.zeros(width, dtype=np.int64)
    raw[buckets], target[buckets] = counts["raw"].to_numpy(), counts["target"].to_numpy()
    found = no_ratios()
    if target[-1]:
        part = target[-1] / raw[-1]
        for at in range(0, WIDTH, BUCKETS):
            r, t = raw[at : at + BUCKETS] - 1, target[at : at + BUCKETS]
            found.inside[at : at + BUCKETS], found.others[at : at + BUCKETS] = log_ratios(r, t - 1, part), log_ratios(r, t, part)
    return found


def score(docs: DataFrame, ratios: Ratios, good: np.ndarray, bad: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row_key, log_weight, label) for every row; `label` is 1 in the good sample, 0 in the bad."""
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), row_key(text_col).alias("row_key"),
        text_or_empty(text_col).cast("binary").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2, BATCH_BYTES):
                is_good, is_bad = _contains(good, batch.column(0)), _contains(bad, batch.column(0))
                found = ratios.weights(batch.column(2).to_pylist(), is_good)
                label = pa.array(is_good.astype(np.int32), mask=~(is_good | is_bad))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(found), label],
                    names=["doc_id", "row_key", "log_weight", "label"],
                )

    return narrow.mapInArrow(run, "doc_id long, row_key long, log_weight double, label int")


def gumbel_key(log_weight: Column, doc_id: Column, key: Column, temperature: float, seed: int) -> Column:
    """Log weight plus Gumbel noise, the noise a function of the row."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id, key), 11).cast("double")
    return log_weight - temperature * F.log(-F.log((bits + 0.5) / float(1 << 53)))


def kth_largest(df: DataFrame, column: str, k: int, bits: int = 48, step: int = 12) -> int:
    """The k-th largest value of a column of integers from 0 to 2^bits - 1, k from 1 to the number of
    rows. From the highest bits down, rows are counted by their next `step` bits; only those counts
    reach the driver."""
    low, left = 0, k
    for shift in range(bits - step, -1, -step):
        inside = df.where((F.col(column) >= low) & (F.col(column) < low + (1 << (shift + step))))
        place = F.shiftright(F.col(column) - low, shift)
        counts = {r.b: r.n for r in inside.groupBy(place.alias("b")).agg(F.count("*").alias("n")).collect()}
        for b in sorted(counts, reverse=True):
            if counts[b] >= left:
                low += b << shift
                break
            left -= counts[b]
    return low


def parting(sample: pd.DataFrame) -> float:
    """The limit with the least loss on the sample (label, w, n): the share of good rows below it times
    LOSS, and the share of bad rows from it on; the highest of equals. Without good or without bad rows
    nothing is to be parted, and the limit is below all."""
    table = sample.pivot_table(index="w", columns="label", values="n", aggfunc="sum", fill_value=0).sort_index()
    if 0 not in table or 1 not in table:
        return float("-inf")
    good, bad = table[1].to_numpy(dtype=float), table[0].to_numpy(dtype=float)
    loss = LOSS * (np.cumsum(good) - good) / good.sum() + 1 - (np.cumsum(bad) - bad) / bad.sum()
    return float(table.index[len(loss) - 1 - loss[::-1].argmin()])


@dataclass
class Draw:
    """A fitted selection: a row stays if its Gumbel key, as an integer of 48 bits, reaches `cut`."""

    ratios: Ratios
    good: np.ndarray
    least: float
    most: float
    temperature: float
    seed: int
    cut: int = 0

    def key(self, log_weight: Column, doc_id: Column, row_key: Column) -> Column:
        return gumbel_key(log_weight, doc_id, row_key, self.temperature, self.seed)

    def level(self, key: Column) -> Column:
        scale = ((1 << 48) - 1) / max(self.most - self.least, 1e-9)
        return F.least(F.lit((1 << 48) - 1), F.greatest(F.lit(0), F.floor((key - self.least) * scale)))


def fit_draw(
    docs: DataFrame, labels: DataFrame, temperature: float = 0.25, seed: int = 7, most: int = 20_000,
    id_col: str = "doc_id", text_col: str = "text",
) -> tuple[Draw, DataFrame]:
    """Fit models and cut; returns the draw and the scored rows.

    k, the number of rows to draw, is how many have a log weight above the limit that parts the good
    sample from the bad one best. Without good labels all weights are 0 and every row is drawn.
    """
    good, bad = labelled(labels, most)
    ratios = fit(docs, good, id_col, text_col) if len(good) else no_ratios()
    scored = stored(score(docs, ratios, good, bad, id_col, text_col), "weights")
    limit = parting(
        scored.where("label is not null").groupBy("label", (F.floor(F.col("log_weight") * 100) / 100).alias("w")).agg(F.count("*").alias("n")).toPandas()
    )
    k = scored.where(F.col("log_weight") >= limit).count()
    draw = Draw(ratios, good, 0.0, 0.0, temperature, seed)
    keyed = scored.withColumn("key", draw.key(F.col("log_weight"), F.col("doc_id"), F.col("row_key")))
    if k:
        draw.least, draw.most = keyed.agg(F.min("key"), F.max("key")).first()
        draw.cut = kth_largest(keyed.select(draw.level(F.col("key")).alias("level")), "level", k)
    return draw, keyed


def resample(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, log_weight, gumbel_key, kept) for every row of `docs`.

    `labels` (doc_id, quality, toxic). Rows tied with the k-th are kept, so equal rows share a fate.
    Null and empty texts have weight 0; null ids are never in the target sample; options as in
    `fit_draw`. An empty table gives no rows.
    """
    draw, keyed = fit_draw(docs, labels, **options)
    return keyed.select("doc_id", "log_weight", F.col("key").alias("gumbel_key"), (draw.level(F.col("key")) >= draw.cut).alias("kept"))


def select_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` that `resample` keeps, unchanged; weights are computed again in place of a
    join, so that no text is shuffled."""
    draw, _ = fit_draw(docs, labels, id_col=id_col, text_col=text_col, **options)
    ratios, good = draw.ratios, draw.good

    @F.pandas_udf("double")
    def weight(ids: pd.Series, unknown: pd.Series, texts: pd.Series) -> pd.Series:
        out, inside = [], _contains(good, pa.array(ids.to_numpy())) & ~unknown.to_numpy(dtype=bool)
        begin, coded, size = 0, [], 0
        for i, text in enumerate(texts):
            data = text.encode() if text else b""
            if size and size + len(data) > BATCH_BYTES:
                out.append(ratios.weights(coded, inside[begin:i]))
                begin, coded, size = i, [], 0
            coded.append(data)
            size += len(data)
        out.append(ratios.weights(coded, inside[begin:]))
        return pd.Series(np.concatenate(out))

    # A long that may be null would come as doubles, which round large ids.
    known = F.col(id_col).cast("long")
    log_weight = weight(F.coalesce(known, F.lit(0).cast("long")), known.isNull(), F.col(text_col).cast("string"))
    key = draw.key(log_weight, F.col(id_col).cast("long"), row_key(text_col))
    return docs.where(draw.level(key) >= draw.cut)
