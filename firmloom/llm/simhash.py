"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints within `distance` bits are found without comparing all: cut into
distance // 2 + 1 segments, two such fingerprints have a segment in which they differ by at
most one bit. Every fingerprint is indexed by each of its segments with each one bit struck
out (64 keys in all): segments that differ by at most one bit share such a key. An equality
join on the keys gives candidates, and the join condition checks the distance and that the
key is the pair's first, so a pair comes out once however many keys it shares. Equal
fingerprints are one row throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmloom.llm.common import row_key, slices, stored, text_or_empty
from firmloom.llm.components import components

SEED = 42
#: Shingles hashed at a time, which bounds memory for very long texts.
STEP = 1 << 16


def fingerprint(text: bytes, words: int) -> int:
    """64-bit SimHash of a text's word shingles, repeats included; 0 without words."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths).tolist()
    ends = (ends[min(words, len(parts)) - 1 :] - 1).tolist()
    total, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(ends), STEP):
        found = [digest(joined[s:e], SEED) for s, e in zip(starts[at : at + STEP], ends[at : at + STEP])]
        rows = np.array(found, dtype=">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * total > len(ends)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row_key, fp) for every row; `fp` is the fingerprint as a signed long. Null text
    has no words. Other columns are left out, repeated rows stay."""
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), row_key(text_col).alias("row_key"),
        text_or_empty(text_col).cast("binary").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2, 8 << 20):
                found = np.array([fingerprint(t, words) for t in batch.column(2).to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(found.view(np.int64))],
                    names=["doc_id", "row_key", "fp"],
                )

    return narrow.mapInArrow(run, "doc_id long, row_key long, fp long")


def _long(bits: int) -> Column:
    return F.lit(bits - (1 << 64) if bits >> 63 else bits)


def segments(distance: int) -> list[int]:
    """Masks of distance // 2 + 1 segments of nearly equal width."""
    n = distance // 2 + 1
    cuts = [64 * k // n for k in range(n + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]


def links(prints: DataFrame, distance: int) -> DataFrame:
    """`prints` (fp, no two equal): every pair (a, b) that differs in at most `distance` bits, once."""
    masks = segments(distance)
    keys = [(bit, m & ~(1 << bit), s) for s, m in enumerate(masks) for bit in range(64) if m >> bit & 1]
    variants = prints.select(
        "fp",
        F.explode(
            F.array(
                *[F.struct(F.lit(bit).alias("bit"), F.col("fp").bitwiseAND(_long(m)).alias("rest")) for bit, m, _ in keys]
            )
        ).alias("key"),
    ).select("fp", "key.bit", "key.rest")
    differ = F.col("x.fp").bitwiseXOR(F.col("y.fp"))
    first = F.lit(False)
    earlier = F.lit(True)
    for m in masks:
        low, here = (m & -m).bit_length() - 1, differ.bitwiseAND(_long(m))
        inside = (F.col("x.bit") >= low) & (F.col("x.bit") < m.bit_length())
        first = first | (inside & earlier & ((here != 0) | (F.col("x.bit") == low)))
        earlier = earlier & (F.bit_count(here) > 1)
    return (
        variants.alias("x")
        .join(
            # as Spark takes the explode for no longer than the fingerprints, it would broadcast 64 rows for each
            variants.alias("y").hint("merge"),
            (F.col("x.bit") == F.col("y.bit"))
            & (F.col("x.rest") == F.col("y.rest"))
            & (F.col("x.fp") < F.col("y.fp"))
            & (F.bit_count(differ) <= distance)
            & first,
        )
        .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    )


def near_duplicates(docs: DataFrame, words: int = 5, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row_key, fp, root, component_id) for every row of `docs`.

    Rows whose fingerprints are linked, directly or through others, form a component;
    component_id is the smallest doc_id in it (null if all are null), root its smallest fingerprint. Rows without words have
    fingerprint 0 and are linked like any other. row_key tells rows of one doc_id apart by their
    text. An empty table gives no rows.
    """
    prints = stored(fingerprints(docs, words, id_col, text_col), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(nodes.select("fp"), distance)).withColumnRenamed("node", "fp")
    members = stored(nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "members")
    smallest = members.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = members.join(smallest, "root").select("fp", "root", "component_id")
    return prints.join(classes, "fp").select("doc_id", "row_key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, words: int = 5, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` with one row left of every component: that of the smallest doc_id (null
    ids come last), of these of the smallest row_key, and one of rows that agree in both."""
    return keep_rows(docs, near_duplicates(docs, words, distance, id_col, text_col), id_col, text_col)


def keep_rows(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that `keep_one` leaves for the components `found` (doc_id, row_key, root)."""
    found = stored(found.select("doc_id", "row_key", "root"), "classes")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")
    kept = found.groupBy("root").agg(F.min(order).alias("k"))
    copies = found.groupBy("doc_id", "row_key").agg(F.count("*").alias("copies")).alias("c")
    kept = kept.select("k.doc_id", "k.row_key").distinct().alias("k")
    # written ids and keys that repeat take few bytes a row
    kept = kept.join(
        copies.hint("merge"), F.col("k.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("k.row_key") == F.col("c.row_key"))
    ).select(F.col("k.doc_id").alias("__kept_id"), F.col("k.row_key").alias("__kept_key"), F.col("copies").alias("__copies"))
    match = F.col(id_col).cast("long").eqNullSafe(F.col("__kept_id")) & (row_key(text_col) == F.col("__kept_key"))
    marked = docs.join(kept, match)
    once = marked.where("__copies = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
    again = (
        marked.where("__copies > 1")
        .groupBy("__kept_id", "__kept_key")
        .agg(F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("__row"))
        .select("__row.*")
    )
    return once.unionByName(again)
