"""Which keys of a huge table are in another: a bitmap at the scan, then a join of what is left.

Every key sets one bit at its hash. The bitmap's pages are combined where the keys are and sent to the
scan of the huge table, which drops what has no bit; the join decides about the rest, so hash
collisions cost time and never change a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmloom.operators.skew import salted_join

#: Bits of a page, fixed by the bitmap functions.
PAGE = 32_768
#: Bits for each key, and most bytes of all pages that are sent around.
BITS_PER_KEY, MOST_BYTES = 16, 64 << 20


def _place(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def key_pages(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """(_page, _bitmap) of the hashes of `key`; a page without keys has no row."""
    place = _place(key, bits)
    page = keys.select(F.bitmap_bucket_number(place).alias("_page"), F.bitmap_bit_position(place).alias("_bit"))
    return page.groupBy("_page").agg(F.bitmap_construct_agg("_bit").alias("_bitmap"))


def merged_pages(pages: list[DataFrame]) -> DataFrame:
    """Pages of several tables as one set of pages."""
    rows = pages[0]
    for more in pages[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("_page").agg(F.bitmap_or_agg("_bitmap").alias("_bitmap"))


def may_hold(rows: DataFrame, key: str, pages: DataFrame, bits: int) -> DataFrame:
    """The rows of `rows` whose bit is set; a few of the others by chance."""
    place = _place(key, bits)
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_bitmap", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn("_page", F.bitmap_bucket_number(place)).join(F.broadcast(pages), "_page")
    return found.where(F.getbit(byte, (bit % 8).cast("int")) == 1).select(*[F.col(f"`{c}`") for c in rows.columns])


def semi_join(rows: DataFrame, keys: list[tuple[DataFrame, str]], key: str, spread: list[str]) -> DataFrame:
    """The rows of `rows` whose `key` stands in one of the columns `keys`, (table, column); null is no key.

    The number of keys, which one count looks up, sets the bitmap's size; where its pages would take
    more than MOST_BYTES, the join does without. Keys are made distinct first; a key with many
    rows is cut into slices by `spread`.
    """
    named = [df.select(F.col(c).alias(key)).where(F.col(key).isNotNull()) for df, c in keys]
    known = named[0]
    for more in named[1:]:
        known = known.union(more)
    known = known.distinct()
    kept = likely(rows.where(F.col(key).isNotNull()), named, key, known.count())
    return salted_join(kept, known, [key], spread)


def likely(rows: DataFrame, keys: list[DataFrame], key: str, number: int) -> DataFrame:
    """The rows of `rows` whose `key` may stand in one of `keys`, tables with that column and about `number`
    different values; all rows where the bitmap would take more than MOST_BYTES."""
    # pages hold 4 KB each whether full or not: whole pages, a power of two of them
    bits = PAGE
    while bits < BITS_PER_KEY * number:
        bits *= 2
    if bits // 8 > MOST_BYTES:
        return rows
    return may_hold(rows, key, merged_pages([key_pages(df, key, bits) for df in keys]), bits)
