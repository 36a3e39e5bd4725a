"""Bloom filters as rows of Spark's bitmaps: built by aggregation, asked in broadcast joins, never on the driver's heap as one.

A filter only decides which rows need a shuffle. Its size is bounded, so with far more rows than it was made for
it lets more of them through; it never holds one back that belongs in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import kept, unused

#: Bits of a filter per row: about one row in 250 passes by chance.
BITS_PER_ROW = 32
#: A filter is broadcast, and never larger than this (256 MiB, reached at 67 million rows).
MAX_FILTER_BITS = 1 << 31
#: Bits in one row of a filter, as the bitmap functions have it.
PAGE_BITS = 32_768


def filter_bits(rows: int, per_row: int = BITS_PER_ROW, most: int = MAX_FILTER_BITS) -> int:
    return min(most, max(PAGE_BITS, 1 << max(0, rows * per_row - 1).bit_length()))


def cells(value: Column, bits: int) -> list[Column]:
    """The two cells of a 64-bit hash."""
    return [F.pmod(value, F.lit(bits)), F.pmod(F.xxhash64(value, F.lit(1)), F.lit(bits))]


def pages(rows: DataFrame, value: Column, bits: int, twice: bool = False) -> DataFrame:
    """The filter of a hash column; with `twice`, only cells that were hit at least twice are set."""
    hit = rows.select(F.explode(F.array(*cells(value, bits))).alias("cell")).groupBy("cell").count()
    return kept(hit.where("count > 1" if twice else "count > 0").groupBy(F.shiftright("cell", 15).alias("page")).agg(
        F.bitmap_construct_agg(F.col("cell").bitwiseAND(PAGE_BITS - 1)).alias("bits")))


def marked(rows: DataFrame, value: Column, filter_pages: DataFrame, bits: int, out: str) -> DataFrame:
    """`rows` and the boolean `out`: whether the filter may hold the hash. No row is shuffled."""
    joined, hit, added = rows, F.lit(True), []
    for n, cell in enumerate(cells(value, bits)):
        at, octets = unused(rows, f"__page{n}"), unused(rows, f"__bits{n}")
        page = F.broadcast(filter_pages.select(F.col("page").alias(at), F.col("bits").alias(octets)))
        joined = joined.join(page, F.shiftright(cell, 15) == F.col(at), "left")
        bit = cell.bitwiseAND(PAGE_BITS - 1)
        octet = F.conv(F.hex(F.substring(F.col(octets), F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10)
        hit = hit & F.coalesce(F.getbit(octet.cast("int"), bit.bitwiseAND(7).cast("int")) == 1, F.lit(False))
        added += [at, octets]
    return joined.withColumn(out, hit).drop(*added)


def likely(rows: DataFrame, value: Column, members: DataFrame, member: Column) -> DataFrame:
    """The rows whose hash `value` is that of a member, and a few others: what is left to meet `members` in a shuffle."""
    bits, out = filter_bits(members.count()), unused(rows, "__likely")
    return marked(rows, value, pages(members, member, bits), bits, out).where(F.col(out)).drop(out)
