"""Repeated lines: normalised lines are exploded and hashed, documents are counted per hash, and what is left is put
together again by position.

Texts are never shuffled by line: 128-bit hashes are, and then the texts of the documents that lose a line, once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.llm import bloom
from orderpulse.llm.common import bound, kept, lower_ascii, quoted, small, text_of

#: What is stripped from both ends of a line: `[\x20\x09-\x0D]`.
BLANKS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class LineSettings:
    """Code points that a line's key needs to count, and documents that must hold it for it to be dropped."""

    min_chars: int = 20
    min_docs: int = 3


def line_keys(text: Column) -> Column:
    """The key of each line of a text: stripped, with A-Z in lower case."""
    return F.transform(F.split(lower_ascii(text), "\n"), lambda line: F.trim(line, F.lit(BLANKS)))


def hashed_lines(docs: DataFrame, settings: LineSettings) -> DataFrame:
    """(id, print, at, h1, h2): position and 128-bit hash of each line that is long enough; `docs` has id and text."""
    lines = docs.select("id", F.xxhash64("text").alias("print"), F.posexplode(line_keys(F.col("text"))).alias("at", "line"))
    return lines.where(F.length("line") >= settings.min_chars).select(
        "id", "print", "at", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def repeated_lines(lines: DataFrame, settings: LineSettings) -> DataFrame:
    """(h1, h2, last): hashes that enough documents hold, and the largest id that does.

    A document is counted once however often it holds a line. Lines meet by hash and document first, so that a line
    that a third of all documents hold is no task's load.
    """
    groups = lines.groupBy("h1", "h2").agg(
        (F.count_distinct("id") + F.max(F.col("id").isNull().cast("int"))).alias("n"), F.max("id").alias("last"))
    return groups.where(F.col("n") >= settings.min_docs).select("h1", "h2", "last")


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text",
                        settings: LineSettings = LineSettings()) -> DataFrame:
    """One row per row of `docs`: doc_id, n_lines, n_dropped, kept_text (the other lines, joined by a line feed).

    A line goes if `min_docs` documents hold its key, save in the document with the largest id among them, which keeps
    every line of that key. Lines end at a line feed alone; a null or empty text is one empty line. Documents are told
    apart by id, of any type that has an order; rows without one are one document, less than any other. Rows that
    repeat id and text share one result; rows that repeat an id with another text count as one document and are put
    together each for itself. Empty tables give no rows; other columns are not looked at.
    """
    rows = docs.select(quoted(key).alias("id"), text_of(text).alias("text"))
    lines = hashed_lines(rows, settings)
    often = kept(repeated_lines(lines, settings))
    few = small(often)
    if few is often:  # too many for every task: a filter spares most other lines the shuffle
        lines = bloom.likely(lines, F.col("h1"), often, F.col("h1"))
    dropped = lines.join(few, ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("last")))
    gone = kept(dropped.groupBy("id", "print").agg(F.collect_set("at").alias("gone")))  # at most a document's own lines
    # Only documents that lose a line meet their positions; a filter spares most of the others the shuffle.
    rows = rows.withColumn("print", F.xxhash64("text"))
    bits, value = bloom.filter_bits(gone.count()), F.xxhash64("id", "print")
    marked = bloom.marked(rows, value, bloom.pages(gone, value, bits), bits, "some")
    met = marked.where("some").drop("some").alias("d").join(
        gone.alias("g"), F.expr("d.id <=> g.id AND d.print = g.print"), "left").select("d.id", "d.text", "g.gone")
    all_rows = met.unionByName(marked.where("NOT some").select("id", "text"), allowMissingColumns=True)
    n_lines, n_dropped = F.size(F.split("text", "\n")), F.coalesce(F.size("gone"), F.lit(0))
    left = bound(F.split("text", "\n"), lambda parts: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("gone")), lambda at: parts[at]), "\n"))
    return all_rows.select(
        F.col("id").alias("doc_id"), n_lines.cast("long").alias("n_lines"), n_dropped.cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("kept_text"))
