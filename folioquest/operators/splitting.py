"""Texts to overlapping pieces.

The next piece's start depends on where the last one ended, so a text is walked once, in an Arrow function; the pieces
come back as one array and are exploded in the JVM. Three splitters differ in how far they look back for a boundary
and in what they do at the end of a text:

``document``  looks back 100 characters for a space; after the end is reached it goes on, one character a step, while
              the overlap lasts (the reference's tail; ``tail="stop"`` leaves it out)
``leaf``      as above, without a tail; a text that fits stays unstripped
``slice``     prefers a blank line in the second half of the piece, then a space in its last 200 characters
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioquest.functions import storage
from folioquest.operators import filters, ordering

PIECES = "array<struct<start:int,end:int,content:string>>"
#: About how many characters of pieces are held and sent back at once. A text's pieces stay together, so one text can exceed it.
SENT = 4 << 20


def _space_within(back: int) -> Callable[[str, int, int, int], int]:
    def cut(text: str, start: int, end: int, size: int) -> int:
        return text.rfind(" ", max(start, end - back), end)

    return cut


def _paragraph(text: str, start: int, end: int, size: int) -> int:
    at = text.rfind("\n\n", start + size // 2, end)
    return at if at > start else text.rfind(" ", max(start, end - 200), end)


def walk(text: str, size: int, overlap: int, cut: Callable[[str, int, int, int], int], tail: bool) -> list[tuple[int, int, str]]:
    """(start, end, stripped content) of each piece that isn't blank."""
    out, start, n = [], 0, len(text)
    while start < n:
        end = min(start + size, n)
        if end < n and (at := cut(text, start, end, size)) > start:
            end = at
        if piece := text[start:end].strip():
            out.append((start, end, piece))
        if end >= n and not tail:
            break
        start = max(start + 1, end - overlap)
    return out


def pieces_of(text: str, kind: str, size: int, overlap: int, tail: str) -> list[tuple[int, int, str]]:
    if len(text) <= size and (kind != "leaf" or text):
        return [(0, len(text), text)]
    cut = _paragraph if kind == "slice" else _space_within(100)
    return walk(text, size, overlap, cut, kind != "leaf" and tail == "reference")


def _arrays(texts: Iterator[pa.Array], kind: str, size: int, overlap: int, tail: str, sent: int) -> Iterator[pa.Array]:
    """The pieces of each text, in arrays of about ``sent`` characters: a text's tail can be many times its size, so a whole batch's pieces are never held."""
    for batch in texts:
        starts, ends, contents, offsets, held = [], [], [], [0], 0
        for k, text in enumerate(batch, 1):
            for a, b, c in pieces_of(text.as_py(), kind, size, overlap, tail) if text.is_valid else ():
                starts.append(a)
                ends.append(b)
                contents.append(c)
                held += len(c)
            offsets.append(len(starts))
            if held >= sent or k == len(batch):
                rows = pa.StructArray.from_arrays([pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(contents, pa.string())], ["start", "end", "content"])
                yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)
                starts, ends, contents, offsets, held = [], [], [], [0], 0


def pieces(column: str, kind: str, size: int, overlap: int, tail: str = "reference") -> Column:
    """A text's pieces as an array."""

    @F.arrow_udf(PIECES)
    def cut(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _arrays(texts, kind, size, overlap, tail, SENT)

    return cut(column)


def split(df: DataFrame, column: str, kind: str, size: int, overlap: int, tail: str = "reference") -> DataFrame:
    """A row for each piece: the other columns, piece_no from 0, start_pos, end_pos, piece."""
    rest = [c for c in df.columns if c != column]
    rows = df.select(*rest, F.posexplode(pieces(column, kind, size, overlap, tail)).alias("piece_no", "p"))
    return rows.select(*rest, "piece_no", F.col("p.start").alias("start_pos"), F.col("p.end").alias("end_pos"), F.col("p.content").alias("piece"))


def document_chunks(docs: DataFrame, size: int = 1000, overlap: int = 200, tail: str = "reference") -> DataFrame:
    return split(docs, "content", "document", size, overlap, tail)


def numbered_chunks(docs: DataFrame, size: int = 1000, overlap: int = 200, tail: str = "reference", patterns: tuple[str, ...] | None = None) -> DataFrame:
    """chunk_id, doc_id, start_pos, end_pos, piece: pieces that pass the quality rules, numbered from 0 over all documents (with distinct ids) in order.

    A first pass notes which pieces of a document are good, and how many; that alone is stored, numbered by running sums,
    and joined to the documents, which are split again. No piece is stored or dealt by its place.
    """
    own = docs.select("doc_id", "content")
    every = document_chunks(own.withColumn("terms", filters.terms_in(F.col("content"), patterns)), size, overlap, tail)
    good = filters.good_chunks(every, patterns=patterns, terms="terms").groupBy("doc_id").agg(F.sort_array(F.collect_list("piece_no")).alias("good"))
    firsts = ordering.first_numbers(storage.checkpoint(good).withColumn("n", F.size("good").cast("long")), "doc_id", "n", "first").drop("n")
    again = own.join(firsts, "doc_id").select("doc_id", "first", "good", pieces("content", "document", size, overlap, tail).alias("p"))
    chosen = again.select("doc_id", "first", F.posexplode(F.transform("good", lambda k: F.col("p")[k])).alias("at", "c"))
    return chosen.select((F.col("first") + F.col("at")).alias("chunk_id"), "doc_id", F.col("c.start").alias("start_pos"), F.col("c.end").alias("end_pos"), F.col("c.content").alias("piece"))


def leaf_chunks(leaves: DataFrame, size: int = 500, overlap: int = 100) -> DataFrame:
    """Pieces of every leaf that has content."""
    return split(leaves.where(F.length("content") > 0), "content", "leaf", size, overlap)


def slices(docs: DataFrame, size: int = 12_000, overlap: int = 500, tail: str = "stop") -> DataFrame:
    """Pieces for the slicing provider. The reference's tail would send hundreds of near-equal pieces; ``tail="reference"`` gives them."""
    return split(docs, "content", "slice", size, overlap, tail)
