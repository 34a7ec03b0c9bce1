"""Repeated windows of a fixed length: what substring and suffix-array dedup have in common.

A window is ``window`` consecutive symbols (words or bytes) of one document. Equal windows hold the same
smallest ``gram`` (by hash, leftmost on ties), their anchor. Neighbouring windows with one anchor form a
group; a group's stretch is all that its windows cover. So groups speak for all windows:

- an anchor that occurs once has no repeated window;
- groups with equal stretches have equal windows, one by one;
- only where an anchor occurs with different stretches (where copies begin, end or were changed), the
  windows themselves have to be compared, and of equal stretches one representative is enough.

Stretches are hashed with Rabin-Karp sums, two of 64 bits with different bases. All counts are Spark
aggregations with partial sums, so a passage that a third of all documents share costs one partial row per
task; its windows are never paired.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import apart, gram_hashes, null_to_empty, pick, slices, staged, stretch_hashes, stretch_sums

#: Bits of the table that says whose windows are to be compared: 64 a group, between these bounds.
LEAST_BITS, MOST_BITS = 22, 28
#: Bytes of text whose windows are looked at together; their arrays fit into a processor's cache.
SLICE = 1 << 18


@dataclass(frozen=True)
class Kind:
    """What a window is made of. ``read`` gives two streams of symbols and where each text starts in them."""

    window: int
    gram: int
    read: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]]


@dataclass
class Groups:
    """Groups of windows of many texts: text, first window (in the text and overall), windows, hashes, where in the first window the anchor is."""

    text: np.ndarray
    lo: np.ndarray
    at: np.ndarray
    n: np.ndarray
    anchor: np.ndarray
    span1: np.ndarray
    span2: np.ndarray
    place: np.ndarray


def _smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest key in each stretch of ``width`` keys: blocks from either side (van Herk)."""
    n = len(keys)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, 1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def groups_of(one: np.ndarray, two: np.ndarray, first: np.ndarray, window: int, gram: int) -> Groups:
    """All groups of all texts."""
    empty = np.zeros(0, np.int64)
    if len(one) < window:
        return Groups(*[empty] * 8)
    sums = stretch_sums(one), stretch_sums(two, 1)
    at = np.arange(len(one) - gram + 1, dtype=np.uint64)
    hashes = gram_hashes(sums[0], gram)
    # Upper half of the hash, then the place: the smallest key names the leftmost smallest gram.
    keys = (hashes & np.uint64(0xFFFFFFFF00000000)) | at
    anchors = (_smallest(keys, window - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    counts = np.maximum(0, np.diff(first) - window + 1)
    # A group begins where the anchor changes, where the windows of a text begin, and behind its last one.
    new = np.append(True, anchors[1:] != anchors[:-1])
    begins = first[:-1][counts > 0]
    behind = begins + counts[counts > 0]
    new[begins] = True
    new[behind[behind < len(new)]] = True
    lo = np.flatnonzero(new)
    n = np.diff(np.append(lo, len(new)))
    text = np.searchsorted(first, lo, "right") - 1
    inside = lo - first[text] < counts[np.minimum(text, len(counts) - 1)]
    lo, n, text = lo[inside], n[inside], text[inside]
    if not len(lo):
        return Groups(*[empty] * 8)
    anchor = anchors[lo]
    end = lo + n - 1 + window
    # The place of the anchor counts as well, so that equal stretches are equal window by window.
    offset = (anchor - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    spans = [(stretch_hashes(sums[k], lo, end, k, summed=True) ^ offset).view(np.int64) for k in range(2)]
    return Groups(text, lo - first[text], lo, n, hashes[anchor].view(np.int64), *spans, anchor - lo)


def sources(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, and two hashes that name a row by id and text (rows equal in both are interchangeable)."""
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text", null_to_empty(F.col("text")))
    return rows.withColumns({"k1": F.xxhash64("doc_id", "text"), "k2": F.hash("text", "doc_id").cast("long")})


def row_bits(k1: np.ndarray, k2: np.ndarray, lo: np.ndarray, bits: int) -> np.ndarray:
    """Place in the bit table of a group."""
    x = k1.view(np.uint64) ^ (k2.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (lo.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(64 - bits)).astype(np.int64)


def all_groups(rows: DataFrame, kind: Kind) -> DataFrame:
    """One row per group of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            g = groups_of(*kind.read(batch), kind.window, kind.gram)
            who = pa.array(g.text)
            columns = {"doc_id": batch.column("doc_id").take(who), "k1": batch.column("k1").take(who), "k2": batch.column("k2").take(who)}
            columns |= {c: pa.array(getattr(g, c), pa.int64()) for c in ("lo", "n", "anchor", "span1", "span2")}
            yield pa.RecordBatch.from_pydict(columns)

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, k1 long, k2 long, lo long, n long, anchor long, span1 long, span2 long")


def repeated(groups: DataFrame) -> DataFrame:
    """Groups whose anchor occurs again, with ``mixed``: whether it does so with different stretches."""
    again = (
        groups.select("anchor", "span1")
        .groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("c"), (F.min("span1") != F.max("span1")).alias("mixed"))
        .filter("c > 1")
        .drop("c")
    )
    return groups.join(apart(again), "anchor")


def repeated_groups(rows: DataFrame, kind: Kind) -> DataFrame:
    return staged(repeated(all_groups(rows, kind)))


def with_spans(groups: DataFrame) -> DataFrame:
    """Adds how often a group's stretch occurs (``c``), in which document first, and where that is."""
    key = F.struct(F.isnull("doc_id").alias("none"), F.col("doc_id").alias("id"), F.col("k1").alias("k1"), F.col("k2").alias("k2"), F.col("lo").alias("lo"))
    spans = groups.groupBy("span1", "span2").agg(F.count(F.lit(1)).alias("c"), F.min(key).alias("first"))
    return groups.join(apart(spans), ["span1", "span2"])


def is_first() -> Column:
    """Whether a group is the representative of its stretch."""
    return (F.col("first.k1") == F.col("k1")) & (F.col("first.k2") == F.col("k2")) & (F.col("first.lo") == F.col("lo"))


def bit_table(groups: DataFrame) -> np.ndarray:
    """A table of bits, of a size between fixed bounds, that marks the given groups."""
    rows = groups.count()
    bits = min(MOST_BITS, max(LEAST_BITS, (64 * rows).bit_length()))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = row_bits(*(batch.column(c).to_numpy() for c in ("k1", "k2", "lo")), bits)
            yield pa.RecordBatch.from_arrays([pa.array(places >> 6), pa.array((np.uint64(1) << (places & 63).astype(np.uint64)).view(np.int64))], ["cell", "bit"])

    cells = groups.select("k1", "k2", "lo").mapInArrow(mark, "cell long, bit long").groupBy("cell").agg(F.bit_or("bit").alias("bits"))
    table = np.zeros(1 << (bits - 6), np.int64)
    marks = cells.toArrow()
    table[marks.column("cell").to_numpy()] = marks.column("bits").to_numpy()
    return table


def marked(table: np.ndarray, k1: np.ndarray, k2: np.ndarray, lo: np.ndarray) -> np.ndarray:
    places = row_bits(k1, k2, lo, len(table).bit_length() - 1 + 6)
    return (table[places >> 6].view(np.uint64) >> (places & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of what the stretches cover."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def with_removals(rows: DataFrame, removals: DataFrame) -> DataFrame:
    """doc_id, text and ``spans`` (start, end; null if none). ``removals``: k1, k2, start, end."""
    lists = removals.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return rows.join(lists, ["k1", "k2"], "left").select("doc_id", "text", "spans")
