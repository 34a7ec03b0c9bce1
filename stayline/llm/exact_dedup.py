"""Exact duplicates through counting quotient filters, verified byte by byte.

Texts are equal when they are identical after each run of white space became one space.

1. Every row gets a 64-bit fingerprint and the SHA-256 of its normalised text (native functions).
2. Each partition builds counting quotient filters of its fingerprints, one per range of leading bits.
3. The filters of one range are merged by their sorted remainders; nothing is lost, counts add up.
4. Texts whose fingerprint counts more than one are grouped by their bytes, so two texts that share a
   fingerprint stay apart.

Fingerprints that count more than one are sent to the rows, up to ``SENT_ROWS`` of them (checked), so texts that are
alone are not moved; if there are more, all texts are grouped. A hot group costs one filter entry per partition in
step 3 and one partial sum per task in step 4.

Defined results: a null text counts as empty. A null id is larger than any other. Of rows with the same
id and equal texts one stays, whichever was written first. An empty table gives an empty result. Other
columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import SENT_ROWS, SPACE, buckets_for, null_to_empty, numbered, only_kept, pick, place, staged, with_names

#: Fingerprints that a merging task holds at most, unless hashes are badly uneven.
MERGE_FINGERPRINTS = 1 << 18
#: Remainder bits kept per slot; the quotient takes what is left after the range bits.
WORD = 64


class QuotientFilter:
    """A counting quotient filter laid out in numpy.

    A fingerprint is split into a quotient, which names its home slot, and a remainder, which is stored.
    Remainders of one quotient form a run, runs shift to the right like in linear probing, ``occupied``
    marks quotients with a run and ``run_end`` the last slot of each run. Each slot has a counter.
    """

    def __init__(self, remainder_bits: int, slots: int, occupied, run_end, used, remainders, counts):
        self.remainder_bits, self.slots = remainder_bits, slots
        self.occupied, self.run_end, self.used = occupied, run_end, used
        self.remainders, self.counts = remainders, counts

    @classmethod
    def build(cls, fingerprints: np.ndarray, counts: np.ndarray, bits: int) -> QuotientFilter:
        """From sorted distinct fingerprints of ``bits`` bits and their counts."""
        n = len(fingerprints)
        quotient_bits = min(bits - 1, max(1, int(n * 1.1 + 1).bit_length()))
        remainder_bits = bits - quotient_bits
        quotients = (fingerprints >> np.uint64(remainder_bits)).astype(np.int64)
        remainders = fingerprints & np.uint64((1 << remainder_bits) - 1)
        order = np.arange(n)
        at = np.maximum.accumulate(quotients - order) + order if n else order
        slots = max(1 << quotient_bits, int(at[-1]) + 1 if n else 0)
        occupied, run_end, used = (np.zeros(slots, bool) for _ in range(3))
        occupied[quotients] = True
        used[at] = True
        run_end[at[np.append(quotients[1:] != quotients[:-1], True)] if n else at] = True
        return cls(remainder_bits, slots, occupied, run_end, used, remainders, counts)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints in ascending order, and their counts."""
        quotients = np.flatnonzero(self.occupied).astype(np.uint64)
        ends = np.cumsum(self.used)[self.run_end]
        lengths = np.diff(ends, prepend=0)
        return np.repeat(quotients, lengths) << np.uint64(self.remainder_bits) | self.remainders, self.counts

    def to_bytes(self) -> bytes:
        head = np.array([self.remainder_bits, self.slots, len(self.remainders)], np.int64)
        marks = [np.packbits(x) for x in (self.occupied, self.run_end, self.used)]
        return b"".join(x.tobytes() for x in (head, *marks, self.remainders, self.counts.astype(np.int64)))

    @classmethod
    def from_bytes(cls, data: bytes) -> QuotientFilter:
        remainder_bits, slots, n = (int(x) for x in np.frombuffer(data, np.int64, 3))
        size = (slots + 7) // 8
        marks = [np.unpackbits(np.frombuffer(data, np.uint8, size, 24 + i * size), count=slots).astype(bool) for i in range(3)]
        rest = np.frombuffer(data, np.uint64, 2 * n, 24 + 3 * size)
        return cls(remainder_bits, slots, *marks, rest[:n], rest[n:].astype(np.int64))

    @classmethod
    def merged(cls, filters: list[QuotientFilter], bits: int) -> QuotientFilter:
        """Merge by sorted remainders; counts of one fingerprint are added."""
        return cls.build(*_add_up(*(np.concatenate(x) for x in zip(*(f.entries() for f in filters), strict=True))), bits)


def _add_up(fingerprints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(fingerprints, kind="stable")
    fingerprints, counts = fingerprints[order], counts[order]
    first = np.flatnonzero(np.append(True, fingerprints[1:] != fingerprints[:-1])) if len(order) else order
    return fingerprints[first], np.add.reduceat(counts, first) if len(first) else counts


def normalised(text: Column) -> Column:
    return F.regexp_replace(null_to_empty(text), SPACE, " ")


def repeated_fingerprints(df: DataFrame, rows: int) -> DataFrame:
    """Fingerprints (column ``fp``) that occur more than once, with their counts."""
    ranges = buckets_for(rows, MERGE_FINGERPRINTS, 64)
    range_bits = ranges.bit_length() - 1
    bits = WORD - range_bits

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            more = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            values, counts = _add_up(np.append(values, more), np.append(counts, np.ones(len(more), np.int64)))
        parts = (values >> np.uint64(bits)).astype(np.int64)
        found, starts = np.unique(parts, return_index=True)
        ends = np.append(starts[1:], len(values))
        mask = np.uint64((1 << bits) - 1)
        blobs = [
            QuotientFilter.build(values[s:e] & mask, counts[s:e], bits).to_bytes() for s, e in zip(starts, ends, strict=False)
        ]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(blobs, pa.binary())], ["part", "filter"])

    def merge(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        merged = QuotientFilter.merged([QuotientFilter.from_bytes(x.as_py()) for x in table.column("filter")], bits)
        values, counts = merged.entries()
        many = counts > 1
        whole = (values[many] | np.uint64(part << bits)).view(np.int64)
        return pa.table({"fp": pa.array(whole, pa.int64()), "n": pa.array(counts[many], pa.int64())})

    filters = df.select("fp").mapInArrow(build, "part long, filter binary")
    return filters.groupBy("part").applyInArrow(merge, "fp long, n long")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None, sent_rows: int = SENT_ROWS) -> DataFrame:
    """One row per row: doc_id, keep_id, group_size, kept, text_sha256 and row_id.

    ``row_col`` names what tells rows apart; without it, rows are numbered here.
    """
    source = pick(df, doc_id=id_col, text=text_col, **({"row_id": row_col} if row_col else {}))
    text = source.withColumn("text", normalised(F.col("text"))).withColumn("fp", F.xxhash64("text"))
    row = F.col("row_id") if row_col else F.monotonically_increasing_id()
    rows = staged(text.select("doc_id", row.alias("row_id"), "fp", F.sha2("text", 256).alias("text_sha256")))
    again = staged(repeated_fingerprints(rows, rows.count()).select("fp"))
    suspected = text.join(F.broadcast(again), "fp", "left_semi") if again.count() <= sent_rows else text
    # Grouped by the text itself: this is the comparison byte by byte.
    groups = (
        suspected.groupBy("fp", "text")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("fp", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
        .filter("group_size > 1")
    )
    # Rows of one id with equal texts: all but the first go.
    firsts = (
        rows.groupBy("doc_id", "text_sha256")
        .agg(F.count(F.lit(1)).alias("twins"), F.min("row_id").alias("first_row"))
        .filter("twins > 1")
        .select(F.col("doc_id").alias("twin_id"), F.col("text_sha256").alias("twin_sha"), "first_row")
    )
    found = rows.join(groups, ["fp", "text_sha256"], "left").withColumn("alone", F.isnull("group_size"))
    twins = found["doc_id"].eqNullSafe(firsts["twin_id"]) & (found["text_sha256"] == firsts["twin_sha"])
    return found.join(firsts, twins, "left").select(
        "doc_id",
        F.when(F.col("alone"), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (
            F.col("alone")
            | F.col("doc_id").eqNullSafe(F.col("keep_id")) & F.coalesce(F.col("row_id") == F.col("first_row"), F.lit(True))
        ).alias("kept"),
        "text_sha256",
        "row_id",
    )


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", sent_rows: int = SENT_ROWS) -> DataFrame:
    """The rows that stay, with all their columns."""
    plain = numbered(df)
    id_, text = f"_{place(df, id_col)}", f"_{place(df, text_col)}"
    rows = with_names(plain, id_, text)
    groups = exact_groups(rows, id_, text, "name", sent_rows)
    return only_kept(rows, groups.withColumnRenamed("row_id", "name"), sent_rows).select(*plain.columns).toDF(*df.columns)
