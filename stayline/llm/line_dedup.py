"""Line dedup: two Bloom filters name the lines that may repeat, an exact count by text confirms them.

A line's key is the line without white space at both ends and with A to Z in lower case. Keys of at least ``length``
code points that stand in at least ``least`` documents repeat: all their lines go, or (``keep="first"``) all but the
first one of the first document.

1. Each task puts the keys of its documents, once per document, into two Bloom filters: keys seen once, and keys seen
   before when they came again. All bits of a key lie in one word of 64.
2. The filters of all tasks are merged in two rounds, range by range: seen twice is what either side has twice or both
   have once. Filters travel compressed, two of ``MOST_BITS`` bits a task at most, however many lines there are.
3. Only keys that the second filter knows are suspected. Their texts are counted, first in the task, then by Spark, and
   the least (document, row, line) is found for each: exact, and one row per task and key for a line that all share.
4. The texts are read again. Confirmed keys are sent along if they come to ``SENT_BYTES`` at most, checked before that;
   otherwise each document's suspected keys are joined with them by a shuffle. The result is the same.

A filter that fills up (more than about 2**27 lines for the largest size) makes step 3 larger and changes no result.

Defined results: null and empty texts are one empty line. Rows are documents, also rows with one id; a null id comes
after all others, and of equal ids the row whose text hashes lowest comes first. Rows that are there twice count as two
documents, and for ``keep="first"`` they keep the line both, as nothing tells them apart. An empty table gives an
empty result. Texts of any length are read whole. Other columns are not looked at.
"""

from __future__ import annotations

import functools
from collections import ChainMap
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import apart, null_to_empty, pick, slices, staged

#: Bits of a filter: ``BITS_PER_LINE`` a line, between these bounds (powers of two).
BITS_PER_LINE, LEAST_BITS, MOST_BITS = 8, 1 << 20, 1 << 30
#: Bits that a key sets, all in one word.
BITS_PER_KEY = 4
#: Words of a filter that one merging task works on; tasks whose filters are merged in the first round.
RANGE_WORDS, FAN = 1 << 15, 64
#: Bytes of confirmed keys that are sent to all tasks at most.
SENT_BYTES = 32 << 20
#: Bytes of keys that a task counts before it hands them on.
HELD_BYTES = 64 << 20


def key_of(line: bytes) -> bytes:
    """Strips the white space 20, 09-0D at both ends and lower-cases A-Z; other bytes of UTF-8 stay."""
    return line.strip().lower()


def code_points(key: bytes) -> int:
    return len(key) - sum(0x80 <= b < 0xC0 for b in key) if not key.isascii() else len(key)


def keys_of(text: bytes, length: int) -> list[bytes]:
    """The keys of a text, each once, that are long enough."""
    found = dict.fromkeys(map(key_of, text.split(b"\n")))
    # A key has at least a quarter as many code points as bytes.
    return [k for k in found if len(k) >= 4 * length or code_points(k) >= length]


class Filters:
    """Two Bloom filters: keys seen once, keys seen twice."""

    def __init__(self, bits: int):
        self.once, self.twice = (np.zeros(bits // 64, np.uint64) for _ in range(2))

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The word of each hash, and its bits there. The high bits of a hash give the word, the low ones the bits."""
        bits = np.zeros(len(hashes), np.uint64)
        for k in range(BITS_PER_KEY):
            bits |= np.uint64(1) << (hashes >> np.uint64(6 * k) & np.uint64(63))
        width = len(self.once).bit_length() - 1
        return (hashes >> np.uint64(64 - width)).astype(np.int64), bits

    def add(self, hashes: np.ndarray) -> None:
        """Adds keys; hashes that are there twice count twice."""
        if not len(hashes):
            return
        values, counts = np.unique(hashes, return_counts=True)
        word, bits = self.places(values)
        known = (self.once[word] & bits) == bits
        again = known | (counts > 1)
        np.bitwise_or.at(self.twice, word[again], bits[again])
        np.bitwise_or.at(self.once, word, bits)

    def suspects(self, hashes: np.ndarray) -> np.ndarray:
        word, bits = self.places(hashes)
        return (self.twice[word] & bits) == bits


def merged(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Filters of several parts of the data as those of all of it. Bits that are set once in two parts are set twice."""

    def two(x, y):
        return x[0] | y[0], x[1] | y[1] | (x[0] & y[0])

    return functools.reduce(two, pairs)


def packed(words: np.ndarray) -> bytes:
    return pa.compress(words.tobytes(), "zstd", asbytes=True)


def unpacked(data: bytes, words: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 8 * words, "zstd", asbytes=True), np.uint64)


def hashes_of(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def bits_for(lines: int, most: int = MOST_BITS) -> int:
    return min(most, max(LEAST_BITS, 1 << (BITS_PER_LINE * lines - 1).bit_length())) if lines else LEAST_BITS


def seen_twice(rows: DataFrame, length: int, bits: int) -> DataFrame:
    """The second filter in ranges: part, twice (compressed words)."""
    words = min(RANGE_WORDS, bits // 64)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = Filters(bits)
        for batch in slices(batches):
            keys = [k for t in binary(batch) for k in keys_of(t, length)]
            filters.add(hashes_of(keys))
        team = TaskContext.get().partitionId() // FAN
        for part in range(bits // 64 // words):
            cut = slice(part * words, (part + 1) * words)
            if filters.once[cut].any():
                yield pa.RecordBatch.from_pydict(
                    {"part": [part], "team": [team], "once": [packed(filters.once[cut])], "twice": [packed(filters.twice[cut])]}
                )

    def merge(table: pa.Table) -> pa.Table:
        sides = zip(table.column("once").to_pylist(), table.column("twice").to_pylist(), strict=True)
        once, twice = merged([(unpacked(a, words), unpacked(b, words)) for a, b in sides])
        return pa.table({"part": table.column("part")[:1], "team": table.column("team")[:1], "once": [packed(once)], "twice": [packed(twice)]})

    schema = "part long, team long, once binary, twice binary"
    built = rows.select("text").mapInArrow(build, schema)
    built = built.groupBy("part", "team").applyInArrow(merge, schema)
    return built.groupBy("part").applyInArrow(merge, schema).select("part", "twice")


def binary(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.large_binary()).to_pylist()]


def filter_of(rows: DataFrame, length: int, most_bits: int) -> Filters:
    """The second filter, merged over all rows; of a size between fixed bounds."""
    newlines = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    bits = bits_for(rows.agg(F.sum(newlines)).first()[0] or 0, most_bits)
    words = min(RANGE_WORDS, bits // 64)
    whole = Filters(bits)
    # At most MOST_BITS / 8 bytes in all, whatever the number of lines.
    for row in seen_twice(rows, length, bits).collect():
        whole.twice[row.part * words : (row.part + 1) * words] = unpacked(bytes(row.twice), words)
    return whole


def repeated_lines(rows: DataFrame, least: int, length: int, most_bits: int = MOST_BITS) -> tuple[DataFrame, object]:
    """Keys of at least ``least`` documents, with the number of documents and where each stands first; and the filter (sent to all tasks).

    ``rows``: doc_id, text and the hashes k1, k2 of a row. Columns key (binary), documents, first (none, doc_id, k1, k2).
    """
    suspected = rows.sparkSession.sparkContext.broadcast(filter_of(rows, length, most_bits))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, list] = {}
        held = 0
        for batch in slices(batches):
            ids, k1, k2 = (batch.column(c).to_pylist() for c in ("doc_id", "k1", "k2"))
            for k, text in enumerate(binary(batch)):
                keys = keys_of(text, length)
                for j in np.flatnonzero(suspected.value.suspects(hashes_of(keys))):
                    # Spark finds the least of all; the task only has to keep the least of its own.
                    at = (ids[k] is None, ids[k], k1[k], k2[k])
                    entry = counts.get(keys[j])
                    if entry is None:
                        counts[keys[j]] = [1, at]
                        held += len(keys[j])
                    else:
                        entry[0] += 1
                        if before(at, entry[1]):
                            entry[1] = at
            if held > HELD_BYTES:
                yield counted(counts, batch.schema.field("doc_id").type)
                counts, held = {}, 0
        if counts:
            yield counted(counts, batch.schema.field("doc_id").type)

    def counted(counts: dict[bytes, list], kind: pa.DataType) -> pa.RecordBatch:
        none, ids, k1, k2 = zip(*(at for _, at in counts.values()), strict=True)
        columns = {"key": pa.array(list(counts), pa.binary()), "n": pa.array([n for n, _ in counts.values()], pa.int64())}
        columns |= {"none": pa.array(none), "doc_id": pa.array(ids, kind), "k1": pa.array(k1, pa.int64()), "k2": pa.array(k2, pa.int64())}
        return pa.RecordBatch.from_pydict(columns)

    parts = rows.mapInArrow(run, f"key binary, n long, none boolean, doc_id {id_type}, k1 long, k2 long")
    whole = parts.groupBy("key").agg(F.sum("n").alias("documents"), F.min(F.struct("none", "doc_id", "k1", "k2")).alias("first"))
    return staged(whole.filter(F.col("documents") >= least)), suspected


def before(a: tuple, b: tuple) -> bool:
    """Whether a row (id is null, id, hashes) comes before another."""
    if a[0] or b[0]:
        return (a[0], *a[2:]) < (b[0], *b[2:])
    return a[1:] < b[1:]


def without_lines(text: bytes, gone: Mapping[bytes, bool]) -> tuple[int, int, bytes]:
    """Number of lines, of dropped ones, and the text that stays. ``gone``: keys that go, and whether their first line stays."""
    lines = text.split(b"\n")
    kept, spared = [], set()
    for line in lines:
        key = key_of(line)
        if key in gone:
            if not gone[key] or key in spared:
                continue
            spared.add(key)
        kept.append(line)
    return len(lines), len(lines) - len(kept), b"\n".join(kept)


def deduplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 2, length: int = 1, keep: str = "first", sent_bytes: int = SENT_BYTES, most_bits: int = MOST_BITS) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept (text) of every row; ``keep``: ``first`` or ``none`` of a repeated key's lines."""
    if keep not in ("first", "none"):
        raise ValueError(f"keep is first or none, not {keep}")
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("text", null_to_empty(F.col("text")))
    rows = rows.withColumns({"k1": F.xxhash64("doc_id", "text"), "k2": F.hash("text", "doc_id").cast("long")})
    keys, suspected = repeated_lines(rows, least, length, most_bits)
    size = keys.agg(F.sum(F.octet_length("key") + 64)).first()[0] or 0
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_lines long, n_dropped long, kept string"

    def cleaned(batch: pa.RecordBatch, gone: Iterator[Mapping[bytes, bool]]) -> pa.RecordBatch:
        found = [without_lines(t, g) for t, g in zip(binary(batch), gone, strict=True)]
        lines, dropped, kept = zip(*found, strict=True)
        columns = {"n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(dropped, pa.int64()), "kept": pa.array([t.decode("utf-8", "replace") for t in kept], pa.string())}
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **columns})

    if size <= sent_bytes:
        known = {bytes(r.key): (r.first.k1, r.first.k2) for r in keys.select("key", "first").collect()}
        sent = rows.sparkSession.sparkContext.broadcast(known)

        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            none = dict.fromkeys(sent.value, False)
            firsts: dict[tuple[int, int], list[bytes]] = {}
            if keep == "first":
                for key, row in sent.value.items():
                    firsts.setdefault(row, []).append(key)
            for batch in slices(batches):
                names = zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), strict=True)
                yield cleaned(batch, (ChainMap(dict.fromkeys(firsts[n], True), none) if n in firsts else none for n in names))

        return rows.mapInArrow(clean, schema)

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            owner, found = [], []
            for k, text in enumerate(binary(batch)):
                of = keys_of(text, length)
                hits = np.flatnonzero(suspected.value.suspects(hashes_of(of)))
                owner += [k] * len(hits)
                found += [of[j] for j in hits]
            who = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("k1").take(who), batch.column("k2").take(who), pa.array(found, pa.binary())], ["k1", "k2", "key"])

    of_rows = rows.mapInArrow(suspects, "k1 long, k2 long, key binary").distinct()
    stays = (F.col("first.k1") == F.col("k1")) & (F.col("first.k2") == F.col("k2")) & F.lit(keep == "first")
    hits = of_rows.join(apart(keys.select("key", "first")), "key").select("k1", "k2", F.struct("key", stays.alias("stays")).alias("hit"))
    lists = hits.groupBy("k1", "k2").agg(F.collect_list("hit").alias("hits"))

    def clean_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield cleaned(batch, ({bytes(x["key"]): x["stays"] for x in hits or []} for hits in batch.column("hits").to_pylist()))

    return rows.join(lists, ["k1", "k2"], "left").select("doc_id", "text", "hits").mapInArrow(clean_each, schema)


def digest(docs: DataFrame, least: int = 10, length: int = 1) -> DataFrame:
    """Lines of ten documents go everywhere."""
    return deduplicate_lines(docs, least=least, length=length, keep="none").select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
