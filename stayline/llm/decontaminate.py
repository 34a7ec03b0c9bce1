"""Benchmark passages in documents, found with spaced-seed hashes and verified word by word.

Words are runs of letters and digits, lower-cased. A mask of ones and zeros is laid over the words; those
under a zero are ignored, so a hash of the rest still meets its partner when a word there was replaced.

1. The hashes of all benchmark items under all masks make a sorted index.
2. Each document is hashed at every word under every mask and looked up. A hit gives an item and a diagonal (place
   in the document minus place in the item).
3. Around hits, the words on the diagonal are compared: the best stretch (a match counts 1, a substitution
   ``-SUBSTITUTION``) is an overlap if it has ``LEAST_WORDS`` equal words. So is the diagonal from its first to
   its last equal word, if all but a fifth of the item's words are equal there, wherever the others are.

A benchmark of up to ``SENT_WORDS`` words (checked first) is sent to all tasks: documents are looked up and verified
where they are read, nothing is shuffled, and contaminated rows are dropped in the same pass. A larger one is joined
by hash: tasks hand on the hashes that a bit table of fixed size knows, not the words, and only documents with a joined
hash are read again for the comparison. Both ways give the same rows. A hot passage costs a few hashes per document
that has it; documents that share it never meet each other.

Items shorter than the longest mask also have masks of their own length, which together ignore every choice of the
words that a fifth of the item allows to differ.

Defined results: null and empty texts, and texts without a word, overlap with nothing. Items of fewer than
``SHORTEST`` words are never reported: so few words stand in many texts that were not copied. Rows that are
there twice are reported twice, null ids too. Empty tables give an empty result. Other columns are not
looked at.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import Words, letters, mixed, numbered, pick, place, slices, staged

# Which words of a stretch count.
MASKS = ("11101101011", "1101011101101", "111010010110111")
#: Equal words of an overlap; least words of an item; share of it that is enough; price of a substitution.
LEAST_WORDS, SHORTEST, SHARE, SUBSTITUTION = 13, 5, 0.8, 2
#: Bits of the table that documents are checked against first.
TABLE_BITS = 22
#: Words of a benchmark that is sent to all tasks at most (8 bytes each, and 16 a mask for their hashes).
SENT_WORDS = 1 << 20
TOGETHER = 1 << 20

LETTERS = letters(str.isalnum)


def seeds(word: np.ndarray, mask: str) -> np.ndarray:
    """The hash of each place under a mask."""
    n = max(0, len(word) - len(mask) + 1)
    sums = np.full(n, int(mask, 2) + (len(mask) << 32), np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            sums = sums * np.uint64(0x9E3779B97F4A7C15) + word[k : k + n]
    return mixed(sums)


def short_masks(n: int) -> list[str]:
    """Few masks over n words so that any choice of as many words as may differ is ignored by one; four ones at least."""
    differ = n - math.ceil(SHARE * n)
    zeros = min(n - 4, 2 * differ)
    choices = {z: set(itertools.combinations(z, differ)) for z in itertools.combinations(range(n), zeros)}
    left, found = set(itertools.combinations(range(n), differ)), []
    while left:
        gone = max(choices, key=lambda z: len(left & choices[z]))
        left -= choices[gone]
        found.append("".join("0" if k in gone else "1" for k in range(n)))
    return found


def hashed(texts: list[str | None]) -> Iterator[np.ndarray]:
    words = Words([t.lower() if t else "" for t in texts], LETTERS)
    hashes = words.hashes()
    for k in range(len(texts)):
        yield hashes[words.first[k] : words.first[k + 1]]


def item_words(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns item_id, item (number of the row) and words (binary, 64-bit hashes); items that are long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=TOGETHER):
            words = [w.tobytes() for w in hashed(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), batch.column("item"), pa.array(words, pa.binary())], ["item_id", "item", "words"])

    source = pick(items, item_id=id_col, text=text_col).withColumn("item", F.monotonically_increasing_id())
    id_type = source.schema["item_id"].dataType.simpleString()
    words = source.mapInArrow(run, f"item_id {id_type}, item long, words binary")
    return staged(words.filter(F.octet_length("words") >= 8 * SHORTEST))


def item_seeds(word: np.ndarray, masks: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of an item under all masks, and their places in it."""
    # Masks of an item's own length are there for short items only.
    fit = [m for m in masks if len(m) <= len(word) and (m in MASKS or len(m) == len(word))]
    found = [seeds(word, m) for m in fit]
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *found]), np.concatenate([none, *(np.arange(len(f)) for f in found)]).astype(np.int64)


def item_hashes(items: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """Columns hash, item and at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, data in zip(batch.column("item").to_pylist(), batch.column("words").to_pylist(), strict=True):
                found, at = item_seeds(np.frombuffer(data, np.uint64), masks)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(np.full(len(found), item)), pa.array(at)], ["hash", "item", "at"])

    return items.select("item", "words").mapInArrow(run, "hash long, item long, at long")


def known_cells(hashes: np.ndarray) -> np.ndarray:
    """The bit table of some hashes."""
    bits = np.zeros(1 << TABLE_BITS, bool)
    bits[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
    return bits


class Index:
    """A benchmark that fits into a task: hashes in order with item and place, and the words of each item."""

    def __init__(self, words: list[np.ndarray], masks: tuple[str, ...]):
        self.words, self.masks = words, masks
        found = [item_seeds(w, masks) for w in words]
        hashes = np.concatenate([np.zeros(0, np.uint64), *(f[0] for f in found)])
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.item = np.repeat(np.arange(len(words)), [len(f[0]) for f in found])[order]
        self.at = np.concatenate([np.zeros(0, np.int64), *(f[1] for f in found)])[order]
        self.bits = known_cells(hashes)

    def overlaps(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """Text, item, equal words, start and end of all overlaps."""
        words, hashes, owner = read(texts)
        place, seed = hits(hashes, owner, self.masks, self.bits)
        low, high = (np.searchsorted(self.hashes, seed, side) for side in ("left", "right"))
        n = high - low
        entry = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        place = np.repeat(place, n)
        text, item = owner[place], self.item[entry]
        rows = np.unique(np.stack([text, item, place - words.first[text] - self.at[entry]], 1), axis=0) if len(place) else np.zeros((0, 3), np.int64)
        found = []
        for (k, j), group in itertools.groupby(rows.tolist(), key=lambda r: (r[0], r[1])):
            best = verified(hashes[words.first[k] : words.first[k + 1]], self.words[j], [r[2] for r in group])
            if best:
                found.append((k, j, *best))
        return found


def read(texts: list[str | None]) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of texts, their hashes, and which text each belongs to."""
    words = Words([t.lower() if t else "" for t in texts], LETTERS)
    return words, words.hashes(), np.repeat(np.arange(len(texts)), np.diff(words.first))


def hits(hashes: np.ndarray, owner: np.ndarray, masks: tuple[str, ...], bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (overall) and seeds that the bit table knows."""
    at, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for mask in masks:
        seed = seeds(hashes, mask)
        inside = owner[: len(seed)] == owner[len(mask) - 1 :]
        hit = np.flatnonzero(bits[(seed >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] & inside)
        at.append(hit)
        found.append(seed[hit])
    return np.concatenate(at), np.concatenate(found)


def verified(word: np.ndarray, item: np.ndarray, diagonals: list[int]) -> tuple[int, int, int] | None:
    """The best overlap on the diagonals: equal words, start and end in the document."""
    best = None
    for diagonal in sorted(set(diagonals)):
        start, end = max(0, diagonal), min(len(word), len(item) + diagonal)
        if end <= start:
            continue
        same = word[start:end] == item[start - diagonal : end - diagonal]
        gains = np.concatenate([[0], np.cumsum(np.where(same, 1, -SUBSTITUTION))])
        low = np.minimum.accumulate(gains)
        last = int((gains - low).argmax())
        first = int(np.flatnonzero(gains[: last + 1] == low[last])[-1])
        equal, whole = int(same[first:last].sum()), int(same.sum())
        if whole > equal and whole >= SHARE * len(item):
            equal, places = whole, np.flatnonzero(same)
            first, last = int(places[0]), int(places[-1]) + 1
        if (equal >= LEAST_WORDS or equal >= SHARE * len(item)) and (best is None or equal > best[0]):
            best = (equal, start + first, start + last)
    return best


def prepared(benchmark: DataFrame, item_col: str, item_text_col: str, sent_words: int) -> tuple[DataFrame, tuple[str, ...], bool]:
    """The items, the masks for their lengths, and whether they are few enough to be sent."""
    items = item_words(benchmark, item_col, item_text_col)
    n = (F.octet_length("words") / 8).cast("int")
    lengths = [r[0] for r in items.filter(n < len(MASKS[-1])).select(n).distinct().collect()]
    masks = tuple(dict.fromkeys([*MASKS, *(m for n in sorted(lengths) for m in short_masks(n))]))
    return items, masks, (items.agg(F.sum(n.cast("long"))).first()[0] or 0) <= sent_words


def sent(items: DataFrame, masks: tuple[str, ...]):
    """The index and the ids of its items, for all tasks."""
    table = items.select("item_id", "words").toArrow()
    words = [np.frombuffer(w, np.uint64) for w in table.column("words").to_pylist()]
    return items.sparkSession.sparkContext.broadcast((Index(words, masks), table.column("item_id").combine_chunks()))


FIGURES = ("n_words", "start_word", "end_word", "item_words")


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", sent_words: int = SENT_WORDS) -> DataFrame:
    """One row per document and benchmark item that overlap.

    Columns doc_id, item_id, n_words (equal words), start_word and end_word (in the document), item_words.
    """
    source = pick(docs, doc_id=id_col, text=text_col)
    items, masks, few = prepared(benchmark, item_col, item_text_col, sent_words)
    if not few:
        return joined_overlaps(with_names(source), items, masks).select("doc_id", "item_id", *FIGURES)
    shared = sent(items, masks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, ids = shared.value
        for batch in slices(batches, limit=TOGETHER):
            found = index.overlaps(batch.column("text").to_pylist())
            text, item = ([f[i] for f in found] for i in range(2))
            figures = [*([f[i] for f in found] for i in range(2, 5)), [len(index.words[j]) for j in item]]
            columns = [batch.column("doc_id").take(pa.array(text, pa.int64())), ids.take(pa.array(item, pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(f, pa.int64()) for f in figures)], ["doc_id", "item_id", *FIGURES])

    return source.mapInArrow(run, _schema(source, items))


def _schema(rows: DataFrame, items: DataFrame) -> str:
    doc, item = rows.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    return f"doc_id {doc}, item_id {item}, {', '.join(f'{c} long' for c in FIGURES)}"


def with_names(rows: DataFrame) -> DataFrame:
    """Adds two hashes that name a row by id and text; rows that are equal in both overlap with the same items."""
    return rows.withColumns({"k1": F.xxhash64("doc_id", "text"), "k2": F.hash("text", "doc_id").cast("long")})


def joined_overlaps(rows: DataFrame, items: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """The same for a benchmark of any size; with k1 and k2 of the row."""
    table = staged(item_hashes(items, masks))
    cell = F.shiftrightunsigned("hash", 64 - TABLE_BITS)
    cells = table.groupBy(F.shiftright(cell, 6).alias("cell")).agg(F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned(hash, {64 - TABLE_BITS}) & 63 as int)))").alias("bits"))
    # At most 2 ** (TABLE_BITS - 6) rows, whatever the size of the benchmark.
    known = np.zeros(1 << (TABLE_BITS - 6), np.int64)
    for row in cells.collect():
        known[row[0]] = row[1]
    bits = rows.sparkSession.sparkContext.broadcast(np.unpackbits(known.view(np.uint8), bitorder="little").astype(bool))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=TOGETHER):
            words, hashes, owner = read(batch.column("text").to_pylist())
            at, seed = hits(hashes, owner, masks, bits.value)
            who = pa.array(owner[at])
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1").take(who), batch.column("k2").take(who), pa.array(seed.view(np.int64)), pa.array(at - words.first[owner[at]])], ["k1", "k2", "hash", "doc_at"]
            )

    seen = rows.mapInArrow(run, "k1 long, k2 long, hash long, doc_at long")
    pairs = seen.join(table, "hash").groupBy("k1", "k2", "item").agg(F.collect_set(F.col("doc_at") - F.col("at")).alias("diagonals"))
    both = rows.join(pairs, ["k1", "k2"]).join(items, "item")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=TOGETHER):
            kept, found = [], []
            words, hashes, _ = read(batch.column("text").to_pylist())
            for k, (data, diagonals) in enumerate(zip(batch.column("words").to_pylist(), batch.column("diagonals").to_pylist(), strict=True)):
                item = np.frombuffer(data, np.uint64)
                best = verified(hashes[words.first[k] : words.first[k + 1]], item, diagonals)
                if best:
                    kept.append(k)
                    found.append((*best, len(item)))
            take = pa.array(kept, pa.int64())
            figures = [pa.array([r[i] for r in found], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in ("k1", "k2", "doc_id", "item_id")), *figures], ["k1", "k2", "doc_id", "item_id", *FIGURES])

    return both.select("k1", "k2", "doc_id", "text", "item_id", "words", "diagonals").mapInArrow(verify, f"k1 long, k2 long, {_schema(rows, items)}")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", sent_words: int = SENT_WORDS) -> DataFrame:
    """The rows that overlap with no benchmark item, with all their columns."""
    plain = numbered(docs)
    items, masks, few = prepared(benchmark, "item_id", "text", sent_words)
    text = f"_{place(docs, text_col)}"
    if few:
        shared = sent(items, masks)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, text, TOGETHER):
                keep = np.ones(batch.num_rows, bool)
                keep[[f[0] for f in shared.value[0].overlaps(batch.column(text).to_pylist())]] = False
                yield batch.filter(pa.array(keep))

        return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
    names = {"doc_id": F.col(f"_{place(docs, id_col)}"), "text": F.col(text)}
    named = with_names(plain.withColumns(names))
    gone = joined_overlaps(named.select("doc_id", "text", "k1", "k2"), items, masks).select("k1", "k2").distinct()
    return named.join(gone, ["k1", "k2"], "left_anti").select(*plain.columns).toDF(*docs.columns)
