"""Sequence packing by non-negative least squares over shallow combinations of lengths.

1. Documents become token ids, with an end id each, and are cut into pieces: full windows from the start,
   and one tail. A full piece is a sequence of its own.
2. Tails are counted by length. All ways to fill a window with one, two or three lengths in steps of ``STEP``
   tokens (rounded up) are enumerated; non-negative least squares says how often to use each so that together
   they use up the histogram. The numbers are rounded down, and tails are taken for them by exact length.
3. What is left is packed greedily by exact lengths, still by counts: first into the room that rounding left
   in step 2, then into new sequences: the longest length that is left, then again and again the longest that
   fits. The plan has a few entries per length, whatever the number of documents.
4. Each tail takes a place in the plan by its rank among those of its length. Ranks come from counts per
   block of documents, so no length has to be gathered in one task; the plan says which sequence the place is in and
   at which offset, so pieces find theirs where they are and are not moved.

Padding is room that no tail that is left fits into; no tail is cut.

Defined results: null and empty texts are the end id alone. Rows that are there twice are packed twice, null
ids are kept. An empty table gives an empty result. Texts of any length are tokenized whole. Other columns
are not looked at.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.common import pick, sent_if_few, slices, staged

WINDOW, STEP, DEPTH = 2048, 8, 3
END_ID = 1

class Encoder:
    """Token ids of texts. A byte-level tokenizer whose merges are in the order of ids has a faster twin."""

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        known = json.loads(model)
        before = known.get("pre_tokenizer") or {}
        plain = known.get("normalizer") is None and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        self.quick = _by_rank(known) if plain else None
        self.special = [x["content"] for x in known.get("added_tokens", [])]

    def slow(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        if not self.quick:
            return self.slow(texts)
        # The twin knows no special tokens.
        return [self.slow([t])[0] if any(s in t for s in self.special) else self.quick.encode_ordinary(t) for t in texts]


def _by_rank(model: dict):
    """The same encoder in its faster form, if the merges are in the order of the ids that they make; else none."""
    import public_tokenizers
    import tiktoken

    of, vocabulary = model["model"], model["model"].get("vocab", {})
    merges = [m.split(" ") if isinstance(m, str) else m for m in of.get("merges", [])]
    plain = of.get("type") == "BPE" and not of.get("dropout") and not of.get("byte_fallback") and not of.get("ignore_merges")
    made = [vocabulary.get(a + b, -1) for a, b in merges]
    if not plain or made != sorted(made) or len(set(made)) < len(made):
        return None
    # Byte-level vocabularies write the printable bytes as themselves, the others from code point 256 on.
    same = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(same)]
    byte = {chr(b): b for b in same} | {chr(256 + k): b for k, b in enumerate(others)}
    special = {x["content"] for x in model.get("added_tokens", [])}
    ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if token not in special}
    return tiktoken.Encoding("twin", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """Tokenize and cut; one row per piece, written to the shared folder.

    Columns doc_id, start, length, doc_tokens, ids (if ``keep_ids``; binary, little-endian unsigned 32-bit),
    ids_crc32, size (the length; 0 for a full window), block, and rank among those of its size in its block.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = pick(docs, doc_id=id_col, text=text_col)
    id_type = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        block = TaskContext.get().partitionId()
        ranks = np.zeros(window, np.int64)
        for batch in slices(batches, limit=1 << 20):
            owner, rows = [], []
            for k, ids in enumerate(encoder.encode([t or "" for t in batch.column("text").to_pylist()])):
                ids = np.array([*ids, end_id], "<u4")
                for start in range(0, len(ids), window):
                    part = ids[start : start + window].tobytes()
                    length = len(part) // 4
                    size = length % window
                    owner.append(k)
                    rows.append((start, length, len(ids), part, zlib.crc32(part), size, ranks[size]))
                    ranks[size] += 1
            made = dict(zip(("start", "length", "doc_tokens", "ids", "ids_crc32", "size", "rank"), zip(*rows, strict=True), strict=True))
            columns = {c: pa.array(v, kinds[c]) for c, v in made.items() if c in kinds}
            columns["block"] = pa.array(np.full(len(rows), block))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").take(pa.array(owner)), **columns})

    kinds = dict.fromkeys(("start", "length", "doc_tokens", "ids", "ids_crc32", "size", "rank", "block"), pa.int64()) | {"ids": pa.binary()}
    if not keep_ids:
        del kinds["ids"]
    schema = ", ".join(f"{c} {'binary' if c == 'ids' else 'long'}" for c in kinds)
    return staged(source.mapInArrow(run, f"doc_id {id_type}, {schema}"))


def combinations(units: int) -> np.ndarray:
    """All ways to write ``units`` as a sum of one to three sizes, as counts per size: (size, way)."""
    ways = [(units,)] + [(a, units - a) for a in range(units - 1, (units - 1) // 2, -1)]
    for a in range(units - 2, 0, -1):
        for b in range(min(a, units - a - 1), 0, -1):
            c = units - a - b
            if c <= b:
                ways.append((a, b, c))
    out = np.zeros((units + 1, len(ways)))
    for k, way in enumerate(ways):
        np.add.at(out[:, k], list(way), 1)
    return out


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Non-negative least squares by the active-set method."""
    x = np.zeros(a.shape[1])
    active = np.zeros(a.shape[1], bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(b).max(initial=0))) * a.shape[0]
    for _ in range(3 * a.shape[0]):
        slope = a.T @ (b - a @ x)
        slope[active] = -np.inf
        k = int(slope.argmax())
        if slope[k] <= tolerance:
            break
        active[k] = True
        while True:
            place = np.flatnonzero(active)
            best = np.linalg.lstsq(a[:, place], b, rcond=None)[0]
            low = best <= 1e-12
            if not low.any():
                x[:] = 0
                x[place] = best
                break
            now = x[place]
            share = float(np.min(now[low] / np.maximum(now[low] - best[low], 1e-300)))
            now = now + share * (best - now)
            gone = low & (now <= 1e-9 * max(1.0, float(now.max())))
            if not gone.any():
                gone = low
            x[:] = 0
            x[place] = np.where(gone, 0, now)
            active[place[gone]] = False
    return x


def plan(histogram: np.ndarray, step: int = 1) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of sizes, largest first, and how often each is used; together they use every tail once.

    ``histogram[s]`` counts the tails of size s; a window holds len(histogram) - 1. Least squares looks at sizes in
    steps, the rest at sizes as they are.
    """
    window = len(histogram) - 1
    units = window // step
    left = histogram.astype(np.int64).copy()
    opened = []
    coarse = np.bincount(-(-np.arange(window + 1) // step), left, units + 2).astype(np.int64)[: units + 1]
    if coarse.sum():
        ways = combinations(units)
        # Only those whose sizes all occur.
        ways = ways[:, ((ways > 0) <= (coarse > 0)[:, None]).all(0)]
        if ways.shape[1]:
            times = np.floor(nnls(ways, coarse.astype(float)) + 1e-6).astype(np.int64)
            for k in np.flatnonzero(times):
                way = ways[:, k].astype(np.int64)
                often = int(min(times[k], (coarse[way > 0] // way[way > 0]).min()))
                coarse -= often * way
                opened += exactly(np.repeat(np.arange(units + 1), way)[::-1].tolist(), often, left, step)
    found = filled(opened, left)
    while left.any():
        way, room, spare = [], window, left.copy()
        while True:
            fits = np.flatnonzero(spare[: room + 1])
            if not len(fits):
                break
            size = int(fits[-1])
            often = min(int(spare[size]), room // size)
            way += [size] * often
            spare[size] -= often
            room -= size * often
        counts = np.bincount(way, minlength=window + 1)
        often = int((left[counts > 0] // counts[counts > 0]).min())
        left -= often * counts
        found.append((tuple(way), often))
    return found


def exactly(way: list[int], often: int, left: np.ndarray, step: int) -> list[tuple[list[int], int]]:
    """Take tails for a combination of sizes in steps, the longest first; ``left`` loses them."""
    found = []
    while often:
        counts: dict[int, int] = {}
        for size in way:
            length = next(x for x in range(size * step, (size - 1) * step, -1) if left[x] > counts.get(x, 0))
            counts[length] = counts.get(length, 0) + 1
        times = min(often, *(int(left[x]) // n for x, n in counts.items()))
        for x, n in counts.items():
            left[x] -= n * times
        often -= times
        found.append(([x for x, n in counts.items() for _ in range(n)], times))
    return found


def filled(opened: list[tuple[list[int], int]], left: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Put tails that are left where there is room, the longest that fits first; ``left`` loses them."""
    found, open_ = [], opened[::-1]
    while open_:
        way, times = open_.pop()
        room = len(left) - 1 - sum(way)
        fits = np.flatnonzero(left[: room + 1])
        if not len(fits):
            found.append((tuple(sorted(way, reverse=True)), times))
            continue
        size = int(fits[-1])
        each = min(room // size, int(left[size]) // times)
        if not each:
            # Too few for all of them.
            some = int(left[size])
            open_.append((way, times - some))
            each, times = 1, some
        left[size] -= each * times
        open_.append((way + [size] * each, times))
    return found


def places(planned: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """The plan by size: (size, first rank, rank behind the last, ranks per sequence, first sequence, offset there)."""
    rows = []
    used: dict[int, int] = {}
    sequence = 0
    for way, often in planned:
        for size in sorted(set(way)):
            many, first = way.count(size), used.get(size, 0)
            # Those of one size stand next to each other, behind the larger ones.
            rows.append((size, first, first + many * often, many, sequence, sum(s for s in way if s > size)))
            used[size] = first + many * often
        sequence += often
    # Full windows are sequences of their own.
    return [*rows, (0, 0, 1 << 62, 1, sequence, 0)]


def pack(cut: DataFrame, window: int = WINDOW, step: int = STEP) -> DataFrame:
    """Pieces with sequence_id and offset. ``cut`` as ``pieces`` gives it."""
    # One row per size.
    histogram = np.zeros(window + 1, np.int64)
    by_block = cut.groupBy("block", "size").agg(F.count(F.lit(1)).alias("n"))
    for size, n in by_block.groupBy("size").agg(F.sum("n")).collect():
        histogram[size] = n
    histogram[0] = 0
    # Ranks among all blocks: a table with a row per block and size that occur together.
    before = by_block.select("block", "size", (F.sum("n").over(Window.partitionBy("size").orderBy("block")) - F.col("n")).alias("before"))
    ranked = cut.join(sent_if_few(staged(before)), ["block", "size"]).withColumn("rank", F.col("rank") + F.col("before")).drop("before", "block")
    # A few rows per size, whatever the number of documents.
    table = cut.sparkSession.createDataFrame(places(plan(histogram, step)), "of long, first long, upto long, many long, sequence long, at long")
    found = ranked.join(F.broadcast(table), (F.col("size") == F.col("of")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("upto")))
    turn = F.col("rank") - F.col("first")
    placed = found.withColumns({"sequence_id": F.col("sequence") + F.expr("(rank - first) div many"), "offset": F.col("at") + turn % F.col("many") * F.col("size")})
    return placed.drop("size", "rank", "of", "first", "upto", "many", "sequence", "at")


PLACES = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def digest(docs: DataFrame, model: str) -> DataFrame:
    """Where each piece of each document goes, with a checksum of its ids."""
    return pack(pieces(docs, model, keep_ids=False)).select(*PLACES)


def packed(docs: DataFrame, model: str) -> DataFrame:
    """The same with the ids themselves: a sequence is its pieces in the order of their offsets."""
    return pack(pieces(docs, model)).select(*PLACES, "ids")
