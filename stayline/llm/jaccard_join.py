"""Similarity join on word shingles with adaptive multi-match prefixes, and its components.

Words are what stands between white space, A-Z lower-cased. A document's set holds its distinct shingles of
four words (fewer words: the whole sequence is one). Two documents are linked when
100 * intersection >= 85 * union.

1. Documents with equal sets form a class; classes are joined, members follow their class.
2. A count sketch of fixed size over all shingles gives one order for all documents: rare shingles first,
   hashes break ties. Whatever the sketch says, the order is the same for all, so no link can be lost.
3. Prefix of a class: if it is the longer one of a pair, the first n - ceil(0.85 n) + k shingles, as the
   shorter one n - ceil(170 n / 185) + k. Linked classes share at least min(k, k') shingles there. Each
   class takes the k up to ``MOST`` with the lowest cost, as the sketch estimates it: a longer prefix costs
   entries, but more shared shingles are asked for before a pair is verified.
4. Shingles of few classes give all their pairs; a pair needs enough matches. A shingle of many classes
   gives one star at first: parity bitmaps bound the overlap, and the class that may reach most others is
   their centre. Verified stars unite most of a large family.
5. After that only pairs of different components are left to look at, and all of those are: counted over
   all shared shingles, bounded by bitmap, verified on whole sets.

So families with thousands of members don't give all their pairs, and yet no link between components is
missed. A hot shingle is cut into chunks of ``CHUNK`` classes; pairs of chunks are separate groups.

Defined results: null and empty texts, and white space alone, have no shingles and are their own component.
Rows that are there twice are one class. A null id is larger than any other. Empty tables give an empty
result. Other columns are not looked at. Sets are compared by 64-bit hashes of shingles.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import NOT_SPACE, Words, apart, buckets_for, mixed, numbered, only_kept, pick, place, slices, staged, stretch_hashes, with_names
from stayline.llm.components import components


@dataclass(frozen=True)
class Rule:
    """Words in a shingle, and the similarity from which documents are linked, in percent."""

    shingle: int = 4
    percent: int = 85

    def needed(self, n, m):
        """Least intersection of linked sets of these sizes."""
        return -(-self.percent * (n + m) // (100 + self.percent))


#: Counters of the sketch, in bits; parts in which it is added up; tasks whose counters are added up first.
SKETCH_BITS, SKETCH_PARTS, SKETCH_TEAM = 22, 64, 32
#: Largest k; cost of verifying a pair against that of an entry.
MOST, VERIFY = 3, 20.0
#: Longs of the parity bitmap.
BITMAP = 8
#: Up to so many classes a shingle gives all its pairs at once; larger groups are cut into chunks.
SMALL, CHUNK = 24, 2048
#: Entries that one task sorts.
ENTRIES = 1 << 21
#: Bits of the table of classes whose sets are needed.
TABLE_BITS = 22


def shingles_of(texts: list[str | None], shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words([t or "" for t in texts], NOT_SPACE, lower_ascii=True)
    hashes = words.hashes()
    counts = np.diff(words.first)
    starts = words.first[:-1]
    whole = np.flatnonzero((counts > 0) & (counts < shingle))
    short = dict(zip(whole, stretch_hashes(hashes, starts[whole], starts[whole] + counts[whole]), strict=True))
    at = np.arange(max(0, len(hashes) - shingle + 1))
    rolled = stretch_hashes(hashes, at, at + shingle)
    empty = np.zeros(0, np.uint64)
    return [
        np.unique(rolled[s : s + n - shingle + 1]) if n >= shingle else np.array([short[k]], np.uint64) if n else empty
        for k, (s, n) in enumerate(zip(starts, counts, strict=True))
    ]


def class_of(shingles: np.ndarray) -> int:
    """One number for a set."""
    return int(mixed(np.array([mixed(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) + np.uint64(len(shingles))], np.uint64)).view(np.int64)[0])


def bitmap_of(shingles: np.ndarray) -> np.ndarray:
    """For each bit, the parity of the shingles that fall on it. Two sets differ in at least as many shingles as bits."""
    bits = np.bincount((shingles >> np.uint64(20)).astype(np.int64) % (64 * BITMAP), minlength=64 * BITMAP) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.uint64)


class Sketch:
    """Levels of frequency by hashed shingle, and the frequency that is mere chance."""

    def __init__(self, counts: np.ndarray):
        chance = float(np.median(counts))
        self.levels = np.minimum(255, 8 * np.log2(1 + counts.astype(np.float64))).astype(np.uint8)
        self.above = chance + 3 * np.sqrt(chance)

    def prefix(self, shingles: np.ndarray, rule: Rule) -> tuple[np.ndarray, int, int]:
        """Prefix as the longer one, how much of it is prefix as the shorter one, and k."""
        n = len(shingles)
        levels = self.levels[(shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
        probe, index = n - -(-rule.percent * n // 100), n - -(-2 * rule.percent * n // (100 + rule.percent))
        order = np.lexsort((shingles, levels))[: probe + MOST]
        counts = np.exp2(levels[order] / 8) - 1
        partners = np.where(counts > self.above, counts, np.minimum(counts, 1))
        best = 1
        costs = []
        for k in range(1, MOST + 1):
            found = partners[: probe + k].sum()
            costs.append((probe + k) + found + VERIFY * found / k)
            # No set has to share more than what its links must share.
            if probe + k > n or k > max(1, -(-rule.percent * n // 100)):
                costs.pop()
        best = 1 + int(np.argmin(costs)) if costs else 1
        return shingles[order[: min(n, probe + best)]], min(n, index + best), best


def classes(docs: DataFrame, rule: Rule) -> DataFrame:
    """Columns doc_id, row_id, n and cid (null without shingles) of every row, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=1 << 20):
            sets = shingles_of(batch.column("text").to_pylist(), rule.shingle)
            cids = pa.array([class_of(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_id"), pa.array([len(s) for s in sets], pa.int64()), cids], ["doc_id", "row_id", "n", "cid"]
            )

    id_type, row_type = (docs.schema[c].dataType.simpleString() for c in ("doc_id", "row_id"))
    return staged(docs.mapInArrow(run, f"doc_id {id_type}, row_id {row_type}, n long, cid long"))


def sketch(docs: DataFrame, rule: Rule) -> Sketch:
    """Count the shingles of all documents into a table of fixed size."""
    size = (1 << SKETCH_BITS) // SKETCH_PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in slices(batches, limit=1 << 20):
            all_ = np.concatenate([np.zeros(0, np.uint64), *shingles_of(batch.column("text").to_pylist(), rule.shingle)])
            np.add.at(counts, (all_ >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
        packed = [zlib.compress(counts[i * size : (i + 1) * size].astype(np.uint64).tobytes(), 1) for i in range(SKETCH_PARTS)]
        team = TaskContext.get().partitionId() // SKETCH_TEAM
        yield pa.RecordBatch.from_pydict({"part": np.arange(SKETCH_PARTS), "team": np.full(SKETCH_PARTS, team), "counts": packed})

    def add(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.uint64)
        for batch in parts:
            for blob in batch.column("counts"):
                total += np.frombuffer(zlib.decompress(blob.as_py()), np.uint64)
        yield pa.RecordBatch.from_pydict({"part": [key[0].as_py()], "team": [0], "counts": [zlib.compress(total.tobytes(), 1)]})

    # First within teams of tasks, then the teams: no task gets the tables of all tasks.
    schema = "part long, team long, counts binary"
    teams = docs.select("text").mapInArrow(count, schema).groupBy("part", "team").applyInArrow(add, schema)
    counted = teams.groupBy("part").applyInArrow(add, schema).select("part", "counts")
    found = np.zeros(1 << SKETCH_BITS, np.uint64)
    for part, blob in counted.collect():
        found[part * size : (part + 1) * size] = np.frombuffer(zlib.decompress(blob), np.uint64)
    return Sketch(found)


ENTRY = np.dtype([("token", "<u8"), ("cid", "<i8"), ("n", "<u4"), ("index", "u1"), ("k", "u1")])
PAIR = "a long, b long, n_a long, n_b long, k int, often long"


def entries(docs: DataFrame, rule: Rule, order: Sketch, buckets: int) -> DataFrame:
    """Prefix entries, packed by bucket of tokens: columns bucket and entries. A class comes once per task."""
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            all_ = np.concatenate(held)
            bucket = (all_["token"] % np.uint64(buckets)).astype(np.int64)
            all_ = all_[np.argsort(bucket, kind="stable")]
            found, counts = np.unique(bucket, return_counts=True)
            ends = np.cumsum(counts)
            blobs = [all_[e - c : e].tobytes() for c, e in zip(counts, ends, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(blobs, pa.binary())], ["bucket", "entries"])

        for batch in slices(batches, limit=1 << 20):
            for shingles in shingles_of(batch.column("text").to_pylist(), rule.shingle):
                if not len(shingles) or (cid := class_of(shingles)) in done:
                    continue
                done.add(cid)
                tokens, index, k = shared.value.prefix(shingles, rule)
                new = np.empty(len(tokens), ENTRY)
                new["token"], new["cid"], new["n"], new["k"] = tokens, cid, len(shingles), k
                new["index"] = np.arange(len(tokens)) < index
                held.append(new)
                size += len(new)
            if size > ENTRIES:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return docs.select("text").mapInArrow(run, "bucket long, entries binary")


def _groups(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries by token and class without repeats, only tokens of two classes or more; where groups start, and their sizes."""
    all_ = np.concatenate([np.frombuffer(x, ENTRY) for x in blobs])
    all_ = all_[np.lexsort((all_["cid"], all_["token"]))]
    new = np.append(True, (all_["token"][1:] != all_["token"][:-1]) | (all_["cid"][1:] != all_["cid"][:-1]))
    all_ = all_[new]
    starts = np.flatnonzero(np.append(True, all_["token"][1:] != all_["token"][:-1]))
    counts = np.diff(np.append(starts, len(all_)))
    many = counts > 1
    return all_[np.repeat(many, counts)], np.cumsum(counts[many]) - counts[many], counts[many]


def _fit(x: np.ndarray, y: np.ndarray, rule: Rule) -> np.ndarray:
    """Whether entries of one token may stand for a pair: sizes, and the prefix of the shorter one."""
    swap = (x["n"] > y["n"]) | (x["n"] == y["n"]) & (x["cid"] > y["cid"])
    low, high = np.where(swap, y["n"], x["n"]).astype(np.int64), np.where(swap, x["n"], y["n"]).astype(np.int64)
    return np.where(swap, y["index"], x["index"]).astype(bool) & (rule.percent * high <= 100 * low)


def _pairs(x: np.ndarray, y: np.ndarray) -> dict:
    """Pairs of entries, counted."""
    swap = x["cid"] > y["cid"]
    a, b = np.where(swap, y["cid"], x["cid"]), np.where(swap, x["cid"], y["cid"])
    n_a, n_b = np.where(swap, y["n"], x["n"]), np.where(swap, x["n"], y["n"])
    key = np.stack([a, b], 1)
    found, first, often = np.unique(key, axis=0, return_index=True, return_counts=True) if len(a) else (key, [], [])
    first = np.asarray(first, np.int64)
    return {
        "a": found[:, 0], "b": found[:, 1], "n_a": n_a[first].astype(np.int64), "n_b": n_b[first].astype(np.int64),
        "k": np.minimum(x["k"], y["k"])[first].astype(np.int32), "often": np.asarray(often, np.int64),
    }


def candidates(packed: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Pairs from small groups with their matches (PAIR), and the entries of large groups."""
    large = "token long, cid long, n long, is_index boolean, k int, size long"

    def run(table: pa.Table) -> pa.Table:
        all_, starts, counts = _groups([x.as_py() for x in table.column("entries")])
        small = counts <= SMALL
        left, right = [], []
        for gap in range(1, SMALL):
            # Each entry with the one that stands so many places behind it in the same small group.
            ends = np.repeat(starts + counts, counts)
            at = np.flatnonzero(np.repeat(small, counts) & (np.arange(len(all_)) + gap < ends))
            if not len(at):
                break
            fits = _fit(all_[at], all_[at + gap], rule)
            left.append(at[fits])
            right.append(at[fits] + gap)
        left, right = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (left, right))
        pairs = _pairs(all_[left], all_[right])
        big = all_[np.repeat(~small, counts)]
        size = np.repeat(counts[~small], counts[~small])
        n, m = len(pairs["a"]), len(big)
        none = lambda k, kind: pa.nulls(k, kind)
        kinds = {"a": pa.int64(), "b": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "k": pa.int32(), "often": pa.int64()}
        columns = {c: pa.concat_arrays([pa.array(pairs[c], t), none(m, t)]) for c, t in kinds.items() if c != "k"}
        columns["k"] = pa.concat_arrays([pa.array(pairs["k"], pa.int32()), pa.array(big["k"].astype(np.int32))])
        more = {"token": big["token"].view(np.int64), "cid": big["cid"], "n": big["n"].astype(np.int64), "is_index": big["index"].astype(bool), "size": size}
        for c, values in more.items():
            made = pa.array(values)
            columns[c] = pa.concat_arrays([none(n, made.type), made])
        return pa.table({c: columns[c] for c in ("a", "b", "n_a", "n_b", "k", "often", "token", "cid", "n", "is_index", "size")})

    schema = "a long, b long, n_a long, n_b long, k int, often long, token long, cid long, n long, is_index boolean, size long"
    found = staged(packed.groupBy("bucket").applyInArrow(run, schema))
    pairs = found.filter("a is not null").groupBy("a", "b").agg(F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"), F.min("k").alias("k"), F.sum("often").alias("often"))
    return staged(pairs), found.filter("token is not null").select(*[x.split()[0] for x in large.split(", ")])


def sets_of(docs: DataFrame, rule: Rule, wanted: DataFrame) -> DataFrame:
    """Columns cid, shingles and bitmap (binary) of the classes in ``wanted`` (cid), once each or nearly so."""
    spark = docs.sparkSession
    cell = F.shiftrightunsigned("cid", 64 - TABLE_BITS)
    cells = wanted.groupBy(F.shiftright(cell, 6).alias("cell")).agg(F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned(cid, {64 - TABLE_BITS}) & 63 as int)))").alias("bits"))
    # A bit table of fixed size; classes that fall on a bit by chance go in the join below.
    known = np.zeros(1 << (TABLE_BITS - 6), np.int64)
    for row in cells.collect():
        known[row[0]] = row[1]
    bits = spark.sparkContext.broadcast(np.unpackbits(known.view(np.uint8), bitorder="little"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in slices(batches, limit=1 << 20):
            rows = []
            for shingles in shingles_of(batch.column("text").to_pylist(), rule.shingle):
                if not len(shingles) or (cid := class_of(shingles)) in done or not bits.value[(cid & (1 << 64) - 1) >> (64 - TABLE_BITS)]:
                    continue
                done.add(cid)
                rows.append((cid, shingles.tobytes(), bitmap_of(shingles).tobytes()))
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()), strict=True)], ["cid", "shingles", "bitmap"])

    made = docs.select("text").mapInArrow(run, "cid long, shingles binary, bitmap binary")
    return staged(made.join(wanted.select("cid").distinct(), "cid", "left_semi").dropDuplicates(["cid"]))


def _differ(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(-1).astype(np.int64)


def verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The linked ones of the pairs (a, b)."""
    bitmaps = sets.select("cid", "bitmap")
    near = (
        pairs.select("a", "b", "n_a", "n_b")
        .join(bitmaps.select(F.col("cid").alias("a"), F.col("bitmap").alias("map_a")), "a")
        .join(bitmaps.select(F.col("cid").alias("b"), F.col("bitmap").alias("map_b")), "b")
    )

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(-1, BITMAP) for c in ("map_a", "map_b"))
            n, m = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            yield batch.filter(pa.array((n + m - _differ(x, y)) // 2 >= rule.needed(n, m))).select(["a", "b"])

    whole = sets.select("cid", "shingles")
    both = (
        near.mapInArrow(bound, "a long, b long")
        .join(whole.select(F.col("cid").alias("a"), F.col("shingles").alias("set_a")), "a")
        .join(whole.select(F.col("cid").alias("b"), F.col("shingles").alias("set_b")), "b")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                same = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                kept.append(same >= rule.needed(len(x), len(y)))
            yield batch.filter(pa.array(kept, pa.bool_())).select(["a", "b"])

    return both.mapInArrow(compare, "a long, b long")


def _read(batches: Iterator[pa.RecordBatch] | list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    table = pa.Table.from_batches(list(batches))
    out = np.empty(table.num_rows, ENTRY)
    out["token"] = table.column("token").to_numpy().view(np.uint64)
    for name, column in (("cid", "cid"), ("n", "n"), ("index", "is_index"), ("k", "k")):
        out[name] = table.column(column).to_numpy()
    maps = np.frombuffer(b"".join(table.column("bitmap").to_pylist()), np.uint64).reshape(-1, BITMAP)
    root = table.column("root").to_numpy() if "root" in table.column_names else out["cid"]
    return out, maps, root, table


def _reach(one: np.ndarray, one_map: np.ndarray, all_: np.ndarray, maps: np.ndarray, rule: Rule) -> np.ndarray:
    """Which entries may be linked with one entry."""
    n, m = int(one["n"]), all_["n"].astype(np.int64)
    return ((n + m - _differ(maps, one_map)) // 2 >= rule.needed(n, m)) & (all_["cid"] != one["cid"]) & _fit(np.full(len(all_), one), all_, rule)


def stars(large: DataFrame, rule: Rule) -> DataFrame:
    """From each chunk of a large group one star after the other, until every class is in one or reaches none."""

    def run(table: pa.Table) -> pa.Table:
        all_, maps, _, _ = _read(table.to_batches())
        left, right = [], []
        seen: set[bytes] = set()
        for token in np.unique(all_["token"]):
            mine = np.flatnonzero(all_["token"] == token)
            mine = mine[np.argsort(all_["cid"][mine])]
            # Neighbouring shingles of a passage have the same classes.
            mark = all_["cid"][mine].tobytes() + all_["index"][mine].tobytes()
            if mark in seen:
                continue
            seen.add(mark)
            waiting = np.ones(len(mine), bool)
            reach = np.stack([_reach(all_[i], maps[i], all_[mine], maps[mine], rule) for i in mine])
            while True:
                gains = (reach & waiting).sum(1)
                centre = int(gains.argmax())
                if not gains[centre]:
                    break
                hit = np.flatnonzero(reach[centre] & waiting)
                left.append(np.full(len(hit), mine[centre]))
                right.append(mine[hit])
                waiting[hit] = waiting[centre] = False
        left, right = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (left, right))
        return _table(_pairs(all_[left], all_[right]))

    chunks = large.withColumn("chunk", F.pmod(F.xxhash64("cid"), F.ceil(F.col("size") / CHUNK)))
    return chunks.groupBy(F.pmod(F.xxhash64("token", "chunk"), F.lit(1 << 30)).alias("place"), "chunk").applyInArrow(run, PAIR)


def _table(pairs: dict) -> pa.Table:
    return pa.table({c: pa.array(pairs[c], pa.int32() if c == "k" else pa.int64()) for c in ("a", "b", "n_a", "n_b", "k", "often")})


def across(large: DataFrame, rule: Rule) -> DataFrame:
    """All pairs of large groups that are in different components and may be linked. ``large`` has root."""
    # A group all of whose classes are in one component has nothing left.
    open_ = large.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("token")
    chunked = large.join(open_, "token", "left_semi").withColumns({"chunks": F.ceil(F.col("size") / CHUNK), "chunk": F.pmod(F.xxhash64("cid"), F.ceil(F.col("size") / CHUNK))})
    # Chunk i meets every chunk j: the group (smaller, larger) holds both.
    meeting = chunked.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    meeting = meeting.withColumns({"one": F.least("chunk", "other"), "two": F.greatest("chunk", "other")})

    def run(table: pa.Table) -> pa.Table:
        all_, maps, root, table = _read(table.to_batches())
        chunk, two, one = (table.column(c).to_numpy() for c in ("chunk", "two", "one"))
        left, right = [], []
        alone = one[0] == two[0]
        rows = np.arange(len(all_)) if alone else np.flatnonzero(chunk == one[0])
        others = rows if alone else np.flatnonzero(chunk == two[0])
        for i in rows:
            with_ = others[(root[others] != root[i])]
            if alone:
                with_ = with_[with_ > i]
            if len(with_):
                hit = with_[_reach(all_[i], maps[i], all_[with_], maps[with_], rule)]
                left.append(np.full(len(hit), i))
                right.append(hit)
        left, right = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (left, right))
        return _table(_pairs(all_[left], all_[right]))

    return meeting.groupBy("token", "one", "two").applyInArrow(run, PAIR)


def links(docs: DataFrame, members: DataFrame, rule: Rule) -> DataFrame:
    """Links between classes (a, b) that connect every component."""
    buckets = buckets_for(3 * int(members.agg(F.sum("n")).first()[0] or 0) * (100 - rule.percent) // 200, ENTRIES)
    packed = entries(docs, rule, sketch(docs, rule), buckets)
    pairs, large = candidates(packed, rule)
    enough = pairs.filter("often >= k").select("a", "b", "n_a", "n_b")
    wanted = enough.select(F.explode(F.array("a", "b")).alias("cid")).unionByName(large.select("cid")).distinct()
    sets = sets_of(docs, rule, staged(wanted))
    mapped = staged(large.join(sets.select("cid", "bitmap"), "cid"))
    first = enough.unionByName(stars(mapped, rule).select("a", "b", "n_a", "n_b")).dropDuplicates(["a", "b"])
    tried = staged(first)
    found = staged(verified(tried, sets, rule))
    roots = components(found)
    rooted = mapped.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    more = across(rooted, rule)
    # Matches on shingles of small groups count as well.
    counted = (
        more.groupBy("a", "b")
        .agg(F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"), F.min("k").alias("k"), F.sum("often").alias("often"))
        .join(pairs.select("a", "b", F.col("often").alias("before")), ["a", "b"], "left")
        .filter(F.col("often") + F.coalesce("before", F.lit(0)) >= F.col("k"))
        .join(tried.select("a", "b"), ["a", "b"], "left_anti")
    )
    return found.unionByName(verified(staged(counted.select("a", "b", "n_a", "n_b")), sets, rule))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None, rule: Rule = Rule()) -> DataFrame:
    """One row per row: doc_id, row_id, n_shingles, class_id, root (both null without shingles) and component_id."""
    source = pick(docs, doc_id=id_col, text=text_col, **({"row_id": row_col} if row_col else {}))
    rows = source if row_col else source.withColumn("row_id", F.monotonically_increasing_id())
    members = classes(rows.select("doc_id", "row_id", "text"), rule)
    roots = components(links(source, members, rule))
    rooted = members.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    smallest = rooted.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("smallest"))
    return rooted.join(apart(smallest), "root", "left").select(
        "doc_id",
        "row_id",
        F.col("n").alias("n_shingles"),
        F.col("cid").alias("class_id"),
        "root",
        F.coalesce("smallest", "doc_id").alias("component_id"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = Rule()) -> DataFrame:
    """One row of each component, that with the smallest id (nulls last, then the first), with all its columns."""
    plain = numbered(docs)
    id_, text = f"_{place(docs, id_col)}", f"_{place(docs, text_col)}"
    rows = with_names(plain, id_, text)
    groups = staged(near_groups(rows, id_, text, "name", rule))
    key = F.struct(F.isnull("doc_id").alias("none"), F.col("doc_id").alias("id"), F.col("row_id").alias("row"))
    first = groups.filter("root is not null").groupBy("root").agg(F.min(key).getField("row").alias("first"))
    found = groups.join(apart(first), "root", "left")
    decided = found.select(F.col("row_id").alias("name"), F.coalesce(F.col("row_id") == F.col("first"), F.lit(True)).alias("kept"), "root")
    # Rows without shingles all stay, also where there are several of one name.
    return only_kept(rows, decided.filter("root is not null")).select(*plain.columns).toDF(*docs.columns)
