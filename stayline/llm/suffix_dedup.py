"""Substring dedup by bytes: suffix arrays per shard, common prefixes, merging of shards by binary search.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts anywhere else, be it in the
same document. Strings never cross documents and are judged on the input.

Stretches of text that can't hold a repeated string are left out first, and of equal stretches one stays
(see ``repeats``, over bytes); the rest is cut into parts that share most of their bytes, the core, and what
can't repeat or is equal as a whole is settled once more. What is left is dealt to shards by core, so equal
strings meet in one shard.
A shard sorts its suffixes by Larsson and Sadakane's refinement (only groups that aren't sorted yet are
sorted again, by the rank of what follows, twice as far each time), measures common prefixes after Kasai,
and marks strings that share ``LENGTH`` bytes with a neighbour. A core with more than ``SHARD_STRETCHES``
different stretches is split over several shards; such shards also give out their distinct strings as sorted hashes,
which are merged by range of hashes with binary search.

Defined results: null texts are empty; an empty text keeps nothing. Rows that are there twice remove each
other's long strings; a null id is like any other. An empty table gives an empty result. Texts of any length
are read whole. Other columns are not looked at. Strings in different stretches or split shards are equal
if two 64-bit hashes are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm import repeats
from stayline.llm.common import apart, buckets_for, slices, staged, stretch_hashes, stretch_sums, text_bytes

LENGTH = 400
#: Windows of an open stretch are told apart by cores that leave out this share of their bytes.
PARTS = 6
#: Stretches in a shard, and of one anchor in one shard.
SHARD_STRETCHES = 2048
#: Lanes in which common prefixes are measured side by side.
LANES = 2048


def _packed(symbols: np.ndarray) -> tuple[np.ndarray, int]:
    """The first symbols of each suffix as one number, and how many fit; after the end comes 0."""
    bits = max(1, (int(symbols.max()) + 1).bit_length())
    many = max(1, 63 // bits)
    padded = np.append(symbols + 1, np.zeros(many - 1, np.int64))
    key = np.zeros(len(symbols), np.int64)
    for j in range(many):
        key <<= bits
        key |= padded[j : j + len(symbols)]
    return key, many


def suffix_array(symbols: np.ndarray, depth: int, past: np.ndarray | None = None) -> np.ndarray:
    """Suffixes in order of their first ``depth`` symbols at least (Larsson and Sadakane).

    ``past`` says how far behind the last suffix that is asked for each one lies (0: it is asked for itself).
    Only those asked for come out; the others are ordered as far as these need them.
    """
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64)
    key, done = _packed(symbols)
    order = np.argsort(key)
    rank = np.empty(n, np.int64)

    def number(at: np.ndarray, new: np.ndarray) -> None:
        """Rank stretches of the order: a group has the place of its last member."""
        starts = np.flatnonzero(new)
        last = np.append(starts[1:], len(at)) - 1
        rank[order[at]] = np.repeat(at[last], np.diff(np.append(starts, len(at))))

    in_order = key[order]
    at = np.arange(n)
    number(at, np.append(True, in_order[1:] != in_order[:-1]))
    goal = done
    while goal < depth:
        goal *= 2
    while done < goal:
        # Places in groups of more than one that later rounds look at.
        if past is not None:
            at = at[past[order[at]] <= goal - 2 * done]
        group = rank[order[at]]
        same = np.zeros(len(at), bool)
        same[1:] = group[1:] == group[:-1]
        same[:-1] |= same[1:].copy()
        at, group = at[same], group[same]
        if not len(at):
            break
        suffix = order[at]
        follows = suffix + done
        # Group and rank of what follows, as one number: both are below n.
        key = group * (n + 1) + np.where(follows < n, rank[np.minimum(follows, n - 1)] + 1, 0)
        by = np.argsort(key)
        order[at] = suffix[by]
        key = key[by]
        number(at, np.append(True, key[1:] != key[:-1]))
        done *= 2
    return order if past is None else order[past[order] <= 0]


def common_prefixes(symbols: np.ndarray, order: np.ndarray, most: int, lanes: int = LANES, first: np.ndarray | None = None) -> np.ndarray:
    """For each place in the order, the symbols shared with the place before, up to ``most`` (Kasai).

    The text is cut into lanes, or at ``first``, that are walked side by side; in each, a suffix shares at
    least one symbol less than the suffix before it did, if the neighbour's next suffix is in the order as well.
    """
    n = len(symbols)
    out = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return out
    place = np.full(n + 1, -1)
    place[order] = np.arange(len(order))
    if first is None:
        size = -(-n // min(lanes, n))
        first = np.arange(0, n, size)
    at = first.copy()
    end = np.append(first[1:], n)
    shared = np.zeros(len(at), np.int64)
    padded = np.append(symbols, -1)
    while len(at):
        mine = place[at]
        before = order[mine - 1]
        x, y = at + shared, before + shared
        more = (mine > 0) & (shared < most) & (x < n) & (y < n)
        more &= padded[np.minimum(x, n)] == padded[np.minimum(y, n)]
        shared += more
        stop = np.flatnonzero(~more)
        if len(stop):
            first_of_all = mine[stop] <= 0
            there = mine[stop] >= 0
            out[mine[stop][there]] = np.where(first_of_all, 0, shared[stop])[there]
            carried = ~first_of_all & (place[before[stop] + 1] >= 0)
            shared[stop] = np.where(carried, np.maximum(shared[stop] - 1, 0), 0)
            at[stop] += 1
            left = (at < end) & (place[np.minimum(at, n)] >= 0)
            if not left.all():
                at, end, shared = at[left], end[left], shared[left]
    return out


def repeated_in(stretches: list[bytes], length: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each stretch, which of its strings occur again in the shard; and which are the first of their kind in order."""
    sizes = np.array([len(x) + 1 for x in stretches])
    ends = np.cumsum(sizes)
    symbols = np.append(np.frombuffer(b"\0".join(stretches), np.uint8), 0).astype(np.int64)
    # Each stretch ends with a symbol of its own, so no two suffixes are equal.
    symbols[ends - 1] = 256 + np.arange(len(stretches))
    # Strings start where ``length`` bytes are left; suffixes behind are ordered only as far as those need them.
    past = np.maximum(0, np.arange(len(symbols)) - np.repeat(ends - 1 - length, sizes))
    order = suffix_array(symbols, int(sizes.max()), past)
    shared = common_prefixes(symbols, order, length, first=ends - sizes) >= length
    again = np.zeros(len(symbols), bool)
    again[order[shared]] = True
    again[order[np.flatnonzero(shared) - 1]] = True
    leads = np.zeros(len(symbols), bool)
    leads[order[~shared]] = True
    strings = list(zip(ends - sizes, ends - length, strict=True))
    return [again[s:e] for s, e in strings], [leads[s:e] for s, e in strings]


def _read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, starts = text_bytes(batch.column("text"))
    return data, data, starts


def _cut(g: repeats.Groups, found: np.ndarray, data: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Cut groups into parts whose windows share a core: all but ``length // PARTS`` of their bytes.

    Equal windows hold their anchor at one place, so they get into parts with equal cores.
    """
    wide = max(1, length // PARTS)
    at, n, place = g.at[found], g.n[found], g.place[found]
    slices_of = place // wide - (place - n + 1) // wide + 1
    of = np.repeat(np.arange(len(found)), slices_of)
    step = np.arange(len(of)) - np.repeat(np.cumsum(slices_of) - slices_of, slices_of)
    at, n, place = at[of], n[of], place[of]
    j = place // wide - step
    low = np.maximum(0, place - (wide * (j + 1) - 1))
    high = np.minimum(n - 1, place - wide * j)
    sums = stretch_sums(data), stretch_sums(data, 1)
    core = at + place - wide * j
    anchor = stretch_hashes(sums[0], core, core + length - wide + 1, summed=True) + j.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    begin, end = at + low, at + high + length
    offset = (place - low).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    spans = [(stretch_hashes(sums[k], begin, end, k, summed=True) ^ offset).view(np.int64) for k in range(2)]
    return {
        "who": g.text[found][of], "lo": g.lo[found][of] + low, "n": high - low + 1, "anchor": anchor.view(np.int64) ^ g.anchor[found][of],
        "span1": spans[0], "span2": spans[1], "begin": begin, "end": end,
    }


def _open_stretches(rows: DataFrame, kind: repeats.Kind, groups: DataFrame) -> DataFrame:
    """Parts of the given groups, as groups of their own, with their bytes."""
    table = rows.sparkSession.sparkContext.broadcast(repeats.bit_table(groups))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=repeats.SLICE):
            data, _, first = _read(batch)
            g = repeats.groups_of(data, data, first, kind.window, kind.gram)
            k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
            found = np.flatnonzero(repeats.marked(table.value, k1[g.text], k2[g.text], g.lo)) if len(g.text) else g.text
            if not len(found):
                continue
            cut = _cut(g, found, data, kind.window)
            who = pa.array(cut["who"])
            columns = {c: batch.column(c).take(who) for c in ("doc_id", "k1", "k2")}
            columns |= {c: pa.array(cut[c], pa.int64()) for c in ("lo", "n", "anchor", "span1", "span2")}
            columns["bytes"] = pa.array([data[a:b].tobytes() for a, b in zip(cut["begin"], cut["end"], strict=True)], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return staged(rows.mapInArrow(run, f"doc_id {id_type}, k1 long, k2 long, lo long, n long, anchor long, span1 long, span2 long, bytes binary"))


def removals(rows: DataFrame, length: int = LENGTH, shard_stretches: int = SHARD_STRETCHES) -> DataFrame:
    """k1, k2, start and end (bytes) of what is to be removed; ``rows`` as ``repeats.sources`` gives them."""
    kind = repeats.Kind(length, max(1, length // 2), _read)
    groups = repeats.with_spans(repeats.repeated_groups(rows, kind))
    parts = _open_stretches(rows, kind, groups.filter(F.col("mixed") & repeats.is_first()))
    part_groups = staged(repeats.with_spans(repeats.repeated(parts.drop("bytes"))))
    whole = [x.filter("c > 1").select("k1", "k2", F.col("lo").alias("start"), (F.col("lo") + F.col("n") - 1 + length).alias("end")) for x in (groups, part_groups)]
    compared = part_groups.filter(F.col("mixed") & repeats.is_first()).select("k1", "k2", "lo")
    stretches = staged(parts.join(compared, ["k1", "k2", "lo"], "left_semi").select("k1", "k2", "lo", "anchor", "bytes"))
    shards = buckets_for(stretches.count(), shard_stretches // 2)
    sizes = stretches.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / shard_stretches).alias("parts"))
    dealt = (
        stretches.join(apart(sizes), "anchor")
        .withColumn("part", F.pmod(F.xxhash64("k1", "k2", "lo"), F.col("parts")))
        # A split anchor has shards of its own.
        .withColumn("shard", F.when(F.col("parts") > 1, F.xxhash64("anchor", "part")).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(shards))))
    )
    # Runs of strings that the shard knows to be repeated, without hashes; strings of split shards, with them.
    schema = "k1 long, k2 long, start long, end long, h1 long, h2 long, shard long"

    def sort(table: pa.Table) -> pa.Table:
        parts = [x.as_py() for x in table.column("bytes")]
        split = table.column("parts")[0].as_py() > 1
        shard = table.column("shard")[0].as_py()
        low = table.column("lo").to_numpy()
        who, start, end, hashes = [], [], [], ([], [])

        def add(k: int, starts: np.ndarray, ends: np.ndarray, *of: pa.Array) -> None:
            who.append(np.full(len(starts), k))
            start.append(low[k] + starts)
            end.append(low[k] + ends)
            for i in range(2):
                hashes[i].append(of[i] if of else pa.nulls(len(starts), pa.int64()))

        for k, (again, leads) in enumerate(zip(*repeated_in(parts, length), strict=True)):
            edges = np.flatnonzero(np.diff(np.concatenate([[0], again.view(np.int8), [0]])))
            add(k, edges[::2], edges[1::2] - 1 + length)
            if split:
                # Only the first of equal strings speaks for the shard.
                values, out = np.frombuffer(parts[k], np.uint8), np.flatnonzero(leads)
                add(k, out, out + length, *[pa.array(stretch_hashes(values, out, out + length, i).view(np.int64)) for i in range(2)])
        who = pa.array(np.concatenate(who))
        columns = {
            "k1": table.column("k1").take(who), "k2": table.column("k2").take(who),
            "start": pa.array(np.concatenate(start)), "end": pa.array(np.concatenate(end)),
            "h1": pa.concat_arrays(hashes[0]), "h2": pa.concat_arrays(hashes[1]), "shard": pa.array(np.full(len(who), shard)),
        }
        return pa.table(columns)

    # A shard is few bytes and much work, so tasks are dealt by number (eight shards each): by size, Spark would put many
    # into one.
    needed = dealt.select("k1", "k2", "lo", "bytes", "parts", "shard").repartition(max(8, shards // 8), "shard")
    sorted_ = staged(needed.groupBy("shard").applyInArrow(sort, schema))
    known = sorted_.filter("h1 is null").select("k1", "k2", "start", "end")
    spoken = sorted_.filter("h1 is not null")
    ranges = buckets_for(spoken.count(), 1 << 18, 1)

    def merge(table: pa.Table) -> pa.Table:
        """Look each shard's strings up in those of the shards before it, by binary search."""
        h1, h2, shard = (table.column(c).to_numpy() for c in ("h1", "h2", "shard"))
        hits = np.zeros(len(h1), bool)
        run = np.zeros(0, np.int64)
        for s in np.unique(shard):
            mine = np.flatnonzero(shard == s)
            if len(run):
                place = np.searchsorted(h1[run], h1[mine])
                # A few of one first hash at most; compare the second.
                for _ in range(8):
                    inside = place < len(run)
                    there = run[np.minimum(place, len(run) - 1)]
                    same = inside & (h1[there] == h1[mine])
                    equal = same & (h2[there] == h2[mine])
                    hits[mine[equal]] = hits[there[equal]] = True
                    place = np.where(same & ~equal, place + 1, place)
                    if not (same & ~equal).any():
                        break
            run = np.concatenate([run, mine])
            run = run[np.lexsort((h2[run], h1[run]))]
            run = run[np.append(True, (h1[run][1:] != h1[run][:-1]) | (h2[run][1:] != h2[run][:-1]))]
        return table.filter(pa.array(hits)).select(["h1", "h2"])

    between = (
        spoken.select("h1", "h2", "shard", F.pmod(F.col("h1"), F.lit(ranges)).alias("range"))
        .groupBy("range")
        .applyInArrow(merge, "h1 long, h2 long")
        .distinct()
    )
    crossed = spoken.join(apart(between), ["h1", "h2"]).select("k1", "k2", "start", "end")
    return whole[0].unionByName(whole[1]).unionByName(known).unionByName(crossed)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, shard_stretches: int = SHARD_STRETCHES) -> DataFrame:
    """doc_id, n_bytes, n_removed, removed (maximal runs of bytes) and kept (bytes) of every row."""
    rows = repeats.sources(docs, id_col, text_col)
    found = repeats.with_removals(rows, removals(rows, length, shard_stretches))
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, gone, lists, kept = [], [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                data = text.as_py().encode()
                runs = repeats.merged([(x["start"], x["end"]) for x in spans.as_py() or []])
                counts.append(len(data))
                gone.append(sum(e - s for s, e in runs))
                lists.append([{"start": s, "end": e} for s, e in runs])
                edges = [0, *(x for r in runs for x in r), len(data)]
                kept.append(b"".join(data[s:e] for s, e in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(lists, pa.list_(span)), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "removed", "kept"],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_removed long, removed array<struct<start:bigint,end:bigint>>, kept binary")


def digest(docs: DataFrame) -> DataFrame:
    return deduplicate(docs).select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def sha256_of(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
