"""Which tokens of two tokenizers cover the same text, by interval coalescing, and how often two ids meet.

Both tokenizers encode a document; each token is an interval of bytes. The tokens of both, sorted by start, fall into
groups: a group ends where the next start reaches the furthest end so far (``maximum.accumulate``). Within a group every
token of A is linked with every token of B. The count of a pair of ids is the number of documents that hold it linked.

1. Tasks encode whole texts and coalesce the intervals of many documents at once. Per document they keep the figures and
   its distinct pairs of ids, as places in the list of pairs of its block (documents of one task, up to ``BLOCK_PAIRS``
   pairs together), and per block the list with the number of its documents for each pair.
2. Counts of pairs are sums over blocks: one row per block and pair, not per link. The highest count of an A id is a
   maximum over those sums; there are no more such rows than A has ids.
3. Counts go back to the blocks that hold the pair and meet their documents there (a co-group per block), so no table
   that grows with the corpus is sent to all tasks.

A pair that every document holds is one row per block. In a group that is misaligned over thousands of tokens, distinct
ids are linked with their numbers of occurrences instead of one link after the other.

The text is encoded with a space before it, which B adds itself. Strings of special tokens in it are plain text.

Defined results: texts that are null or empty, or whose token bytes of A or B don't give back the space and the text
(for instance where B writes U+2581 as a space), have no tokens: figures are 0, the groups an empty string. Rows
that are there twice are two documents; null ids are kept. An empty table gives an empty result. Texts of any length are
encoded whole. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import apart, pick, slices, staged
from stayline.llm.packing import Encoder

#: Distinct pairs of documents (summed over them) that make a block.
BLOCK_PAIRS = 1 << 21
#: Text bytes that are encoded and coalesced together.
TOGETHER = 1 << 20
#: Links of a group above which its distinct ids are linked.
WIDE = 1 << 12
#: Links of small groups that are listed at once.
LISTED = 1 << 22


class Side:
    """A tokenizer and the bytes of its tokens. ``encode`` gives the ids of many texts one after the other, and how many of each."""

    def __init__(self, of_tokens: list[bytes]):
        self.sizes = np.fromiter(map(len, of_tokens), np.int64, len(of_tokens))
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(of_tokens), np.uint8)

    def __len__(self) -> int:
        return len(self.sizes)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = self.lists(texts)
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(counts.sum())), counts

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of tokens one after the other."""
        sizes = self.sizes[ids]
        until = np.cumsum(sizes)
        return self.flat[np.repeat(self.begins[ids] - until + sizes, sizes) + np.arange(until[-1] if len(ids) else 0)]


class Left(Side):
    """Tokenizer A, byte-level; a space comes before each text."""

    def __init__(self, model: str):
        self.encoder = Encoder(model)
        self.encoder.tokenizer.encode_special_tokens = True
        known = json.loads(model)["model"]["vocab"]
        # Byte-level vocabularies write the printable bytes as themselves, the others from code point 256 on.
        same = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in same} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(same))}
        of_tokens = [b""] * (max(known.values()) + 1)
        for token, i in known.items():
            of_tokens[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        super().__init__(of_tokens)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not self.encoder.quick:
            return super().encode(texts)
        parts = [self.encoder.quick.encode_to_numpy(" " + t, disallowed_special=()) for t in texts]
        return np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int64), np.fromiter(map(len, parts), np.int64, len(parts))

    def lists(self, texts: list[str]) -> list[list[int]]:
        return self.encoder.slow([" " + t for t in texts])


class Right(Side):
    """Tokenizer B, pieces with byte fallback; it writes a space before each text itself."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        super().__init__([self._bytes(i) for i in range(self.pieces.vocab_size())])

    def _bytes(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode()

    def lists(self, texts: list[str]) -> list[list[int]]:
        return self.pieces.encode(texts, num_threads=1)


@dataclass
class Aligned:
    """Tokens of many documents: ids, the group of each token, where documents begin (tokens of A, tokens of B, groups)."""

    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    first_group: np.ndarray


def coalesced(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The group of each interval; ``start`` is sorted."""
    if not len(start):
        return np.zeros(0, np.int64)
    reach = np.maximum.accumulate(end)
    return np.cumsum(np.append(True, start[1:] >= reach[:-1])) - 1


def aligned(texts: list[str], left: Left, right: Right) -> Aligned:
    """Documents one after the other; those without tokens have empty stretches."""
    data = [b" " + t.encode() if t else b"" for t in texts]
    good = np.fromiter(map(bool, texts), bool, len(texts))
    found = []
    for side in (left, right):
        ids, counts = side.encode(texts)
        joined, size = side.joined(ids), np.append(0, np.cumsum(side.sizes[ids]))
        at = size[np.append(0, np.cumsum(counts))]
        good &= [joined[s:e].tobytes() == d for s, e, d in zip(at[:-1].tolist(), at[1:].tolist(), data, strict=True)]
        found.append((side, ids, counts))
    sides, first, starts, ends = [], [], [], []
    for side, ids, counts in found:
        sides.append(ids[np.repeat(good, counts)])
        first.append(np.append(0, np.cumsum(counts * good)))
        sizes = side.sizes[sides[-1]]
        ends.append(np.cumsum(sizes))
        starts.append(ends[-1] - sizes)
    # Documents have the same bytes on both sides, so the places of both run on together.
    start, end = np.concatenate(starts), np.concatenate(ends)
    order = np.lexsort((np.repeat([0, 1], [len(s) for s in sides]), start))
    group = np.empty(len(order), np.int64)
    group[order] = coalesced(start[order], end[order])
    n = len(sides[0])
    group_a, group_b = group[:n], group[n:]
    last = group_a[-1] + 1 if n else 0
    first_group = np.append(group_a, last)[first[0]]
    return Aligned(*sides, group_a, group_b, *first, first_group)


class Writer:
    """Writes groups as ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, ids: int):
        self.width = len(str(ids - 1))
        self.digits = np.frombuffer("".join(str(k).rjust(self.width, "\0") for k in range(ids)).encode(), np.uint8).reshape(ids, self.width)

    def texts(self, of: Aligned) -> list[bytes]:
        n, m = len(of.a), len(of.b)
        groups = int(of.first_group[-1])
        until_a, until_b = np.cumsum(np.bincount(of.group_a, minlength=groups)), np.cumsum(np.bincount(of.group_b, minlength=groups))
        place_a = np.arange(n) + np.append(0, until_b)[of.group_a]
        place_b = np.arange(m) + until_a[of.group_b]
        rows = np.empty((n + m, self.width + 1), np.uint8)
        rows[place_a, : self.width], rows[place_b, : self.width] = self.digits[of.a], self.digits[of.b]
        rows[:, self.width] = ord(",")
        ends = until_a + until_b
        rows[ends - 1, self.width] = ord(";")
        rows[until_a + np.append(0, until_b)[:-1] - 1, self.width] = ord("|")
        # No mark behind the last group of a document.
        tokens = of.first_a + of.first_b
        closing = tokens[1:][tokens[1:] > tokens[:-1]] - 1
        rows[closing, self.width] = 0
        there = rows != 0
        flat = rows[there].tobytes()
        at = np.append(0, np.cumsum(there.sum(1)))[tokens]
        return [flat[s:e] for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def links(of: Aligned, right_ids: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links per document; and distinct pairs of documents: document, pair (a * right_ids + b) and how often, by document and pair."""
    groups = int(of.first_group[-1])
    docs = len(of.first_group) - 1
    many_a, many_b = np.bincount(of.group_a, minlength=groups), np.bincount(of.group_b, minlength=groups)
    first_a, first_b = np.cumsum(many_a) - many_a, np.cumsum(many_b) - many_b
    doc = np.repeat(np.arange(docs), np.diff(of.first_group))
    each = many_a * many_b
    total = np.zeros(docs, np.int64)
    np.add.at(total, doc, each)
    span = np.int64(right_ids) * (int(of.a.max(initial=0)) + 1)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    # Small groups: all links of a token of A, chunk by chunk.
    times = np.where(each <= WIDE, many_b, 0)[of.group_a]
    until = np.cumsum(times)
    begin = 0
    while begin < len(of.a):
        end = max(begin + 1, int(np.searchsorted(until, (until[begin - 1] if begin else 0) + LISTED, "right")))
        n, group = times[begin:end], of.group_a[begin:end]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        other = of.b[np.repeat(first_b[group], n) + step]
        keys = np.repeat(doc[group] * span + of.a[begin:end] * np.int64(right_ids), n) + other
        found.append(np.unique(keys, return_counts=True))
        begin = end
    for g in np.flatnonzero(each > WIDE):
        a, n_a = np.unique(of.a[first_a[g] : first_a[g] + many_a[g]], return_counts=True)
        b, n_b = np.unique(of.b[first_b[g] : first_b[g] + many_b[g]], return_counts=True)
        found.append(((doc[g] * span + a[:, None] * np.int64(right_ids) + b).ravel(), (n_a[:, None] * n_b).ravel()))
    if len(found) == 2:
        keys, often = found[1]
    else:
        keys, back = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
        often = np.zeros(len(keys), np.int64)
        np.add.at(often, back, np.concatenate([t for _, t in found]))
    return total, keys // span, keys % span, often


FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def alignments(docs: DataFrame, model_a: str, model_b: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links and groups (``a1,a2|b1;a3|b2,b3``: ids in order) of every row."""
    source = pick(docs, doc_id=id_col, text=text_col)
    sent = source.sparkSession.sparkContext.broadcast((model_a, model_b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = Left(sent.value[0]), Right(sent.value[1])
        writer = Writer(max(len(left), len(right)))
        for batch in slices(batches, limit=TOGETHER):
            of = aligned([t or "" for t in batch.column("text").to_pylist()], left, right)
            figures = (*(np.diff(x) for x in (of.first_a, of.first_b, of.first_group)), links(of, len(right))[0])
            columns = [batch.column("doc_id"), *map(pa.array, figures), pa.array([t.decode() for t in writer.texts(of)], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *FIGURES, "groups"])

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, {', '.join(f'{c} long' for c in FIGURES)}, groups string")


def blocks(docs: DataFrame, model_a: str, model_b: bytes, id_col: str = "doc_id", text_col: str = "text", block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Rows of documents and rows of blocks, written to the shared folder.

    Documents: block, doc_id, the figures, groups_sha256, links (binary, places in the block's list) and often (binary).
    Blocks: block, pairs (binary, a * ids of B + b, ascending) and held (binary, documents of the block).
    """
    source = pick(docs, doc_id=id_col, text=text_col)
    sent = source.sparkSession.sparkContext.broadcast((model_a, model_b))
    id_type = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = Left(sent.value[0]), Right(sent.value[1])
        writer = Writer(max(len(left), len(right)))
        block, parts, held = TaskContext.get().partitionId() << 32, [], 0
        for batch in slices(batches, limit=TOGETHER):
            of = aligned([t or "" for t in batch.column("text").to_pylist()], left, right)
            total, doc, pair, often = links(of, len(right))
            figures = (*(np.diff(x) for x in (of.first_a, of.first_b, of.first_group)), total)
            shas = [hashlib.sha256(t).hexdigest() if t else "" for t in writer.texts(of)]
            parts.append((batch.column("doc_id"), figures, shas, np.searchsorted(doc, np.arange(len(total) + 1)), pair, often))
            held += len(pair)
            if held >= block_pairs:
                yield from block_rows(block, parts)
                block, parts, held = block + 1, [], 0
        if parts:
            yield from block_rows(block, parts)

    def block_rows(block: int, parts: list) -> Iterator[pa.RecordBatch]:
        known, counts = np.unique(np.concatenate([p[4] for p in parts]), return_counts=True)
        for ids, figures, shas, first, pair, often in parts:
            place = np.searchsorted(known, pair).astype("<i4")
            cut = list(zip(first[:-1].tolist(), first[1:].tolist(), strict=True))
            columns = {"block": pa.array(np.full(len(ids), block)), "doc_id": ids, **dict(zip(FIGURES, map(pa.array, figures), strict=True))}
            columns |= {"groups_sha256": pa.array(shas), "links": pa.array([place[s:e].tobytes() for s, e in cut], pa.binary())}
            columns |= {"often": pa.array([often[s:e].astype("<i8").tobytes() for s, e in cut], pa.binary())}
            yield rows_of(columns, len(ids), ids.type)
        yield rows_of({"block": pa.array([block]), "pairs": pa.array([known.tobytes()], pa.binary()), "held": pa.array([counts.astype("<i8").tobytes()], pa.binary())}, 1, ids.type)

    kinds = {"block": pa.int64(), "doc_id": pa.null(), **dict.fromkeys(FIGURES, pa.int64()), "groups_sha256": pa.string()}
    kinds |= dict.fromkeys(("links", "often", "pairs", "held"), pa.binary())

    def rows_of(columns: dict[str, pa.Array], n: int, id_kind: pa.DataType) -> pa.RecordBatch:
        of = kinds | {"doc_id": id_kind}
        return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, kind)) for c, kind in of.items()], list(of))

    figures = ", ".join(f"{c} long" for c in FIGURES)
    return staged(source.mapInArrow(run, f"block long, doc_id {id_type}, {figures}, groups_sha256 string, links binary, often binary, pairs binary, held binary"))


def block_pairs_of(written: DataFrame) -> DataFrame:
    """One row per block and pair: block, place, pair, held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, held in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "held")), strict=True):
                pairs = np.frombuffer(pairs, "<i8")
                columns = [np.full(len(pairs), block), np.arange(len(pairs), dtype=np.int32), pairs, np.frombuffer(held, "<i8")]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["block", "place", "pair", "held"])

    lists = written.filter("pairs is not null").select("block", "pairs", "held")
    return lists.mapInArrow(run, "block long, place int, pair long, held long")


def pair_counts(written: DataFrame, right_ids: int) -> DataFrame:
    """a_id, b_id, documents (that hold the pair linked) and best: whether no pair of the A id is in more."""
    sums = block_pairs_of(written).groupBy("pair").agg(F.sum("held").alias("documents"))
    sums = staged(sums.withColumn("a_id", F.expr(f"cast(pair div {right_ids} as int)")))
    # One row per id of A.
    highest = sums.groupBy("a_id").agg(F.max("documents").alias("highest"))
    return sums.join(highest, "a_id").select("a_id", F.expr(f"cast(pair % {right_ids} as int)").alias("b_id"), "pair", "documents", (F.col("documents") == F.col("highest")).alias("best"))


def link_figures(docs: DataFrame, model_a: str, model_b: bytes, id_col: str = "doc_id", text_col: str = "text", block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """One row per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    n_best: links whose count is the highest of their A id; count_sum: counts added up over links.
    """
    written = blocks(docs, model_a, model_b, id_col, text_col, block_pairs)
    counts = pair_counts(written, len(Right(model_b))).select("pair", "documents", "best")
    back = block_pairs_of(written).select("block", "place", "pair").join(apart(counts), "pair").select("block", "place", "documents", "best")
    rows = written.filter("pairs is null").select("block", "doc_id", *FIGURES, "groups_sha256", "links", "often")

    def score(documents: pa.Table, pairs: pa.Table) -> pa.Table:
        count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        place = pairs.column("place").to_numpy()
        count[place], best[place] = pairs.column("documents").to_numpy(), pairs.column("best").to_numpy()
        n_best, count_sum = [], []
        for links_, often in zip(documents.column("links").to_pylist(), documents.column("often").to_pylist(), strict=True):
            at, times = np.frombuffer(links_, "<i4"), np.frombuffer(often, "<i8")
            n_best.append(int(times @ best[at]))
            count_sum.append(int(times @ count[at]))
        kept = documents.select(["doc_id", *FIGURES])
        return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64())).append_column("groups_sha256", documents.column("groups_sha256"))

    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, {', '.join(f'{c} long' for c in (*FIGURES, 'n_best', 'count_sum'))}, groups_sha256 string"
    return rows.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(score, schema)


def models(path_a: str | None = None, path_b: str | None = None) -> tuple[str, bytes]:
    """The definitions of both tokenizers; read by the driver and sent along, so executors need no file."""
    from pathlib import Path

    import public_tokenizers

    return Path(path_a or public_tokenizers.path("byte_bpe_50k.json")).read_text(), Path(path_b or public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
