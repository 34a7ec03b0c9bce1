"""Periodic runs of words in documents, found by seeds and extension along diagonals.

A run is a stretch of words with smallest period q (words q apart are the same) that is at least ``LEAST`` words
and ``TIMES`` periods long and that no neighbouring word extends. Words stand between white space.

1. Grams of k words are indexed. A run of period q matches itself, q words on, over at least (TIMES - 1) * q words,
   so its first gram of that length is guaranteed to occur again q words on. One length k serves the periods from
   k / 3 (k = 5: from 1) to k + 1: up to there that gram cannot occur any sooner (otherwise both distances were
   periods of a stretch long enough for their common divisor to be one, and the run had a smaller period). Lengths
   go up in steps of three until a quarter of the text is covered.
2. Each gram gives the pair of its place and its next place in the same document: as many pairs as words at most,
   also where one word fills a text. The distance is the diagonal, or lag.
3. Pairs are extended word by word to both sides, in the order of their places. A table says for each lag how far
   it was covered, so the other pairs of a run are not extended again.

Grams are numbered exactly (ranks of pairs of shorter grams, no hashes), and only grams that occur twice go on to the
next length, so a text without repetition is done after the first one. All this concerns single documents: there is
no shuffle, and a document is in the memory of one task, whatever its length.

Defined results: null and empty texts have no words and no runs. A null id is kept. Rows that are there twice are
reported twice. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stayline.llm.common import pick, slices

#: Least words, and least periods, of a run. The lengths of grams rest on four periods.
LEAST, TIMES = 6, 4
#: Text bytes whose grams are indexed together.
TOGETHER = 1 << 20
#: Matching words that an extension looks at first; twice as many each time.
STRIDE = 32


def numbers(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word of each text, the same for the same word of one text only; and where texts start."""
    parts, first, used = [], [0], 0
    for words in texts:
        table = {w: used + k for k, w in enumerate(dict.fromkeys(words))}
        parts.append(np.fromiter(map(table.__getitem__, words), np.int64, len(words)))
        first.append(first[-1] + len(words))
        used += len(table)
    return np.concatenate([np.zeros(0, np.int64), *parts]), np.array(first)


def lengths(words: int) -> Iterator[tuple[int, int, int]]:
    """Gram lengths with the periods that each serves, until all runs in so many words are covered."""
    size, low = LEAST - 1, 1
    while low * TIMES <= words:
        yield size, low, size + 1
        low = size + 2
        size = (TIMES - 1) * low


def again(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places whose key occurs again or before: places in order, the number of their key, and the distance to its next place (or 0)."""
    if not len(keys):
        return at, at, at
    order = np.argsort(keys, kind="stable")
    keys, at = keys[order], at[order]
    same = keys[1:] == keys[:-1]
    next_ = np.append(same, False)
    many = next_ | np.append(False, same)
    number = np.cumsum(np.append(True, ~same))[many]
    gap = np.where(next_, np.append(at[1:], 0) - at, 0)[many]
    at = at[many]
    back = np.argsort(at, kind="stable")
    return at[back], number[back], gap[back]


class Index:
    """Grams that occur twice: places, number per place (0: occurs once) and distance to the next place."""

    def __init__(self, word: np.ndarray):
        self.size = 1
        self.of = word + 1
        self._keep(*again(word, np.arange(len(word))))

    def _keep(self, at: np.ndarray, number: np.ndarray, gap: np.ndarray) -> None:
        self.at, self.gap = at, gap
        self.of = np.zeros(len(self.of), np.int64)
        self.of[at] = number

    def grow(self, size: int) -> None:
        """Grams of another length, twice the present one at most."""
        at = self.at[self.at + size <= len(self.of)]
        tail = self.of[at + size - self.size]
        at, tail = at[tail > 0], tail[tail > 0]
        self._keep(*again(self.of[at] * np.int64(len(self.of) + 1) + tail, at))
        self.size = size


def same_ahead(word: np.ndarray, i: int, j: int, end: int) -> int:
    """How many words from i and from j on are the same, j + that at most ``end``."""
    n, step = 0, STRIDE
    while j + n < end:
        step = min(step, end - j - n)
        differ = word[i + n : i + n + step] != word[j + n : j + n + step]
        k = int(differ.argmax())
        if differ[k]:
            return n + k
        n, step = n + step, 2 * step
    return n


def same_behind(word: np.ndarray, i: int, j: int, begin: int) -> int:
    """How many words before i and before j are the same, i - that at least ``begin``."""
    n, step = 0, STRIDE
    while i - n > begin:
        step = min(step, i - n - begin)
        differ = (word[i - n - step : i - n] != word[j - n - step : j - n])[::-1]
        k = int(differ.argmax())
        if differ[k]:
            return n + k
        n, step = n + step, 2 * step
    return n


def runs_of(texts: list[list[bytes]], least: int = LEAST, times: int = TIMES) -> list[list[tuple[int, int, int]]]:
    """For each text its runs (start, length, period), by start and period."""
    if times < TIMES or least < LEAST:
        raise ValueError(f"gram lengths are for runs of {TIMES} periods and {LEAST} words at least")
    word, first = numbers(texts)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    longest = int(np.diff(first).max(initial=0))
    index = Index(word)
    for size, low, high in lengths(longest):
        while index.size < size and len(index.at):
            index.grow(min(size, 2 * index.size))
        if not len(index.at):
            break
        mine = (index.gap >= low) & (index.gap <= high)
        at, lag = index.at[mine], index.gap[mine]
        # Neighbours on one diagonal are one seed.
        head = np.append(True, (at[1:] != at[:-1] + 1) | (lag[1:] != lag[:-1]))[: len(at)]
        covered: dict[int, int] = {}
        owner = np.searchsorted(first, at[head], "right") - 1
        for i, q, text in zip(at[head].tolist(), lag[head].tolist(), owner.tolist(), strict=True):
            if i < covered.get(q, 0):
                continue
            begin, end = int(first[text]), int(first[text + 1])
            start = i - same_behind(word, i, i + q, begin)
            stop = i + q + same_ahead(word, i, i + q, end)
            covered[q] = stop - q
            if stop - start >= max(least, times * q):
                found[text].append((start - begin, stop - start, q))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[k] for k in np.flatnonzero(kept)]


#: Changes the words of a row before runs are looked for; gets the id and the words.
Change = Callable[[object, list[bytes]], list[bytes]]


def read(batches: Iterator[pa.RecordBatch], change: Change | None = None):
    """Batches with the words and the runs of each of their rows."""
    for batch in slices(batches, limit=TOGETHER):
        texts = [(t or b"").split() for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
        if change:
            texts = [change(k, words) for k, words in zip(batch.column("doc_id").to_pylist(), texts, strict=True)]
        yield batch, texts, runs_of(texts)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length, period, by start and period) and collapsed: the text with each run's first period only."""
    source = pick(docs, doc_id=id_col, text=text_col)
    run = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts, runs in read(batches):
            lists = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in runs]
            left = [b" ".join(collapsed(w, rs)).decode("utf-8", "replace") for w, rs in zip(texts, runs, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array(lists, pa.list_(run)), pa.array(left, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(scan, f"doc_id {id_type}, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", change: Change | None = None) -> DataFrame:
    """One row per row: the number of runs, the longest one (ties: smallest start, then period), and checksums of all runs and of the collapsed text."""
    source = pick(docs, doc_id=id_col, text=text_col)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts, runs in read(batches, change):
            rows = []
            for words, rs in zip(texts, runs, strict=True):
                best = max(rs, key=lambda r: (r[1], -r[0], -r[2])) if rs else (None, None, None)
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in rs)
                left = b" ".join(collapsed(words, rs))
                rows.append((len(rs), *best, 1000 * best[1] // best[2] if rs else None, *(hashlib.sha256(x).hexdigest() for x in (listed.encode(), left))))
            columns = [pa.array(c, pa.string() if k > 4 else pa.int64()) for k, c in enumerate(zip(*rows, strict=True))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
            )

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        scan, f"doc_id {id_type}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    )
