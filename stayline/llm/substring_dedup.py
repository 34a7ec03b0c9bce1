"""Substring dedup by words: Rabin-Karp hashes of all 50-word windows, counted in Spark.

Words stand between white space and are compared unchanged. A word is removed if a window that covers it
has the same words as a window that starts in a document with a smaller id; windows are judged on the
input. Neighbouring windows are counted together where that is exact (see ``repeats``), else one by one.
Repeated windows merge into maximal removal intervals.

Defined results: null texts have no words; a text without words keeps the empty string. A null id is larger
than any other, rows with one id don't remove from each other. An empty table gives an empty result. Texts
of any length are read whole. Other columns are not looked at. Windows are equal if two 64-bit hashes are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm import repeats
from stayline.llm.common import NOT_SPACE, Words, apart, slices, staged, stretch_hashes

WINDOW, GRAM = 50, 25


def _read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words = Words(batch.column("text").to_pylist(), NOT_SPACE)
    return words.hashes(0), words.hashes(1), words.first


def kind_of(window: int) -> repeats.Kind:
    return repeats.Kind(window, max(1, window // 2), _read)


def removals(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """k1, k2, start and end (words) of what is to be removed; ``rows`` as ``repeats.sources`` gives them."""
    kind = kind_of(window)
    groups = repeats.with_spans(repeats.repeated_groups(rows, kind))
    groups = groups.withColumn("later", ~F.col("doc_id").eqNullSafe(F.col("first.id")))
    whole = groups.filter("later").select("k1", "k2", F.col("lo").alias("start"), (F.col("lo") + F.col("n") - 1 + window).alias("end"))
    table = rows.sparkSession.sparkContext.broadcast(repeats.bit_table(groups.filter("mixed and not later")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=1 << 20):
            one, two, first = _read(batch)
            g = repeats.groups_of(one, two, first, kind.window, kind.gram)
            k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
            open_ = np.flatnonzero(repeats.marked(table.value, k1[g.text], k2[g.text], g.lo)) if len(g.text) else g.text
            if not len(open_):
                continue
            n = g.n[open_]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at, lo, text = (np.repeat(x[open_], n) for x in (g.at, g.lo, g.text))
            at = at + step
            hashes = [stretch_hashes(x, at, at + window, k).view(np.int64) for k, x in enumerate((one, two))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(text)), pa.array(k1[text]), pa.array(k2[text]), pa.array(lo + step), *map(pa.array, hashes)],
                ["doc_id", "k1", "k2", "start", "h1", "h2"],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    windows = staged(rows.mapInArrow(run, f"doc_id {id_type}, k1 long, k2 long, start long, h1 long, h2 long"))
    firsts = windows.groupBy("h1", "h2").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), F.col("doc_id").alias("id"))).alias("first"))
    late = windows.join(apart(firsts), ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("first.id")))
    return whole.unionByName(late.select("k1", "k2", "start", (F.col("start") + window).alias("end")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, removed (maximal intervals of words) and kept (text) of every row."""
    rows = repeats.sources(docs, id_col, text_col)
    found = repeats.with_removals(rows, removals(rows, window))
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, gone, lists, kept = [], [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                words = text.as_py().translate(TO_SPACE).split(" ")
                words = [w for w in words if w]
                runs = repeats.merged([(x["start"], x["end"]) for x in spans.as_py() or []])
                counts.append(len(words))
                gone.append(sum(e - s for s, e in runs))
                lists.append([{"start": s, "end": e} for s, e in runs])
                for s, e in reversed(runs):
                    del words[s:e]
                kept.append(" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(lists, pa.list_(span)), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "removed", "kept"],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(run, f"doc_id {id_type}, n_words long, n_removed long, removed array<struct<start:bigint,end:bigint>>, kept string")


# Fixed value: white space, as a table for str.translate.
TO_SPACE = {c: " " for c in range(0x09, 0x0E)}


def digest(docs: DataFrame) -> DataFrame:
    return deduplicate(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def sha256_of(words: list[str]) -> str:
    return hashlib.sha256(" ".join(words).encode()).hexdigest()
