"""Language identification, words first and character n-grams where a word is not known.

A known word is scored by its log frequency in each language. An unknown word falls back to its character
n-grams (with word ends marked), from long to short: the longest length of which the model knows at least
one decides, by the mean log frequency of the known ones. The scores of all words of a text are added up;
the best language wins (ties: the first in the alphabet), its posterior is the score.

The tables are fitted in one task on a bounded sample per language (``SAMPLE_PER_LANGUAGE`` documents and
``SAMPLE_BYTES`` bytes with the smallest hashes of id and text) of the rows given for training. Prediction reads every
whole text.

Defined results: null texts and texts without a letter get ``und`` and score 0, and so does every text if
there is nothing to learn from. Rows with a null language teach nothing, rows that are equal teach once, also with a
null id. Repeated rows get equal results,
null ids are kept, an empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.common import Words, gathered, letters, pick, slices

UNKNOWN = "und"
#: Documents and bytes of text per language that the tables are fitted on at most; a document may take one part in
#: LONGEST_SHARE of the bytes, longer ones aren't learned from.
SAMPLE_PER_LANGUAGE, SAMPLE_BYTES, LONGEST_SHARE = 800, 16 << 20, 16
#: Lengths of n-grams, from the first tried to the last.
GRAMS = (5, 4, 3, 2, 1)
SMOOTHING = 0.5
#: Bytes of text that are scored at once.
TOGETHER = 1 << 20

LETTERS = letters(str.isalpha)
#: Marks before and after a word.
BEFORE, AFTER = 2, 3


def gram_hashes(code: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the character n-grams of words with their ends marked, and the word of each; one letter has no marks."""
    marked, sizes = gathered(code, starts, ends, BEFORE, AFTER)
    values = marked.astype(np.uint64)
    sums = np.zeros(max(0, len(values) - n + 1), np.uint64)
    for k in range(n):
        sums = sums * np.uint64(0x9E3779B97F4A7C15) + values[k : k + len(sums)]
    word = np.repeat(np.arange(len(sizes)), sizes)[: len(sums)]
    last = (np.cumsum(sizes) - n)[word] if len(sums) else word
    at = np.arange(len(sums))
    fits = (at <= last) if n > 1 else (marked != BEFORE) & (marked != AFTER)
    return sums[fits], word[fits]


def lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted number in sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


class Tables:
    """Names of the languages; per kind of unit (0: words, n: n-grams) sorted hashes and log frequencies."""

    def __init__(self, languages: list[str], keys: dict[int, np.ndarray], logs: dict[int, np.ndarray]):
        self.languages, self.keys, self.logs = languages, keys, logs

    @classmethod
    def fit(cls, rows: list[tuple[str, str]]) -> Tables:
        languages = sorted({lang for lang, _ in rows})
        found: dict[int, list[list]] = {n: [[] for _ in languages] for n in (0, *GRAMS)}
        for k, lang in enumerate(languages):
            texts = [text.lower() for name, text in rows if name == lang]
            for i in range(0, len(texts), 200):
                words = Words(texts[i : i + 200], LETTERS)
                hashes, first, times = np.unique(words.hashes(), return_index=True, return_counts=True)
                found[0][k].append((hashes, times))
                for n in GRAMS:
                    units, word = gram_hashes(words.code, words.starts[first], words.ends[first], n)
                    found[n][k].append(_added(units, times[word]))
        keys, logs = {}, {}
        for n, of in found.items():
            each = [_added(*(np.concatenate(x) for x in zip(*parts, strict=True))) for parts in of]
            keys[n] = np.unique(np.concatenate([h for h, _ in each])) if each else np.zeros(0, np.uint64)
            table = np.zeros((len(keys[n]), max(1, len(languages))))
            for k, (h, times) in enumerate(each):
                table[np.searchsorted(keys[n], h), k] = times
            table = np.log((table + SMOOTHING) / (table.sum(0) + SMOOTHING * max(1, len(table))))
            # What is common to all languages says nothing and would only cost precision.
            logs[n] = (table - table.mean(1, keepdims=True)).astype(np.float32)
        return cls(languages, keys, logs)

    def of_words(self, code: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Scores of words per language: by the word, or else by the longest n-grams that are known."""
        at = lookup(self.keys[0], hashes)
        out = np.zeros((len(hashes), len(self.languages)), np.float32)
        out[at >= 0] = self.logs[0][at[at >= 0]]
        left = np.flatnonzero(at < 0)
        for n in GRAMS:
            if not len(left):
                break
            units, word = gram_hashes(code, starts[left], ends[left], n)
            at = lookup(self.keys[n], units)
            word, at = word[at >= 0], at[at >= 0]
            known = np.bincount(word, minlength=len(left))
            sums = np.stack([np.bincount(word, self.logs[n][at, k], len(left)) for k in range(out.shape[1])], 1)
            out[left[known > 0]] = sums[known > 0] / known[known > 0, None]
            left = left[known == 0]
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        words = Words([text.lower() if text else "" for text in texts], LETTERS)
        sizes = np.diff(words.first)
        if not self.languages or not sizes.any():
            return names, scores
        hashes, first, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
        rows = self.of_words(words.code, words.starts[first], words.ends[first], hashes)
        full = np.flatnonzero(sizes)
        sums = np.add.reduceat(rows[number], words.first[full], axis=0, dtype=np.float64)
        best = sums.argmax(1)
        posterior = 1 / np.exp(sums - sums.max(1, keepdims=True)).sum(1)
        for k, b, p in zip(full, best, posterior, strict=True):
            names[k], scores[k] = self.languages[b], float(p)
        return names, scores


def _added(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, number = np.unique(keys, return_inverse=True)
    return found, np.bincount(number, times, len(found)) if len(found) else np.zeros(0)


def sampled(rows: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """Columns lang and text: of each language the rows with the smallest hashes of id and text, each such row once.

    Rows are counted first; those below the hash that four times as many are expected under are looked at, so that only
    a bounded number is ranked, however large a language or however often a row is there.
    """
    usable = rows.filter(F.col("lang").isNotNull() & (F.octet_length("text") <= most_bytes // LONGEST_SHARE))
    # Halves of the range of the hash are easier to compare as a number from 0 to 1.
    place = (F.xxhash64("doc_id", "text") / F.lit(2.0**64) + 0.5).alias("place")
    enough = usable.groupBy("lang").agg((F.lit(4.0 * per_language) / F.count(F.lit(1))).alias("enough"))
    # One row per language.
    near = usable.select("lang", "text", place).join(F.broadcast(enough), "lang").filter("place <= enough")
    once = near.groupBy("lang", "place").agg(F.min("text").alias("text"))
    order = Window.partitionBy("lang").orderBy("place")
    ranked = once.withColumns({"rank": F.row_number().over(order), "until": F.sum(F.octet_length("text")).over(order)})
    return ranked.filter((F.col("rank") <= per_language) & (F.col("until") <= most_bytes)).select("lang", "text")


def learn(rows: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, most_bytes: int = SAMPLE_BYTES) -> Tables:
    """Fit on columns doc_id, text, lang: so many documents and bytes of each language at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Tables.fit(sorted((r["lang"], r["text"]) for batch in batches for r in batch.to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((found.languages, found.keys, found.logs))], pa.binary())], ["tables"])

    # The sample is bounded, so one task fits the tables; the driver holds nothing but them.
    fitted = sampled(rows, per_language, most_bytes).repartition(1).mapInArrow(run, "tables binary").collect()
    return Tables(*pickle.loads(bytes(fitted[0][0]))) if fitted else Tables.fit([])


def predict(docs: DataFrame, tables: Tables, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, lang_pred and score, one row per row."""
    source = pick(docs, doc_id=id_col, text=text_col)
    shared = docs.sparkSession.sparkContext.broadcast((tables.languages, tables.keys, tables.logs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Tables(*shared.value)
        for batch in slices(batches, limit=TOGETHER):
            names, scores = known.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls in the fold that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, fold: int = 2) -> DataFrame:
    """Learn from all folds but one, and predict every row."""
    rows = pick(docs, doc_id=id_col, text=text_col, lang=lang_col)
    tables = learn(rows.filter(~held_out(F.col("doc_id"), folds, fold)))
    return predict(docs, tables, id_col, text_col).select(
        "doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "lang_pred", "score"
    )
