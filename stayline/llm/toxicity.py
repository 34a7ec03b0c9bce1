"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

Each word enters as a word vector joined with the mean of the vectors of its character trigrams; words
that aren't in the vocabulary have their trigrams only. A text is cut into overlapping windows of
``WINDOW`` words, half of that apart, that cover all of it, so a passage of up to ``STRIDE`` words is whole in one. The network reads a window in both directions,
attention pools the states, and the score of a text is that of its worst window. Training looks for the
worst window of each text in every pass and learns from that one (multiple-instance learning), as a label
only says that a text is toxic somewhere.

It is fitted on a bounded sample of labelled rows: ``SAMPLE_TOXIC`` toxic and ``SAMPLE_CLEAN`` clean ones
with the smallest hashes of their ids. The same sample gives the same weights.

Defined results: null and empty texts, and texts without a word, are scored as one empty window. Without a
labelled row of either kind every score is the share of toxic rows in the sample (0 if there is none).
Equal texts get equal scores, null ids are kept (held out: no), an empty table gives an empty result. An id teaches
once for each label that it has, however often it is labelled or stored (of its texts, that with the smallest hash);
null labels teach nothing. Other columns are not looked at.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import Words, gathered, letters, numbered, pick, place, slices
from stayline.llm.language_id import held_out, lookup

WINDOW, STRIDE = 32, 16
#: Labelled rows that the network is fitted on at most.
SAMPLE_TOXIC, SAMPLE_CLEAN = 1200, 2400
EPOCHS, BATCH, RATE = 5, 48, 0.01
#: Steps that training takes at least, by more passes over a small sample.
STEPS = 400
#: Vocabulary, trigram table, sizes of the word vector, of the trigram vector and of a state.
VOCABULARY, TRIGRAM_BITS, WORD_SIZE, CHAR_SIZE, STATE = 12_000, 13, 8, 8, 8
#: Score from which a text counts as toxic.
THRESHOLD = 0.7

LETTERS = letters(str.isalnum)
BEFORE, AFTER = 2, 3


def trigrams(code: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of words, ends marked, one word after the other, and how many each has (one at least)."""
    marked, sizes = gathered(code, starts, ends, BEFORE, AFTER)
    mix = marked[:-2] * np.uint32(2654435761) + marked[1:-1] * np.uint32(2246822519) + marked[2:] * np.uint32(3266489917)
    mix = (mix ^ (mix >> np.uint32(15))) * np.uint32(668265263)
    # Those that reach over the end of a word are left out.
    inside = np.ones(len(marked), bool)
    after = np.cumsum(sizes)
    inside[after - 1] = inside[after - 2] = False
    return (mix >> np.uint32(32 - TRIGRAM_BITS))[inside[:-2]].astype(np.int64), sizes - 2


def means(table: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Mean of the rows of a table, over stretches of a list of row numbers."""
    return np.add.reduceat(table[flat], np.cumsum(sizes) - sizes, axis=0) / sizes[:, None].astype(np.float32)


def windows_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of texts with so many words: the text and where in it each begins. Neighbours overlap, all words lie in one."""
    counts = 1 + np.maximum(0, -(-(sizes - WINDOW) // STRIDE))
    owners = np.repeat(np.arange(len(sizes)), counts)
    return owners, (np.arange(len(owners)) - np.repeat(np.cumsum(counts) - counts, counts)) * STRIDE


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Sorted hashes of the vocabulary, and weights: word (row 0: not known) and trigram vectors, gates, attention, output."""

    def __init__(self, vocabulary: np.ndarray, weights: dict[str, np.ndarray]):
        self.vocabulary, self.w = vocabulary, weights

    @classmethod
    def fresh(cls, vocabulary: np.ndarray, hints: np.ndarray, rng: np.random.Generator) -> Network:
        """Random weights; the first part of a word's vector starts from how toxic its texts are."""
        normal = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        words = normal(len(vocabulary) + 1, WORD_SIZE, scale=0.1)
        words[0] = 0
        words[1:, 0] = hints
        size = WORD_SIZE + CHAR_SIZE
        return cls(
            vocabulary,
            {
                "words": words,
                "chars": normal(1 << TRIGRAM_BITS, CHAR_SIZE, scale=0.3),
                "into": normal(2, size, 3 * STATE, scale=1 / math.sqrt(size)),
                "bias": np.zeros((2, 3 * STATE), np.float32),
                "again": normal(2, STATE, 3 * STATE, scale=1 / math.sqrt(STATE)),
                "look": normal(2 * STATE, scale=0.3),
                "out": normal(2 * STATE, scale=0.3),
                "level": np.zeros(1, np.float32),
            },
        )

    def run(self, entered: np.ndarray, ids: np.ndarray, keep: bool = False):
        """Logits of windows. entered: (2, words, 3 * STATE), what each word sends to the gates of either direction;
        ids: (steps, n), the words of each window, 0 where it has no more. That word's gates are shut."""
        steps, n = ids.shape
        h = np.zeros((2, n, STATE), np.float32)
        states = np.zeros((steps, n, 2 * STATE), np.float32)
        kept = []
        x = np.empty((2, n, 3 * STATE), np.float32)
        half = np.float32(0.5)
        for t in range(steps):
            np.take(entered[0], ids[t], 0, x[0], mode="clip")
            np.take(entered[1], ids[-1 - t], 0, x[1], mode="clip")
            again = h @ self.w["again"]
            zr = x[..., : 2 * STATE] + again[..., : 2 * STATE]
            zr *= half
            np.tanh(zr, zr)
            zr *= half
            zr += half
            z, r = zr[..., :STATE], zr[..., STATE:]
            new = np.tanh(x[..., 2 * STATE :] + r * again[..., 2 * STATE :])
            if keep:
                kept.append((h, z, r, new, again[..., 2 * STATE :]))
            h = h + z * (new - h)
            states[t, :, :STATE], states[-1 - t, :, STATE:] = h[0], h[1]
        attention = np.where(ids > 0, states @ self.w["look"], np.float32(-30))
        attention = np.exp(attention - attention.max(0))
        attention /= attention.sum(0)
        pooled = np.einsum("tn,tnk->nk", attention, states)
        logits = pooled @ self.w["out"] + self.w["level"][0]
        return (logits, kept, states, attention, pooled) if keep else logits

    def slopes(self, entered: np.ndarray, ids: np.ndarray, labels: np.ndarray, weight: np.ndarray):
        """Gradients of the weighted log loss, for the weights and for what each step was sent: (2, steps, n, 3 * STATE)."""
        logits, kept, states, attention, pooled = self.run(entered, ids, keep=True)
        steps, n = ids.shape
        gap = ((_sigmoid(logits) - labels) * weight).astype(np.float32)
        by = {"level": np.array([gap.sum()]), "out": pooled.T @ gap}
        to_pooled = gap[:, None] * self.w["out"]
        to_attention = (states * to_pooled).sum(-1)
        to_scores = attention * (to_attention - (attention * to_attention).sum(0)) * (ids > 0)
        by["look"] = np.einsum("tn,tnk->k", to_scores, states)
        to_states = attention[..., None] * to_pooled + to_scores[..., None] * self.w["look"]
        sent = np.zeros((2, steps, n, 3 * STATE), np.float32)
        by["again"] = np.zeros_like(self.w["again"])
        to_h = np.zeros((2, n, STATE), np.float32)
        for t in reversed(range(steps)):
            h, z, r, new, again_new = kept[t]
            to_h = to_h + np.stack([to_states[t, :, :STATE], to_states[-1 - t, :, STATE:]])
            to_new = to_h * z * (1 - new * new)
            to_z = to_h * (new - h) * z * (1 - z)
            to_r = to_new * again_new * r * (1 - r)
            to_again = np.concatenate([to_z, to_r, to_new * r], -1)
            by["again"] += h.transpose(0, 2, 1) @ to_again
            to_h = to_h * (1 - z) + to_again @ self.w["again"].transpose(0, 2, 1)
            step = np.concatenate([to_z, to_r, to_new], -1)
            sent[0, t], sent[1, -1 - t] = step[0], step[1]
        return by, sent


    def entered(self, code: np.ndarray, starts: np.ndarray, ends: np.ndarray, known: np.ndarray):
        """What words send to the gates, after a first row that shuts them; also vectors, trigrams and their numbers."""
        w = self.w
        shut = np.concatenate([np.full(STATE, -30), np.zeros(2 * STATE)]).astype(np.float32)
        shut = np.broadcast_to(shut, (2, 1, 3 * STATE))
        if not len(starts):
            return shut, np.zeros((0, WORD_SIZE + CHAR_SIZE), np.float32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        flat, sizes = trigrams(code, starts, ends)
        vectors = np.concatenate([w["words"][known], means(w["chars"], flat, sizes)], 1)
        return np.concatenate([shut, vectors @ w["into"] + w["bias"][:, None]], 1), vectors, flat, sizes

    def logits(self, texts: list[str | None], batch: int = 2048) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logit of every window of every text, the text that it belongs to, and where it begins there."""
        words = Words([t.lower() if t else "" for t in texts], LETTERS)
        hashes, first, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
        known = lookup(self.vocabulary, hashes) + 1
        sent = self.entered(words.code, words.starts[first], words.ends[first], known)[0]
        owners, begins = windows_of(np.diff(words.first))
        number = np.append(number + 1, 0)
        steps = np.arange(WINDOW)[:, None]
        found = np.empty(len(owners), np.float32)
        for i in range(0, len(owners), batch):
            own = owners[i : i + batch]
            at = words.first[own] + begins[i : i + batch] + steps
            found[i : i + batch] = self.run(sent, np.where(at < words.first[own + 1], number[np.minimum(at, len(number) - 1)], 0))
        return found, owners, begins

    def scores(self, texts: list[str | None]) -> np.ndarray:
        logits, owners, _ = self.logits(texts)
        starts = np.flatnonzero(np.append(True, owners[1:] != owners[:-1]))
        return _sigmoid(np.maximum.reduceat(logits, starts).astype(np.float64))


def portions(texts: list[str | None], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Stretches of a list, of 300 texts at most that together have ``limit`` characters, or of one longer text."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and (i - start == 300 or size + len(text or "") > limit):
            yield start, i
            start, size = i, 0
        size += len(text or "")
    if texts:
        yield start, len(texts)


class Spelled:
    """The distinct words of many texts, by hash, each spelled once; and for each word of each text its number among them."""

    def __init__(self, texts: list[str | None]):
        every, sizes, distinct, code = [], [], [], []
        known = np.zeros(0, np.uint64)
        for start, end in portions(texts):
            words = Words([t.lower() if t else "" for t in texts[start:end]], LETTERS)
            every.append(words.hashes())
            sizes.append(np.diff(words.first))
            found, at = np.unique(every[-1], return_index=True)
            new = ~np.isin(found, known)
            known = np.union1d(known, found)
            distinct.append(found[new])
            code.append(gathered(words.code, words.starts[at[new]], words.ends[at[new]], BEFORE, AFTER))
        self.code = np.concatenate([c for c, _ in code])
        marked = np.concatenate([n for _, n in code])
        order = np.argsort(np.concatenate(distinct))
        begins = np.cumsum(marked) - marked
        self.starts, self.ends = (begins + 1)[order], (begins + marked - 1)[order]
        self.hashes = known
        self.number = np.concatenate([np.searchsorted(known, x).astype(np.int32) for x in every])
        self.sizes = np.concatenate(sizes)
        #: Which words belong to text k: first[k] to first[k + 1].
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])


def fit(texts: list[str | None], labels: list[int], epochs: int = EPOCHS, seed: int = 11) -> Network:
    """Train on labelled texts; the same rows in the same order give the same network."""
    rng = np.random.default_rng(seed)
    y = np.array(labels, np.float32)
    share = float(y.mean()) if len(y) else 0.0
    if share in (0.0, 1.0):
        net = Network.fresh(np.zeros(0, np.uint64), np.zeros(0, np.float32), rng)
        net.w["out"][:] = 0
        net.w["level"][:] = -30 if share == 0 else 30
        return net
    words = Spelled(texts)
    # In how many texts each word occurs, and in how many toxic ones.
    seen, toxic = np.zeros(len(words.hashes), np.int64), np.zeros(len(words.hashes))
    for start, end in portions(texts):
        owner = np.repeat(np.arange(end - start), words.sizes[start:end])
        word, owner = np.divmod(np.unique(words.number[words.first[start] : words.first[end]] * np.int64(end - start) + owner), end - start)
        seen += np.bincount(word, minlength=len(seen))
        toxic += np.bincount(word, y[start + owner], minlength=len(toxic))
    kept = np.flatnonzero(seen >= 3)
    kept = np.sort(kept[np.argsort(-seen[kept], kind="stable")][:VOCABULARY])
    odds = np.log((toxic + share) / (seen - toxic + 1 - share) * (1 - share) / share)[kept]
    net = Network.fresh(words.hashes[kept], np.clip(odds, -3, 3).astype(np.float32), rng)
    known = lookup(net.vocabulary, words.hashes) + 1
    first = {k: np.zeros_like(v) for k, v in net.w.items()}
    second = {k: np.zeros_like(v) for k, v in net.w.items()}
    step = 0
    epochs = max(epochs, -(-STEPS // -(-len(y) // BATCH)))
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) ** 0.5
    for epoch in range(epochs):
        chunks = [(start, *net.logits(texts[start:end])) for start, end in portions(texts)]
        logits = np.concatenate([x[1] for x in chunks])
        owners = np.concatenate([x[2] + x[0] for x in chunks])
        begins = np.concatenate([x[3] for x in chunks])
        # The worst window of each text.
        of_text = np.flatnonzero(np.append(True, owners[1:] != owners[:-1]))
        worst = [int(part.argmax()) + s for part, s in zip(np.split(logits, of_text[1:]), of_text, strict=True)]
        order = rng.permutation(len(texts))
        for i in range(0, len(order), BATCH):
            rows = order[i : i + BATCH]
            at = begins[[worst[r] for r in rows]] + np.arange(WINDOW)[:, None]
            inside = at < words.sizes[rows]
            if not inside.any():
                continue
            at = (words.first[rows] + at)[inside]
            at, place_of = np.unique(words.number[at], return_inverse=True)
            ids = np.zeros(inside.shape, np.int64)
            ids[inside] = place_of + 1
            # Now and then a word is read by its letters alone.
            known_ids = known[at] * (rng.random(len(at)) > 0.15)
            entered, vectors, flat, sizes = net.entered(words.code, words.starts[at], words.ends[at], known_ids)
            by, sent = net.slopes(entered, ids, y[rows], weight[rows] / len(rows))
            to_words = np.zeros((2, len(at) + 1, 3 * STATE), np.float32)
            for d in range(2):
                np.add.at(to_words[d], ids.ravel(), sent[d].reshape(-1, 3 * STATE))
            to_words = to_words[:, 1:]
            by["into"] = np.einsum("wi,dwg->dig", vectors, to_words)
            by["bias"] = to_words.sum(1)
            to_vectors = np.einsum("dwg,dig->wi", to_words, net.w["into"])
            by["words"] = np.zeros_like(net.w["words"])
            by["words"][known_ids] = to_vectors[:, :WORD_SIZE]
            by["words"][0] = 0
            spread = np.repeat(to_vectors[:, WORD_SIZE:] / sizes[:, None], sizes, axis=0)
            by["chars"] = np.stack([np.bincount(flat, spread[:, c], 1 << TRIGRAM_BITS) for c in range(CHAR_SIZE)], 1)
            step += 1
            rate = RATE * (1 - 0.9 * epoch / epochs) * math.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, slope in by.items():
                first[k] += np.float32(0.1) * (slope - first[k])
                second[k] += np.float32(0.001) * (slope * slope - second[k])
                net.w[k] -= (rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return net


def learn(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> Network:
    """Fit on docs (doc_id, text) and labels (doc_id, toxic): a bounded number of each kind."""
    known = labels.filter("toxic is not null and doc_id is not null")
    hashed = known.select("doc_id", (F.col("toxic") == 1).cast("int").alias("toxic")).distinct().withColumn("h", F.xxhash64("doc_id"))
    ids = None
    for kind, most in ((F.col("toxic") == 1, toxic), (F.col("toxic") != 1, clean)):
        some = hashed.filter(kind).orderBy("h", "doc_id").limit(most)
        ids = some if ids is None else ids.unionByName(some)
    # At most toxic + clean rows, so small enough to send to every task.
    few = F.broadcast(ids.select(F.col("doc_id").alias("labelled"), F.col("toxic").cast("int").alias("toxic")))
    rows = docs.join(few, F.col("doc_id") == F.col("labelled")).groupBy("doc_id", "toxic").agg(F.min_by(F.coalesce("text", F.lit("")), F.xxhash64("text")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["doc_id"], r["text"], r["toxic"]) for batch in batches for r in batch.to_pylist())
        net = fit([r[1] for r in rows], [r[2] for r in rows])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((net.vocabulary, net.w))], pa.binary())], ["net"])

    # The sample is bounded, so one task trains on it; the driver holds nothing but the weights.
    found = rows.repartition(1).mapInArrow(run, "net binary").collect()
    return Network(*pickle.loads(bytes(found[0][0]))) if found else fit([], [])


def score(docs: DataFrame, net: Network, text_col: str = "text") -> DataFrame:
    """All columns (by number, see ``numbered``) and ``score``."""
    plain = numbered(docs)
    text = f"_{place(docs, text_col)}"
    shared = docs.sparkSession.sparkContext.broadcast((net.vocabulary, net.w))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(*shared.value)
        for batch in slices(batches, text, 1 << 20):
            found = net.scores(batch.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, "score"])

    return plain.mapInArrow(run, plain.withColumn("score", F.lit(0.0)).schema)


def score_held_out(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 3, fold: int = 1) -> DataFrame:
    """Learn from the labels of all folds but one; doc_id, held_out, score and predicted of every row."""
    rows = pick(docs, doc_id=id_col, text=text_col)
    known = pick(labels, doc_id="doc_id", toxic="toxic").filter(~held_out(F.col("doc_id"), folds, fold))
    return score(rows, learn(rows, known)).select(
        F.col("_0").alias("doc_id"),
        held_out(F.col("_0"), folds, fold).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that score below the threshold, with all their columns; same folds as above."""
    rows = pick(docs, doc_id=id_col, text=text_col)
    known = pick(labels, doc_id="doc_id", toxic="toxic").filter(~held_out(F.col("doc_id"), 3, 1))
    scored = score(docs, learn(rows, known), text_col)
    return scored.filter(F.col("score") < THRESHOLD).drop("score").toDF(*docs.columns)
