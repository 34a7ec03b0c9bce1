r"""Secrets in texts: fixed patterns, and a linear-chain conditional random field that adds to them.

Patterns (base spans, leftmost and non-overlapping per kind, offsets in code points): ``assign`` a
credential word, a colon or equals sign and a value of 6 characters or more; ``access`` AKIA keys; ``hex``
runs of 24 or more.

The field tags tokens as O (outside), B (begins a secret) or I (inside). A token is a run of
``[A-Za-z0-9+/_.=-]`` or one other character, and every token may be any of the three: length and digits are
features, not conditions. The tokens of many texts are one long sequence with an outside mark between texts. It
is cut into ``STRIDE`` tokens; exact Viterbi runs over all cuts at once, for each tag before a cut, and a
pass over the cuts joins them. Features: shape, neighbouring words, and figures of the whole text.

It is fitted in one task on the base spans of a bounded sample of documents (``SAMPLE``, ``SAMPLE_BYTES``: the smallest
hashes of id and text), in windows of about ``WINDOW`` tokens: up to ``WINDOWS`` with base spans and as many without,
evenly spread; each stands for those left out by its weight. Each is fitted twice, once without the words next to its
tokens, so that shape counts by itself. Three things let it find what no pattern names. Tokens outside the base spans
that look made up are not taken for harmless: the likelihood is summed over all tags that they may have. Windows
whose base spans hold a made-up value are fitted again with the value alone, in the place of another token, as a secret
without a name. And most of those are given values of other alphabets and lengths.

Defined results: a null or empty text has no spans. Rows are scored one by one, so repeated rows and ties
get equal results, null ids are kept, and an empty table gives an empty result. With no base span in the
sample the field adds nothing. Texts of any length are read whole. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import letters, pick, slices, stretch_hashes, text_bytes
from stayline.llm.language_id import sampled

# The base patterns. "Letters in either case" means A-Z and a-z only.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")


def _either_case(pattern: str) -> str:
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", pattern)


ASSIGN = re.compile(rf"""({"|".join(map(_either_case, KEYWORDS))})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "crf")

#: Documents and bytes of text that the field is fitted on at most.
SAMPLE, SAMPLE_BYTES = 3000, 32 << 20
#: Size of the hashed feature space, passes over the sample, learning rate, weight of the penalty.
FEATURES, EPOCHS, RATE, PENALTY = 1 << 14, 60, 0.1, 1e-6
#: Tokens of a training window, windows of each sort at most, tokens that are decoded between two joins.
WINDOW, WINDOWS, STRIDE = 32, 1500, 256
#: Length of a token, and bits per character, from which it may be a secret that no pattern knows.
MADE_UP_LENGTH, MADE_UP_BITS = 12, 3.0
#: Windows without names for each window with a made-up value, all but one with values of other kinds; what those are made of.
VARIANTS = 6
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
OTHER_ALPHABETS = (_UPPER + _LOWER + _DIGITS, _LOWER + _DIGITS, _UPPER + _DIGITS, _UPPER + _LOWER + _DIGITS + "_-", _UPPER + _LOWER + _DIGITS + "+/")
#: Bytes of text that are tokenized at once; tokens whose features are kept.
TOGETHER, KNOWN = 1 << 20, 100_000

O, B, I = range(3)  # noqa: E741
LOW = -1e9
#: Transitions that exist: nothing is inside that hasn't begun.
ALLOWED = np.array([[0, 0, LOW], [0, 0, 0], [0, 0, 0]])

_OPEN_LENGTH = 8
_IS_HEX = np.zeros(256, bool)
_IS_HEX[[ord(c) for c in "0123456789abcdef"]] = True
_IS_TOKEN = letters(lambda c: c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
_IS_SPACE = letters(str.isspace)

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the fixed patterns, by start and kind."""
    found = []
    low = text.lower()
    if any(word in low for word in ("password", "passwd", "secret", "token", "api")):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    for kind, pattern, has in (("access", ACCESS, "AKIA" in text), ("hex", HEX, True)):
        if has:
            found += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if m.end() - m.start() >= LEAST[kind]]
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int]:
    return span[0], KINDS.index(span[2])


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


class Chain:
    """The tokens of texts, one after the other, and the numbers of their features (``FEATURES``: none)."""

    def __init__(self, texts: list[str]):
        joined = "\n".join(texts)
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = np.minimum(code, len(_IS_TOKEN) - 1)
        run = np.concatenate([[False], _IS_TOKEN[kind], [False]])
        single = ~run[1:-1] & ~_IS_SPACE[kind]
        self.starts = np.flatnonzero(run[1:-1] & ~run[:-2] | single)
        self.ends = np.flatnonzero(run[1:-1] & ~run[2:] | single) + 1
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.text_starts = np.concatenate([[0], np.cumsum(sizes)])
        #: Which tokens belong to text k: first[k] to first[k + 1].
        self.first = np.searchsorted(self.starts, self.text_starts)
        self.owner = np.repeat(np.arange(len(texts)), np.diff(self.first))
        hashes = stretch_hashes(code, self.starts, self.ends)
        _, at, self.which = np.unique(hashes, return_index=True, return_inverse=True)
        self.words = [joined[s:e] for s, e in zip(self.starts[at].tolist(), self.ends[at].tolist(), strict=True)]
        digits = np.concatenate([[0], np.cumsum((code >= 48) & (code <= 57))])
        has = (self.ends - self.starts >= _OPEN_LENGTH) & (digits[self.ends] > digits[self.starts])
        opens = np.bincount(self.owner, has, len(texts)).astype(int)
        inside = digits[self.text_starts[1:] - 1] - digits[self.text_starts[:-1]]
        self.of_file = [
            (f"open{min(int(n).bit_length(), 6)}", f"digits{min(10, int(20 * d / max(1, size)))}", f"long{min(int(size).bit_length() // 2, 8)}")
            for n, d, size in zip(opens, inside, sizes - 1, strict=True)
        ]

    def __len__(self) -> int:
        return len(self.starts)

    def numbers(self, known: Numbers) -> np.ndarray:
        """Feature numbers, (token, ``COLUMNS``): by itself, of the text, touching; then the words around."""
        n = len(self)
        out = np.full((n, COLUMNS), FEATURES, np.uint16)
        if not n:
            return out
        known.bound()
        of_word = np.array([known[w] for w in self.words], np.uint16)
        out[:, :10] = of_word[self.which, :10]
        out[:, 10:13] = np.array([_numbers(x) for x in self.of_file], np.uint16)[self.owner]
        touch = np.concatenate([[False], self.starts[1:] == self.ends[:-1]])
        out[:, 13] = np.array(_numbers(("touchFalse", "touchTrue")), np.uint16)[touch.astype(int)]
        # The words around, without what stands between a name and its value.
        place, first = np.arange(n), self.first[self.owner]
        between = np.array([w in ("=", ":", '"', "'") for w in self.words])[self.which]
        before = np.concatenate([[-1], np.maximum.accumulate(np.where(between, -1, place))])
        near = place
        for column, of in ((14, 10), (15, 11)):
            near = before[np.maximum(near, 0)]
            near = np.where((near >= first) & (place - near < 8), near, -1)
            some = near >= 0
            out[some, column] = of_word[self.which[near[some]], of]
            near = np.where(some, near, 0)
        low = [w.lower() for w in self.words]
        sign = np.array([ord(x) if len(x) == 1 else 0 for x in low])[self.which]
        key = np.zeros(n, np.int64)
        for back in (3, 2, 1):
            there = np.flatnonzero(place - back >= first)
            value = np.zeros(n, np.int64)
            value[there] = sign[there - back]
            key = key << 21 | value
        keys, each = np.unique(key, return_inverse=True)
        signs = ["".join(chr(c) for c in (int(k) >> 42, int(k) >> 21 & 0x1FFFFF, int(k) & 0x1FFFFF) if c) for k in keys]
        out[:, 16] = np.array(_numbers(tuple(f"signs{x}" for x in signs)), np.uint16)[each]
        out[:, 17] = _numbers(("next^",))[0]
        more = np.flatnonzero(place + 1 < self.first[self.owner + 1])
        out[more, 17] = of_word[self.which[more + 1], 12]
        return out


#: Feature numbers per token, and how many of them are those of its shape, its text and its touching.
COLUMNS, PLAIN = 18, 14


def chains(text: str) -> list[Chain]:
    """The tokens of a text as one chain, if it has any."""
    chain = Chain([text])
    return [chain] if len(chain) else []


def shape(token: str) -> tuple[str, ...]:
    """What a token looks like by itself."""
    n = len(token)
    kinds = Counter("d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s" for c in token)
    entropy = -sum(c / n * math.log2(c / n) for c in sorted(Counter(token).values()))
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(token, token[1:], strict=False))
    runs = re.sub(r"(.)\1+", r"\1", "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.islower() else c for c in token))
    return (
        "bias",
        f"length{min(n // 4, 16)}",
        f"made{''.join(sorted(kinds))}",
        f"share{10 * kinds['d'] // n}",
        f"entropy{int(2 * entropy)}",
        f"changes{min(10, 10 * changes // n)}",
        f"hex{all(c in '0123456789abcdefABCDEF' for c in token)}",
        f"starts{token[:4]}",
        f"signs{''.join(sorted({c for c in token if not c.isalnum()}))}",
        f"runs{runs[:12]}",
    )


def _numbers(names: tuple[str, ...]) -> list[int]:
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % FEATURES for x in names]


def viterbi(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best tags of one sequence (token, 3); what lies before and after it is outside."""
    n = len(scores)
    cuts = -(-n // STRIDE)
    padded = np.full((cuts * STRIDE, 3), LOW)
    padded[:n], padded[n:, O] = scores, 0
    steps = np.ascontiguousarray(padded.reshape(cuts, STRIDE, 3).transpose(1, 2, 0))
    # best[before][now], for each cut; back[t][before][now] is the tag one earlier.
    best = np.empty((3, 3, cuts))
    best[:] = moves[:, :, None] + steps[0][None]
    back = np.empty((STRIDE, 3, 3, cuts), np.int8)
    for t in range(1, STRIDE):
        a, b, c = (best[:, k, None] + moves[k][None, :, None] for k in (O, B, I))
        top = np.maximum(a, b)
        back[t] = np.where(c > top, 2, b > a)
        best = np.maximum(top, c) + steps[t][None]
    # Join the cuts: tags at their ends.
    now, came = [0.0, LOW, LOW], []
    for whole in best.transpose(2, 0, 1).tolist():
        paths = [[now[i] + whole[i][j] for i in range(3)] for j in range(3)]
        now = [max(p) for p in paths]
        came.append([p.index(m) for p, m in zip(paths, now, strict=True)])
        top = max(now)
        now = [x - top for x in now]
    ends = [now[k] + moves[k, O] for k in range(3)]
    end = ends.index(max(ends))
    last, before = np.empty(cuts, int), np.empty(cuts, int)
    for k in range(cuts - 1, -1, -1):
        last[k], before[k] = end, came[k][end]
        end = came[k][end]
    tags, every = np.empty((STRIDE, cuts), np.int8), np.arange(cuts)
    tags[-1] = last
    for t in range(STRIDE - 1, 0, -1):
        tags[t - 1] = back[t, before, tags[t], every]
    return tags.T.ravel()[:n]


_CLASSES = str.maketrans({**dict.fromkeys("0123456789", "9"), **dict.fromkeys("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A"), **dict.fromkeys("abcdefghijklmnopqrstuvwxyz", "a")})
_HEX_CHARS = frozenset("0123456789abcdefABCDEF")
#: What a shape rests on: all but entropy, hex digits and the first letters follow from the classes of the characters.
_ENTROPY, _HEX, _STARTS = 4, 6, 7
_AROUND = tuple(zlib.crc32(x) for x in (b"near0", b"near1", b"next"))


class Numbers(dict):
    """Token to the feature numbers of its shape, then those as near0, near1 and next word; as ``shape`` gives them."""

    def __init__(self):
        super().__init__()
        self.classes: dict[str, list[int]] = {}
        self.entropies: dict[tuple[int, ...], int] = {}

    def __missing__(self, token: str) -> list[int]:
        if token.isascii():
            classes = token.translate(_CLASSES)
            out = self.classes.get(classes)
            if out is None:
                out = self.classes[classes] = _numbers(shape(classes))
            out = out.copy()
            letters_ = set(token)
            counts = tuple(sorted(map(token.count, letters_)))
            entropy = self.entropies.get(counts)
            if entropy is None:
                entropy = self.entropies[counts] = _numbers(shape(token))[_ENTROPY]
            out[_ENTROPY] = entropy
            out[_HEX] = _IS_OF_HEX[letters_ <= _HEX_CHARS]
            out[_STARTS] = zlib.crc32(token[:4].encode(), _STARTS_CRC) % FEATURES
        else:
            out = _numbers(shape(token))
        low = token.lower().encode("utf-8", "surrogatepass")
        out += [zlib.crc32(low, x) % FEATURES for x in _AROUND]
        self[token] = out
        return out

    def bound(self) -> None:
        for part in (self, self.classes, self.entropies):
            if len(part) > KNOWN:
                part.clear()


_IS_OF_HEX = _numbers(("hexFalse", "hexTrue"))
_STARTS_CRC = zlib.crc32(b"starts")


class Field:
    """Weights per feature and tag, and per pair of neighbouring tags."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves
        self.known = Numbers()
        self.padded = np.concatenate([weights, np.zeros((1, 3), weights.dtype)])

    @classmethod
    def nothing(cls) -> Field:
        """Tags all as outside."""
        weights = np.zeros((FEATURES, 3))
        weights[:, B] = weights[:, I] = -10
        return cls(weights, np.zeros((3, 3)))

    def scores(self, chain: Chain) -> np.ndarray:
        out = np.zeros((len(chain), 3))
        for column in chain.numbers(self.known).T:
            out += self.padded[column]
        return out

    def decode(self, chain: Chain) -> list[int]:
        """The best tags of all tokens; what lies before and after each text is outside."""
        # One mark per text: only outside can be there.
        marked = np.full((len(chain) + len(chain.of_file), 3), LOW)
        marked[:, O] = 0
        at = np.arange(len(chain)) + chain.owner
        marked[at] = self.scores(chain)
        return viterbi(marked, self.moves + ALLOWED)[at].tolist()

    def spans_of(self, texts: list[str]) -> list[list[Span]]:
        chain = Chain(texts)
        found: list[list[Span]] = [[] for _ in texts]
        tags = np.array(self.decode(chain), int)
        starts, ends = chain.starts - chain.text_starts[chain.owner], chain.ends - chain.text_starts[chain.owner]
        for k in np.flatnonzero(tags != O):
            mine = found[chain.owner[k]]
            if tags[k] == B:
                mine.append((int(starts[k]), int(ends[k]), "crf"))
            else:
                mine[-1] = (mine[-1][0], int(ends[k]), "crf")
        return found

    def spans(self, text: str) -> list[Span]:
        return self.spans_of([text])[0]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def marginals(scores: np.ndarray, moves: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of chains of one length (n, length, 3): tag probabilities, expected moves with both ends, weighted, log sums."""
    n, length, _ = scores.shape
    ahead = [scores[:, 0] + moves[O]]
    for t in range(1, length):
        ahead.append(_log_sum(ahead[-1][:, :, None] + moves, 1) + scores[:, t])
    behind = [np.broadcast_to(moves[:, O], (n, 3))]
    for t in range(length - 1, 0, -1):
        behind.append(_log_sum(moves[None] + (scores[:, t] + behind[-1])[:, None, :], 2))
    behind.reverse()
    total = _log_sum(ahead[-1] + moves[:, O], 1)
    tags = np.exp(np.stack([a + b for a, b in zip(ahead, behind, strict=True)], 1) - total[:, None, None])
    pairs = np.zeros((3, 3))
    for t in range(1, length):
        both = np.exp(ahead[t - 1][:, :, None] + moves + (scores[:, t] + behind[t])[:, None, :] - total[:, None, None])
        pairs += (weight @ both.reshape(n, 9)).reshape(3, 3)
    pairs[O] += weight @ tags[:, 0]
    pairs[:, O] += weight @ tags[:, -1]
    return tags, pairs, total


def bare(numbers: np.ndarray, tags: np.ndarray, free: np.ndarray, looks: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """A window as if the made-up values in its base spans stood there without a name: each begins a secret, has the
    neighbours of another token of the window, and whatever else the spans hold is left out. None if no span holds such
    a value."""
    values = looks & (tags != O)
    if not values.any():
        return None
    kept, others = (tags == O) | values, np.flatnonzero(tags == O)
    numbers = numbers.copy()
    numbers[values, PLAIN:] = numbers[rng.choice(others, values.sum()), PLAIN:] if len(others) else FEATURES
    return numbers[kept], np.where(values, B, O)[kept], free[kept]


def other_value(rng: np.random.Generator) -> str:
    """A made-up value of another alphabet and length: the patterns know few kinds of secrets."""
    letters_ = OTHER_ALPHABETS[rng.integers(len(OTHER_ALPHABETS))]
    return "".join(letters_[k] for k in rng.integers(len(letters_), size=rng.integers(MADE_UP_LENGTH, 48)))


def made_up(token: str) -> bool:
    """Long, of at least two kinds of letters and digits that change often, and few characters repeated."""
    if len(token) < MADE_UP_LENGTH:
        return False
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" for c in token if c.isalnum()]
    counts = Counter(token).values()
    entropy = -sum(c / len(token) * math.log2(c / len(token)) for c in counts)
    changes = sum(x != y for x, y in zip(kinds, kinds[1:], strict=False))
    return entropy >= MADE_UP_BITS and len(set(kinds)) > 1 and 4 * changes >= len(token)


def labels(chain: Chain, marked: list[list[Span]]) -> np.ndarray:
    """B where a base span begins, I elsewhere under one, O beside them."""
    tags = np.zeros(len(chain), np.int64)
    for k, spans in enumerate(marked):
        for inside in (True, False):  # beginnings last: they win
            for s, e, _ in spans:
                low = chain.text_starts[k] + s
                first = np.searchsorted(chain.ends, low, "right")
                if inside:
                    tags[first : np.searchsorted(chain.starts, chain.text_starts[k] + e)] = I
                else:
                    tags[first] = B
    return tags


class _Kept:
    """Windows, evenly spread: every ``step``-th of those seen, at most ``WINDOWS``."""

    def __init__(self):
        self.rows, self.step, self.seen = [], 1, 0

    def add(self, numbers: np.ndarray, tags: np.ndarray, free: np.ndarray) -> None:
        if self.seen % self.step == 0:
            self.rows.append((numbers.copy(), tags.copy(), free.copy()))
            if len(self.rows) > WINDOWS:
                self.rows, self.step = self.rows[::2], 2 * self.step
        self.seen += 1

    def weight(self) -> float:
        return self.seen / max(1, len(self.rows))


def training_windows(texts: list[str], without_kinds: tuple[str, ...] = ()) -> tuple[_Kept, _Kept]:
    """Windows with base spans and windows without. A window ends where no span is cut. Spans of some kinds may be left
    out, to see whether the field finds them by itself."""
    with_spans, without, known = _Kept(), _Kept(), Numbers()
    # The same windows on every run.
    rng = np.random.default_rng(5)
    group: list[str] = []
    for k, text in enumerate(texts):
        group.append(text)
        if k + 1 < len(texts) and sum(map(len, group)) < TOGETHER:
            continue
        chain = Chain(group)
        numbers, tags = chain.numbers(known), labels(chain, [[x for x in base_spans(t) if x[2] not in without_kinds] for t in group])
        looks = np.array([made_up(w) for w in chain.words], bool)[chain.which]
        free = looks & (tags == O)
        for first, end in zip(chain.first[:-1].tolist(), chain.first[1:].tolist(), strict=True):
            while first < end:
                last = min(first + WINDOW, end)
                while last < end and tags[last] == I:
                    last += 1
                window = numbers[first:last], tags[first:last], free[first:last]
                (with_spans if tags[first:last].any() else without).add(*window)
                for turn in range(VARIANTS):
                    alone = bare(*window, looks[first:last], rng)
                    if alone is None:
                        break
                    for k in np.flatnonzero(alone[1] == B) if turn else ():
                        alone[0][k, :10] = known[other_value(rng)][:10]
                    with_spans.add(*alone)
                first = last
        group = []
    return with_spans, without


def fit(texts: list[str], without_kinds: tuple[str, ...] = ()) -> Field:
    """Fit on the base spans of the texts: penalised likelihood by Adam, the same on every run.

    The likelihood is that of the known tags, summed over all tags that made-up tokens beside the base spans may have.
    """
    with_spans, without = training_windows(texts, without_kinds)
    if not with_spans.rows:
        return Field.nothing()
    by_length: dict[tuple[int, bool], list] = {}
    for kept in (with_spans, without):
        for numbers, tags, free in kept.rows:
            # Few lengths: the rest of a window are marks that only outside can have. Windows with unknown tags apart.
            length = -(-len(tags) // WINDOW) * WINDOW
            by_length.setdefault((length, bool(free.any())), []).append((numbers, tags, free, kept.weight()))
    groups = []
    for (length, some_free), rows in sorted(by_length.items()):
        ids = np.full((len(rows), length, COLUMNS), FEATURES, np.uint16)
        tags, real, open_ = np.zeros((len(rows), length), np.int64), *(np.zeros((len(rows), length), bool) for _ in range(2))
        for k, (numbers, wanted, free, _) in enumerate(rows):
            ids[k, : len(wanted)], tags[k, : len(wanted)], real[k, : len(wanted)], open_[k, : len(wanted)] = numbers, wanted, True, free
        weight = np.array([w for *_, w in rows])
        # What the known tags leave open: nothing, or all tags of the unknown ones.
        known = np.where(open_[..., None] | np.eye(3, dtype=bool)[tags], 0, LOW) if some_free else None
        groups += [(ids[..., :PLAIN][real], tags, real, weight, known), (ids[real], tags, real, weight, known)]
    total = sum(float((real * weight[:, None]).sum()) for _, _, real, weight, _ in groups)
    weights, moves = np.zeros((FEATURES, 3)), np.zeros((3, 3))
    first = [np.zeros_like(weights), np.zeros_like(moves)]
    second = [np.zeros_like(weights), np.zeros_like(moves)]
    for step in range(1, EPOCHS + 1):
        by_weight, by_move = PENALTY * weights * total, np.zeros((3, 3))
        padded = np.concatenate([weights, np.zeros((1, 3))])
        for ids, tags, real, weight, known in groups:
            flat = np.zeros((len(ids), 3))
            for column in ids.T:
                flat += padded[column]
            scores = np.full((*tags.shape, 3), LOW)
            scores[..., O] = 0
            scores[real] = flat
            got, pairs = marginals(scores, moves + ALLOWED, weight)[:2]
            if known is None:
                told = np.eye(3)[tags]
                edge = np.zeros((len(tags), 1), int)
                path = np.concatenate([edge, tags, edge], 1)
                steps = np.bincount((3 * path[:, :-1] + path[:, 1:]).ravel(), np.repeat(weight, path.shape[1] - 1), 9).reshape(3, 3)
            else:
                told, steps = marginals(scores + known, moves + ALLOWED, weight)[:2]
            gap = ((got - told) * weight[:, None, None])[real]
            for k in range(3):
                of = np.ascontiguousarray(gap[:, k])
                for column in ids.T:
                    by_weight[:, k] += np.bincount(column, of, FEATURES + 1)[:FEATURES]
            by_move += pairs - steps
        for value, slope, m, v in ((weights, by_weight, first[0], second[0]), (moves, by_move, first[1], second[1])):
            slope = slope / total
            m += 0.1 * (slope - m)
            v += 0.01 * (slope * slope - v)
            value -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(weights, moves)


def learn(docs: DataFrame, size: int = SAMPLE, most_bytes: int = SAMPLE_BYTES) -> Field:
    """Fit on doc_id and text: a bounded number of documents and bytes, those with the smallest hashes of id and text."""
    sample = sampled(docs.select("doc_id", "text", F.lit("").alias("lang")), size, most_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = fit(sorted(t for batch in batches for t in batch.column("text").to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((field.weights, field.moves))], pa.binary())], ["field"])

    # The sample is bounded, so one task fits the field; the driver holds nothing but its weights.
    found = sample.select("text").repartition(1).mapInArrow(run, "field binary").collect()
    return Field(*pickle.loads(bytes(found[0][0]))) if found else Field.nothing()


def _has_long_hex(column: pa.Array) -> np.ndarray:
    """Of each text: whether a long hex run lies in it or reaches it. By bytes, all texts at once."""
    data, starts = text_bytes(column)
    if not len(data):
        return np.zeros(len(column), bool)
    gaps = np.concatenate([[-1], np.flatnonzero(~_IS_HEX[data]), [len(data)]])
    long = np.flatnonzero(np.diff(gaps) > LEAST["hex"])
    change = np.zeros(len(column) + 1, np.int64)
    np.add.at(change, np.searchsorted(starts, gaps[long] + 1, "right") - 1, 1)
    np.add.at(change, np.searchsorted(starts, gaps[long + 1] - 1, "right"), -1)
    return np.cumsum(change)[:-1] > 0


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", field: Field | None = None) -> DataFrame:
    """One row per document: doc_id and spans, an array of (start, end, kind, value)."""
    source = pick(docs, doc_id=id_col, text=text_col)
    model = field or learn(source)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.moves))
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("value", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Field(*shared.value)
        for batch in slices(batches, limit=TOGETHER):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            added = tagger.spans_of(texts)
            found = []
            for text, hexes, more in zip(texts, _has_long_hex(batch.column("text")), added, strict=True):
                spans = all_spans(text, more, bool(hexes))
                found.append([{"start": s, "end": e, "kind": k, "value": text[s:e]} for s, e, k in spans])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(span))], ["doc_id", "spans"])

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, spans array<struct<start:bigint,end:bigint,kind:string,value:string>>")


def all_spans(text: str, added: list[Span], hexes: bool = True) -> list[Span]:
    """Base spans and those that the field adds beside them."""
    found = base_spans(text) if hexes else _words_only(text)
    return sorted(found + [x for x in added if not any(x[0] < b[1] and b[0] < x[1] for b in found)], key=_order)


def _words_only(text: str) -> list[Span]:
    """Base spans of a text that has no long hex run."""
    low = text.lower()
    if "AKIA" in text or any(word in low for word in ("password", "passwd", "secret", "token", "api")):
        return base_spans(text)
    return []


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts per kind, a digest of the base spans, and all spans as text."""
    found = scan(docs, id_col, text_col)
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(text(F.filter("spans", lambda x: x["kind"] != "crf")), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )


def sha256_of(spans: list[Span]) -> str:
    return hashlib.sha256(written(spans).encode()).hexdigest()
