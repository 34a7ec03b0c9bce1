"""Periodic runs, alignment and line dedup against brute force: nulls, empty and long texts, ties, repeats, clashing names."""

import collections
import hashlib
import random
import re
import zlib

import pytest

from stayline.llm import alignment, line_dedup, periodic_runs, queries

WORDS = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, TEXT string, text string, key string, block long, score double"


def make(spark, rows, parts=3):
    """Documents with extra columns whose names clash with those that operators use."""
    df = spark.createDataFrame([(i, "x", t, "k", 7, 0.5) for i, t in rows], SCHEMA)
    return df.repartition(parts) if rows else df


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- periodic runs -----------------------------------------------------------


def all_runs(words):
    """Every stretch by definition: for each period, maximal stretches of words that equal those a period on."""
    found = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            # The first found has the smallest period.
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def kept_words(words, runs):
    return [w for k, w in enumerate(words) if not any(s + q <= k < s + n for s, n, q in runs)]


def random_texts():
    rng = random.Random(11)
    texts = []
    for _ in range(400):
        letters = rng.choice(["ab", "abc", "abcdefgh"])
        words = [rng.choice(letters) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.6:
            part = [rng.choice(letters) for _ in range(rng.randint(1, 25))]
            at = rng.randint(0, len(words))
            words[at:at] = part * rng.randint(3, 9) + part[: rng.randint(0, len(part))]
        texts.append(words)
    # Periods in which every short gram stands twice, and periods of periods.
    texts.append((list("aaaaaab") + list("aaaaaaab")) * 6)
    texts.append(((["a"] * 9 + ["b"]) * 5 + ["c"]) * 5)
    texts += [["x"] * n for n in (5, 6, 7, 1000)]
    return texts


def test_runs_of():
    texts = random_texts()
    got = periodic_runs.runs_of([[w.encode() for w in words] for words in texts])
    for words, runs in zip(texts, got, strict=True):
        assert runs == all_runs(words), " ".join(words)


def test_long_runs():
    rng = random.Random(2)
    part = [str(rng.randrange(10**6)) for _ in range(7_001)]
    words = [w.encode() for w in ["start", *part * 5, "end"]]
    assert periodic_runs.runs_of([words, [b"a"] * 200_000]) == [[(1, 5 * 7_001, 7_001)], [(0, 200_000, 1)]]


def test_runs_are_for_four_periods():
    with pytest.raises(ValueError, match="4 periods"):
        periodic_runs.runs_of([[b"a"]], times=3)


def test_find_runs(spark):
    rows = [(1, None), (2, ""), (None, "a " * 8), (4, "x\tla la\nla la la la y"), (4, "x\tla la\nla la la la y"), (5, "no run here"), (6, "  ")]
    got = sorted((tuple(r) for r in periodic_runs.find_runs(make(spark, rows)).collect()), key=str)
    want = []
    for i, text in rows:
        words = re.findall(WORDS, text or "")
        want.append((i, len(words), all_runs(words), " ".join(kept_words(words, all_runs(words)))))
    assert [(i, n, [tuple(r) for r in runs], left) for i, n, runs, left in got] == sorted(want, key=str)


def planted(i, words):
    h = zlib.crc32(str(i).encode())
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (k - a) % p] if k >= a else words[k] for k in range(n)]


def test_periodic_runs_query(spark, tmp_path):
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice("abcdefghij") for _ in range(rng.randint(0, 90)))) for k in range(300)]
    rows += [(301, None), (302, ""), (303, " \n ")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    changed = 0
    for i, text in rows:
        words = planted(i, re.findall(WORDS, text or ""))
        changed += words != re.findall(WORDS, text or "")
        runs, r = all_runs(words), got[i]
        assert r.n_runs == len(runs)
        best = sorted(runs, key=lambda x: (-x[1], x[0], x[2]))[0] if runs else (None, None, None)
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r.collapsed_sha256 == sha(" ".join(kept_words(words, runs)))
    assert changed > 10


def test_no_rows(spark):
    none = make(spark, [])
    assert periodic_runs.find_runs(none).collect() == periodic_runs.digest(none).collect() == []
    assert alignment.link_figures(none, *alignment.models()).collect() == alignment.alignments(none, *alignment.models()).collect() == []
    assert line_dedup.deduplicate_lines(none).collect() == line_dedup.digest(none).collect() == []


# --- alignment ---------------------------------------------------------------


class Tokenizers:
    """The plainest reading: the tokenizers as the libraries give them."""

    def __init__(self):
        import public_tokenizers
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        same = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.byte = {chr(b): b for b in same}
        self.byte |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in same)}

    def groups(self, text):
        if not text:
            return []
        a = self.a.encode(" " + text, add_special_tokens=False)
        b = self.b.encode(text)
        of_a = [bytes(self.byte[c] for c in t) for t in a.tokens]
        of_b = []
        for i in b:
            piece = self.b.id_to_piece(i)
            of_b.append(bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode())
        if not b"".join(of_a) == b"".join(of_b) == (" " + text).encode():
            return []
        found, i, j = [], 0, 0
        while i < len(of_a):
            k, m = i, j
            size_a, size_b = len(of_a[i]), len(of_b[j])
            while size_a != size_b:
                if size_a < size_b:
                    k += 1
                    size_a += len(of_a[k])
                else:
                    m += 1
                    size_b += len(of_b[m])
            found.append((a.ids[i : k + 1], b[j : m + 1]))
            i, j = k + 1, m + 1
        return found


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    words = ["hyperbolic", "naïve", "日本語", "the", "cat", "<|endoftext|>", "<s>", "</s>", "don't", "1234567", "\t", "\n\n", "🙂", "ﬁne", "zażółć", "  ", "é", "\x00", "----------", "_____"]
    out = [(1, None), (2, ""), (3, " "), (4, "▁ is no space"), (5, "<unk><0x41>"), (5, "<unk><0x41>"), (None, "a null id"), (6, "_" * 5000), (7, "\r\n"), (8, "-" * 9 + "=" * 41)]
    out += [(k, rng.choice(["", " "]).join(rng.choice(words) for _ in range(rng.randint(1, 80)))) for k in range(20, 90)]
    return out


def test_alignment(spark, texts):
    plain = Tokenizers()
    groups = [plain.groups(t) for _, t in texts]
    links = [[(x, y) for a, b in g for x in a for y in b] for g in groups]
    count = collections.Counter(p for x in links for p in set(x))
    highest = collections.defaultdict(int)
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    want = []
    for (i, _), g, x in zip(texts, groups, links, strict=True):
        listed = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        best, total = sum(count[p] == highest[p[0]] for p in x), sum(count[p] for p in x)
        want.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(x), best, total, sha(listed) if g else ""))
    assert max(len(a) * len(b) for g in groups for a, b in g) > alignment.WIDE
    docs = make(spark, texts)
    for block_pairs in (1, 1 << 21):
        got = alignment.link_figures(docs, *alignment.models(), block_pairs=block_pairs).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    got = alignment.alignments(docs, *alignment.models()).collect()
    assert sorted((str(r.doc_id), sha(r.groups) if r.groups else "", r.n_links) for r in got) == sorted((str(w[0]), w[7], w[4]) for w in want)


def test_pair_counts(spark):
    docs = make(spark, [(k, "the cat the cat") for k in range(5)] + [(9, "the")])
    written = alignment.blocks(docs, *alignment.models(), block_pairs=2)
    counts = alignment.pair_counts(written, 32_000).collect()
    assert sorted(r.documents for r in counts) == [5, 6] and all(r.best for r in counts)


def test_slow_encoder_gives_the_same(texts):
    model_a, model_b = alignment.models()
    left = alignment.Left(model_a)
    some = [t for _, t in texts if t]
    quick = left.encode(some)
    left.encoder.quick = None
    assert [x.tolist() for x in left.encode(some)] == [x.tolist() for x in quick]


# --- lines -------------------------------------------------------------------


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})


@pytest.fixture(scope="module")
def lined():
    rng = random.Random(8)
    common = ["All Rights reserved", "ÄÖ über", "x", "日本", "\x0b", "é"]
    rows = [(1, None), (2, ""), (3, "\n\n"), (None, "x\nalone"), (None, "X \nother"), (4, "same\nrow\nx"), (4, "same\nrow\nx")]
    for k in range(10, 70):
        lines = [f"line {rng.randrange(400)}" for _ in range(rng.randint(0, 30))]
        lines += [rng.choice(["", " ", "\t"]) + rng.choice([str.upper, str.lower, str])(rng.choice(common)) + rng.choice(["", "\r"]) for _ in range(rng.randint(0, 3))]
        rng.shuffle(lines)
        rows.append((k, "\n".join(lines)))
    return rows


def dropped(rows, least, length, keep):
    held = collections.defaultdict(list)
    for k, (i, t) in enumerate(rows):
        for x in set(map(key, (t or "").split("\n"))):
            if len(x) >= length:
                held[x].append(((i is None, i or 0), k))
    gone = {x: min(at)[0] if keep == "first" else None for x, at in held.items() if len(at) >= least}
    out = []
    for i, t in rows:
        left, seen = [], set()
        lines = (t or "").split("\n")
        for line in lines:
            x = key(line)
            if x in gone:
                if gone[x] != (i is None, i or 0) or x in seen:
                    continue
                seen.add(x)
            left.append(line)
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return out


@pytest.mark.parametrize("sent_bytes", [0, 1 << 20])
@pytest.mark.parametrize("least, length, keep", [(10, 1, "none"), (2, 3, "none"), (3, 1, "first")])
def test_lines(spark, lined, least, length, keep, sent_bytes):
    # Of two null ids nothing says which is first, so they are not compared for that.
    rows = lined if keep == "none" else [r for r in lined if r[0] is not None]
    got = line_dedup.deduplicate_lines(make(spark, rows), least=least, length=length, keep=keep, sent_bytes=sent_bytes).collect()
    want = dropped(rows, least, length, keep)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(w[2] for w in want) > 20


def test_full_filters_change_nothing(spark, lined):
    full = line_dedup.deduplicate_lines(make(spark, lined, 7), least=10, keep="none", most_bits=128).collect()
    assert sorted(map(tuple, full), key=str) == sorted(dropped(lined, 10, 1, "none"), key=str)


def test_filters_know_all_that_came_twice():
    import numpy as np

    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 1 << 63, 3000).astype(np.uint64) for _ in range(5)]
    shared = parts[0][:100]
    parts[3][:100] = shared
    parts[4][50:60] = parts[4][:10]
    filters = [line_dedup.Filters(1 << 17) for _ in parts]
    for one, part in zip(filters, parts, strict=True):
        one.add(part[:60])
        one.add(part[60:])
    whole = line_dedup.Filters(1 << 17)
    once, whole.twice = line_dedup.merged([(f.once, f.twice) for f in filters])
    assert whole.suspects(shared).all() and whole.suspects(parts[4][:10]).all()
    assert whole.suspects(np.concatenate([parts[1], parts[2]])).mean() < 0.2


def test_code_points():
    assert line_dedup.code_points("日本é".encode()) == 3
    assert line_dedup.keys_of("日本é\nab".encode(), 3) == ["日本é".encode()]
