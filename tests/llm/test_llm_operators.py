"""Each operator against brute force on small fixtures: nulls, empty and long texts, ties, repeats, clashing names."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from stayline.llm import decontaminate as D
from stayline.llm import exact_dedup, jaccard_join, language_id, packing, queries, secret_scan, substring_dedup, suffix_dedup, toxicity, warc

SPACE = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, TEXT string, text string, spans string, lang string, score double"


def make(spark, rows, lang=None):
    """Documents with extra columns whose names clash with those that operators use."""
    full = [(i, "x", t, "s", lang[k] if lang else None, 0.5) for k, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(full, SCHEMA)
    return df.repartition(3) if rows else df


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdeghé") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage = prose(130), prose(70)
    out = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "two words"), (6, base), (7, base), (8, base.replace(" ", "  ")), (9, base + " more"), (10, base.upper())]
    for k in range(20):
        words = base.split()
        for _ in range(k % 5):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        out.append((20 + k, " ".join(words)))
        out.append((50 + k, prose(40) + " " + passage + "\n" + prose(30)))
        out.append((80 + k, prose(rng.randint(1, 300))))
    out += [(200, prose(20_000)), (201, "aa " * 900), (202, passage + " " + passage), (6, base), (None, base), (None, "lonely text of a null id")]
    rng.shuffle(out)
    return out


def last(value):
    return (value is None, value or 0)


def test_exact_dedup(spark, rows):
    got = exact_dedup.exact_groups(make(spark, rows)).collect()
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[re.sub(SPACE, " ", t or "")].append(i)
    assert len(got) == len(rows)
    by_text = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_text[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == min(ids, key=last)
    assert sum(r.kept for r in got) == len(groups)
    kept = exact_dedup.drop_exact_duplicates(make(spark, rows))
    assert kept.columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" double", "").split(", ")
    # Of equal texts, one row of the smallest id; also where the lists of what goes are joined by a shuffle.
    want = sorted((str(min(ids, key=last)), t) for t, ids in groups.items())
    for sent_rows in (0, 1 << 20):
        kept = exact_dedup.drop_exact_duplicates(make(spark, rows), sent_rows=sent_rows)
        assert sorted((str(r[0]), re.sub(SPACE, " ", r[2] or "")) for r in kept.collect()) == want


def test_quotient_filters_merge_without_loss():
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 1 << 12, 500).astype(np.uint64) << np.uint64(40) for _ in range(4)]
    filters = [exact_dedup.QuotientFilter.build(*np.unique(p, return_counts=True), 58) for p in parts]
    filters = [exact_dedup.QuotientFilter.from_bytes(f.to_bytes()) for f in filters]
    values, counts = exact_dedup.QuotientFilter.merged(filters, 58).entries()
    want = np.unique(np.concatenate(parts), return_counts=True)
    assert (values == want[0]).all() and (counts == want[1]).all()


def low(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def shingle_set(text, n=4):
    w = re.findall(WORDS, low(text))
    return frozenset(" ".join(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


@pytest.mark.parametrize("small", [24, 2])
def test_jaccard_join(spark, rows, small, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", small)  # 2: stars and pairs across components do the work
    monkeypatch.setattr(jaccard_join, "CHUNK", 7 if small == 2 else 2048)
    got = jaccard_join.near_groups(make(spark, rows)).collect()
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            same, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if sets[a] and sets[b] and 100 * same >= 85 * union:
                root[find(a)] = find(b)
    members = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        members[find(k)].append(i)
    want = sorted(((i, len(sets[k]), min(members[find(k)], key=last)) for k, (i, _) in enumerate(rows)), key=repr)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == want
    if small == 24:
        kept = jaccard_join.drop_near_duplicates(make(spark, rows))
        assert sorted(str(r[0]) for r in kept.collect()) == sorted(str(min(ids, key=last)) for ids in members.values())


def test_substring_dedup(spark, rows):
    window = 50
    first = {}
    for i, t in rows:
        w = re.findall(WORDS, t or "")
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, (True, 0)), last(i)) if key in first else last(i)
    want = []
    for i, t in rows:
        w = re.findall(WORDS, t or "")
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < last(i):
                gone[k : k + window] = [True] * window
        want.append((i, len(w), sum(gone), substring_dedup.sha256_of([x for x, g in zip(w, gone) if not g])))
    got = [tuple(r) for r in substring_dedup.digest(make(spark, rows)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("shard", [2048, 2])
def test_suffix_dedup(spark, rows, shard):
    length = 400
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(b[k : k + length] for _, b in texts for k in range(len(b) - length + 1))
    want = []
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        want.append((i, len(b), int(gone.sum()), np.frombuffer(b, np.uint8)[~gone].tobytes()))
    got = suffix_dedup.deduplicate(make(spark, rows), shard_stretches=shard)
    got = [(r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in got.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_suffix_arrays_and_common_prefixes():
    rng = np.random.default_rng(2)
    symbols = np.concatenate([rng.integers(0, 3, 300), np.zeros(90, int), [9]])
    order = suffix_dedup.suffix_array(symbols, 400)
    want = sorted(range(len(symbols)), key=lambda k: symbols[k:].tolist())
    assert order.tolist() == want
    shared = suffix_dedup.common_prefixes(symbols, order, 20, lanes=7)
    for k in range(1, len(want)):
        a, b = symbols[want[k - 1] :], symbols[want[k] :]
        n = next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert shared[k] == min(n, 20)


def test_packing(spark, rows):
    model = queries.packing_model()
    cut = packing.pieces(make(spark, rows), model)
    got = packing.pack(cut).collect()
    encoder = packing.Encoder(model)
    want = sorted(([*encoder.slow([t or ""])[0], 1] for _, t in rows), key=len)
    docs, sequences = collections.defaultdict(int), collections.defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        docs[r.doc_tokens] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sum(map(len, want)) == sum(docs.values())
    assert docs == {n: n * c for n, c in collections.Counter(map(len, want)).items()}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    long = sorted((r.start, bytes(r.ids)) for r in got if r.doc_tokens == len(want[-1]))
    assert np.frombuffer(b"".join(x for _, x in long), "<u4").tolist() == want[-1]


def test_plan_uses_every_tail_once():
    rng = np.random.default_rng(5)
    histogram = np.concatenate([[0], rng.integers(0, 400, 64)])
    used = np.zeros(65, int)
    room = 0
    for way, often in packing.plan(histogram):
        assert sum(way) <= 64
        np.add.at(used, list(way), often)
        room += 64 * often
    assert (used == histogram).all()
    assert (histogram * np.arange(65)).sum() / room > 0.9
    assert packing.plan(np.zeros(65, int)) == []


def test_nnls():
    a = np.random.default_rng(1).random((12, 30))
    x = packing.nnls(a, a @ np.maximum(0, np.random.default_rng(2).normal(size=30)))
    assert (x >= 0).all()
    assert np.abs(a @ x - a @ np.maximum(0, np.random.default_rng(2).normal(size=30))).max() < 1e-6


def test_warc(spark):
    payload = "<html>é" + "x" * 200
    rows = [(5, "http://a/é b", payload), (3, None, payload), (9, "u", payload), (3, "v", payload), (None, "w", payload), (7, "s", "short"), (8, "s", "short"), (10, None, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, HTML string").repartition(3)
    got = warc.round_trip(df).collect()
    assert sorted((last(r.page_id), r.url or "") for r in got) == sorted((last(i), u or "") for i, u, _ in rows)
    assert sum(r.record_type == "response" and r.payload_bytes > 100 for r in got) == 1
    for r in got:
        if r.record_type == "revisit":
            assert r.refers_to == 3 and r.payload is None and r.payload_digest == hashlib.sha256(payload.encode()).hexdigest()
        else:
            assert hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest


@pytest.mark.parametrize("at", [0, 5, 30, -3])
def test_broken_archives_are_errors(at):
    digest = hashlib.sha256(b"abc").hexdigest()
    data = bytearray(warc.archive([warc.record(1, "u", "response", None, digest, 3, b"abc")], b""))
    assert warc.parse(next(warc.frames(bytes(data))))["payload"] == b"abc"
    data[at] ^= 0xFF
    with pytest.raises((warc.Broken, UnicodeDecodeError)):
        [warc.parse(x) for x in warc.frames(bytes(data))]
    with pytest.raises(warc.Broken):
        warc.parse(warc.record(1, "u", "response", None, digest, 3, b"abcd"))


def test_secret_scan(spark):
    key = "AKIA" + "Q7" * 9
    texts = [None, "", "plain", f"é token = 'abc123' {key} " + "0f" * 14, "token=ab secret:token=xyz_99", "PassWord : \"aaaaaa", "toſen=abcdefg api_key=abcdef apikey:ghijkl"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(3, texts[3]), (None, texts[4])]
    got = secret_scan.digest(make(spark, rows)).collect()
    want = [(i, secret_scan.base_spans(t or "")) for i, t in rows]
    assert sorted((last(r.doc_id), r.base_sha256, r.n_assign, r.n_access, r.n_hex) for r in got) == sorted(
        (last(i), secret_scan.sha256_of(s), *[sum(x[2] == k for x in s) for k in ("assign", "access", "hex")]) for i, s in want
    )
    assert [x[2] for x in secret_scan.base_spans(texts[3])] == ["assign", "access", "hex"]
    # A value that is too short takes its place all the same.
    assert secret_scan.base_spans("token=token:abcdef") == []


def test_field_learns_shape_and_decodes_best_path():
    rng = random.Random(4)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    texts = [f"some words token = \"{hexes(40)}\" and call 555{rng.randint(1000000, 9999999)} today" for _ in range(120)]
    field = secret_scan.fit(texts)
    upper = hexes(40).upper()
    text = f"the key is {upper} call 5551234567 now"
    assert [text[s:e] for s, e, _ in field.spans(text)] == [upper]
    for chain in secret_scan.chains(text + " a1b2c3d4e5~f6g7h8i9j0"):
        scores, moves = field.scores(chain), field.moves + secret_scan.ALLOWED
        best = max(
            __import__("itertools").product(range(3), repeat=len(scores)),
            key=lambda tags: moves[0, tags[0]] + sum(scores[k, t] for k, t in enumerate(tags)) + sum(moves[a, b] for a, b in zip(tags, tags[1:])) + moves[tags[-1], 0],
        )
        assert field.decode(chain) == list(best)
    assert secret_scan.fit(["nothing here"]).spans(text) == []


def test_language_id(spark):
    texts = [("en", "the house and the garden"), ("de", "das haus und der garten"), ("fr", "la maison et le jardin")] * 5
    docs = make(spark, [(k, t) for k, (_, t) in enumerate(texts)] + [(90, None), (91, "123 !"), (None, "haus"), (90, "jardinier"), (93, "x")], [lang for lang, _ in texts] + [None] * 5)
    got = {(r.doc_id, r.lang_pred) for r in language_id.identify(docs).collect()}
    assert {(k, lang) for k, (lang, _) in enumerate(texts)} <= got
    assert {(90, "und"), (91, "und"), (None, "de"), (90, "fr")} <= got
    empty = language_id.identify(make(spark, [(1, "word")]))
    assert [r.lang_pred for r in empty.collect()] == ["und"]


def test_language_id_on_held_out_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.identify(df).join(df.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95


def test_toxicity_gradients_and_windows():
    owners, begins = toxicity.windows_of(np.array([0, 1, 32, 33, 200]))
    for k, n in enumerate([0, 1, 32, 33, 200]):
        covered = {i for s in begins[owners == k] for i in range(s, s + toxicity.WINDOW)}
        assert set(range(n)) <= covered and (owners == k).any()
    rng = np.random.default_rng(0)
    net = toxicity.Network.fresh(np.zeros(0, np.uint64), np.zeros(0, np.float32), rng)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    sent = rng.normal(size=(2, 9, 3 * toxicity.STATE))
    sent[:, 0, : toxicity.STATE] = -30
    ids = np.array([[1, 2], [3, 4], [5, 0]])
    y, weight = np.array([1.0, 0.0]), np.array([0.5, 0.5])

    def loss():
        z = net.run(sent.astype(np.float32), ids).astype(np.float64)
        return float((weight * (np.log1p(np.exp(z)) - y * z)).sum())

    by, _ = net.slopes(sent.astype(np.float32), ids, y, weight)
    for name in ("again", "look", "out", "level"):
        at = tuple(0 for _ in net.w[name].shape)
        net.w[name][at] += 1e-2
        up = loss()
        net.w[name][at] -= 2e-2
        down = loss()
        net.w[name][at] += 1e-2
        assert abs((up - down) / 2e-2 - by[name][at]) < 2e-3


def test_toxicity(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(200)]
    rows, labels = [], []
    for k in range(240):
        text = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        if k % 4 == 0:
            text[rng.randrange(len(text))] = "vilest"
        rows.append((k, " ".join(text)))
        labels.append((k, int(k % 4 == 0)))
    rows += [(900, None), (901, ""), (None, "vilest " + words[0]), (0, rows[0][1])]
    known = spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.score_held_out(make(spark, rows), known).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 240]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) / len(held) > 0.9
    none = toxicity.score_held_out(make(spark, rows[:3]), known.limit(0)).collect()
    assert all(r.score < 1e-6 for r in none)


def test_decontaminate(spark, rows):
    rng = random.Random(8)
    words = ["".join(rng.choice("lmnopqrstu") for _ in range(5)) for _ in range(400)]
    items = [(k, " ".join(rng.choice(words) for _ in range(30))) for k in range(6)] + [(7, "tiny one"), (8, None), (9, "just six words stand here together")]
    changed = items[1][1].split()
    changed[9], changed[22] = "zzz", "yyy"
    planted = [(1000, "before " + items[0][1].upper() + ", after"), (1001, "x " + " ".join(changed) + " y"), (1002, "well, Just six words: stand here together."), (1003, " ".join(items[2][1].split()[:9]))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = make(spark, rows + planted + planted[:1])
    for sent_words in (0, D.SENT_WORDS):
        got = sorted((r.doc_id, r.item_id, r.n_words) for r in D.overlaps(docs, benchmark, sent_words=sent_words).collect())
        assert got == [(1000, 0, 30), (1000, 0, 30), (1001, 1, 28), (1002, 9, 6)]
        kept = D.drop_contaminated(docs, benchmark, sent_words=sent_words)
        assert sorted((r[0], r[2]) for r in kept.collect() if r[0]) == sorted((i, t) for i, t in [*rows, planted[-1]] if i)
        assert kept.columns == docs.columns
    assert D.overlaps(docs, benchmark.limit(0)).count() == 0


def test_empty_tables(spark):
    docs = make(spark, [])
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    benchmark = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], T.StructType.fromDDL("page_id long, url string, html string"))
    for df in (
        exact_dedup.exact_groups(docs),
        jaccard_join.near_groups(docs),
        substring_dedup.digest(docs),
        suffix_dedup.digest(docs),
        packing.digest(docs, queries.packing_model()),
        warc.round_trip(pages),
        secret_scan.digest(docs),
        language_id.identify(docs),
        toxicity.score_held_out(docs, labels),
        D.overlaps(docs, benchmark),
    ):
        assert df.collect() == []
