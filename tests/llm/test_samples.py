"""What models learn from is bounded, also where ids are null or repeated; and the toxicity stage keeps clean rows."""

import random
import tracemalloc

import pytest
from pyspark.sql import functions as F

from stayline.llm import common, language_id, toxicity

WORDS = {"aa": ["alor", "belim", "carup", "dosen"], "bb": ["xik", "yopp", "zwen", "quat"]}


@pytest.fixture(scope="module")
def crowded(spark):
    """5,000 rows with a null id, 5,000 of one id, 5,000 equal rows and a few others."""
    text = lambda lang, word: F.concat_ws(" ", F.lit(" ".join(WORDS[lang])), F.concat(F.lit(word), F.col("id").cast("string")))
    rows = spark.range(5000)
    parts = [
        rows.select(F.lit(None).cast("long").alias("doc_id"), text("aa", "n").alias("text"), F.lit("aa").alias("lang")),
        rows.select(F.lit(7).cast("long"), text("aa", "h"), F.lit("aa")),
        rows.select(F.lit(8).cast("long"), F.lit("alor alor belim"), F.lit("aa")),
        rows.limit(300).select("id", text("bb", "b"), F.lit("bb")),
        rows.limit(5).select("id", F.lit(None).cast("string"), F.lit("bb")),
        rows.limit(5).select("id", text("bb", "z"), F.lit(None).cast("string")),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole.repartition(5).cache()


def test_language_sample_is_bounded(crowded):
    found = language_id.sampled(crowded)
    counts = {r.lang: r["count"] for r in found.groupBy("lang").count().collect()}
    assert counts["aa"] == language_id.SAMPLE_PER_LANGUAGE and counts["bb"] == 300
    assert found.distinct().count() == found.count()
    again = language_id.sampled(crowded.repartition(3))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, again.collect()))


def test_language_sample_is_bounded_in_bytes(crowded):
    found = language_id.sampled(crowded, most_bytes=2000)
    sizes = {r.lang: r.n for r in found.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    assert all(1800 < n <= 2000 for n in sizes.values()) and len(sizes) == 2
    assert language_id.sampled(crowded, most_bytes=16).count() == 0


def test_languages_are_told_apart_where_ids_are_null(crowded):
    got = language_id.identify(crowded).groupBy("lang_pred").count().collect()
    assert {r.lang_pred: r["count"] for r in got} == {"aa": 15_000, "bb": 305, "und": 5}


def test_toxicity_learns_from_an_id_once(spark, monkeypatch):
    docs = spark.range(3000).select(F.lit(5).cast("long").alias("doc_id"), F.concat(F.lit("w"), F.col("id").cast("string")).alias("text"))
    docs = docs.union(spark.createDataFrame([(6, "other words"), (9, None)], "doc_id long, text string"))
    labels = spark.createDataFrame([(5, 1), (5, 1), (5, 0), (6, 0), (9, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    seen = []

    real = type(docs).repartition
    monkeypatch.setattr(type(docs), "repartition", lambda self, *a: (seen.append(self.collect()), real(self, *a))[1])
    toxicity.learn(docs, labels)
    monkeypatch.undo()
    assert sorted((r.doc_id, r.toxic) for r in seen[0]) == [(5, 0), (5, 1), (6, 0), (9, 0)]
    assert len({r.text for r in seen[0] if r.doc_id == 5}) == 1


def test_keep_clean(spark):
    rng = random.Random(3)
    clean = [" ".join(rng.choice(["kind", "calm", "plain", "green", "tree"]) for _ in range(rng.randint(20, 120))) for _ in range(120)]
    bad = []
    for _ in range(60):
        words = rng.choice(clean).split()
        at = rng.randrange(len(words))
        words[at:at] = ["vile", "grubbet", "snark", "vile"]
        bad.append(" ".join(words))
    rows = [(k, t, 0) for k, t in enumerate(clean)] + [(1000 + k, t, 1) for k, t in enumerate(bad)]
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    odd = [(5000, None), (None, "calm tree"), (5001, ""), (7, clean[7])]
    docs = spark.createDataFrame([(i, t, "s") for i, t, _ in rows] + [(i, t, "s") for i, t in odd], "doc_id long, text string, score string").repartition(3)
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns
    left = [(r.doc_id, r.text) for r in kept.collect()]
    assert all(x in left for x in odd)
    assert sum(i is not None and i < 1000 for i, _ in left) >= 119 and sum(i is not None and 1000 <= i < 2000 for i, _ in left) <= 3
    assert toxicity.keep_clean(docs.limit(0), labels).collect() == []


def test_toxicity_is_fitted_in_little_memory(monkeypatch):
    rng = random.Random(5)
    known = [f"word{i}" for i in range(3000)]
    texts = [" ".join(rng.choices(known, k=15_000)) + (" vile" if i % 2 else "") for i in range(80)]
    assert sum(map(len, texts)) > 9e6
    monkeypatch.setattr(toxicity, "STEPS", 1)
    monkeypatch.setattr(common, "BASES", tuple(common.Powers(x.base) for x in common.BASES))
    tracemalloc.start()
    try:
        net = toxicity.fit(texts, [i % 2 for i in range(80)], epochs=1)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(net.vocabulary) == 3001
    # Numbers of words take 5 MB here; sums over all the code points took more than 500.
    assert peak < 100e6
    assert sum(x.up.nbytes + x.down.nbytes for x in common.BASES) < 40 * common.HASHED


def test_words_are_hashed_alike_in_blocks(monkeypatch):
    texts = ["", "a", "bb \t ccc", "d" * 40, " e ", "ff gg hh ii jj kk", "\n\nbb"]
    for which in (0, 1):
        words = common.Words(texts, common.NOT_SPACE)
        whole = common.stretch_hashes(words.code, words.starts, words.ends, which)
        for size in (1, 5, 1000):
            monkeypatch.setattr(common, "HASHED", size)
            assert words.hashes(which).tolist() == whole.tolist()


def test_spelled_words_are_those_of_the_texts():
    texts = ["One two one", None, "", "two three", "x " * 700_000, "three four", "..."]
    words = toxicity.Spelled(texts)
    spelled = ["".join(map(chr, words.code[s:e])) for s, e in zip(words.starts, words.ends, strict=True)]
    got = [[spelled[n] for n in words.number[s:e]] for s, e in zip(words.first, words.first[1:])]
    assert got == [(t or "").lower().replace(".", "").split() for t in texts]
    assert list(toxicity.portions(["ab"] * 5, 4)) == [(0, 2), (2, 4), (4, 5)] and list(toxicity.portions([])) == []
