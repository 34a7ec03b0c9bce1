"""Benchmark overlaps against the definition: every diagonal under every mask, every stretch of it."""

import random

import pytest

from stayline.llm import decontaminate as D


def best_of(doc, item, masks):
    """Equal words, start and end of the best overlap; diagonals are those that a mask fits somewhere."""
    best = None
    for diagonal in range(1 - len(item), len(doc)):
        places = range(max(0, diagonal), min(len(doc), len(item) + diagonal))
        same = {p: doc[p] == item[p - diagonal] for p in places}
        if not any(all(same.get(p + k, False) for k, bit in enumerate(m) if bit == "1") and p + len(m) - 1 in same for m in masks for p in places):
            continue
        stretches = [(sum(1 if same[p] else -D.SUBSTITUTION for p in range(s, e)), -e, s) for s in places for e in range(s + 1, places.stop + 1)]
        _, end, start = max(stretches)
        end = -end
        equal = sum(same[p] for p in range(start, end))
        if sum(same.values()) > equal and sum(same.values()) >= D.SHARE * len(item):
            there = [p for p in places if same[p]]
            start, end, equal = there[0], there[-1] + 1, len(there)
        if (equal >= D.LEAST_WORDS or equal >= D.SHARE * len(item)) and (best is None or equal > best[0]):
            best = (equal, start, end)
    return best


@pytest.mark.parametrize("sent_words", [0, D.SENT_WORDS])
def test_overlaps_by_definition(spark, sent_words):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(60)]
    items = [(k, [rng.choice(words) for _ in range(n)]) for k, n in enumerate((5, 7, 10, 11, 13, 15, 17, 22, 30, 41, 41))]
    docs = []
    for k in range(120):
        item = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, len(item) // 3)):
            item[rng.randrange(len(item))] = rng.choice(words)
        start = rng.randint(0, len(item) // 2) if rng.random() < 0.3 else 0
        docs.append((k, [*(rng.choice(words) for _ in range(rng.randint(0, 12))), *item[start:], *(rng.choice(words) for _ in range(rng.randint(0, 12)))]))
    docs += [(500, items[9][1]), (500, items[9][1])]
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = sorted(tuple(r) for r in D.overlaps(frame, benchmark, sent_words=sent_words).collect())
    want = []
    for i, doc in docs:
        for j, item in items:
            masks = [*D.MASKS, *(D.short_masks(len(item)) if len(item) < len(D.MASKS[-1]) else ())]
            best = best_of(doc, item, masks)
            if best:
                want.append((i, j, *best, len(item)))
    assert got == sorted(want) and len(want) > 60
    left = D.drop_contaminated(frame, benchmark, sent_words=sent_words)
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, _ in docs if i not in {w[0] for w in want})
