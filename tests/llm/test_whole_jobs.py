"""Places where an operator once did less than the whole job."""

import itertools
import math
import random

import numpy as np

from stayline.llm import decontaminate, packing, secret_scan


def test_secrets_of_letters_only_are_found():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    plain = ["today we go home", "they came here to see it", "nothing of note was said"]
    texts = [f"{rng.choice(plain)} then set password : {word()} and {rng.choice(plain)}" for _ in range(80)] + plain * 10
    field = secret_scan.fit(texts)
    text = "today we go home then set passphrase : letmein and nothing of note was said"
    assert [text[s:e] for s, e, _ in field.spans(text)] == ["passphrase : letmein"]
    chain = secret_scan.chains("set password = letmein now")[0]
    assert secret_scan.labels(chain, [secret_scan.base_spans("set password = letmein now")]).tolist() == [0, 1, 2, 2, 0]


def test_joined_cuts_give_the_best_path():
    rng = np.random.default_rng(2)
    for n in (1, 255, 256, 257, 1000):
        scores, moves = rng.normal(size=(n, 3)), rng.normal(size=(3, 3)) + secret_scan.ALLOWED
        best, back = scores[0] + moves[0], []
        for row in scores[1:]:
            paths = best[:, None] + moves
            back.append(paths.argmax(0))
            best = paths.max(0) + row
        tags = [int((best + moves[:, 0]).argmax())]
        for step in reversed(back):
            tags.append(int(step[tags[-1]]))
        assert secret_scan.viterbi(scores, moves).tolist() == tags[::-1]


def test_texts_of_a_batch_are_tagged_as_alone():
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["token", "=", '"', "a1b2c3d4e5", "word", "é", "x:y", " "]) for _ in range(rng.randint(0, 60))) for _ in range(40)] + ["", "\n"]
    field = secret_scan.Field(np.random.default_rng(3).normal(size=(secret_scan.FEATURES, 3)), np.zeros((3, 3)))
    assert field.spans_of(texts) == [field.spans(t) for t in texts]


def test_quick_feature_numbers_are_those_of_the_shape():
    rng = random.Random(5)
    known = secret_scan.Numbers()
    for _ in range(2000):
        token = "".join(rng.choice("abcfxyzABZ0129+/_.=-") for _ in range(rng.randint(1, 20)))
        low = token.lower()
        assert known[token] == secret_scan._numbers((*secret_scan.shape(token), f"near0{low}", f"near1{low}", f"next{low}"))
    assert known["é"] == secret_scan._numbers((*secret_scan.shape("é"), "near0é", "near1é", "nexté"))


def test_short_tails_fill_windows_by_their_exact_length():
    histogram = np.zeros(packing.WINDOW + 1, np.int64)
    histogram[9] = 100_000
    planned = packing.plan(histogram, packing.STEP)
    assert sum(often for _, often in planned) == -(-100_000 // (packing.WINDOW // 9))
    histogram[9], histogram[1] = 0, 5 * packing.WINDOW
    assert packing.plan(histogram, packing.STEP) == [((1,) * packing.WINDOW, 5)]


def test_room_left_by_rounding_is_used():
    rng = np.random.default_rng(4)
    histogram = np.bincount(rng.integers(100, packing.WINDOW, 20_000), minlength=packing.WINDOW + 1)
    histogram[1:20] += rng.integers(0, 3000, 19)
    used, sequences = np.zeros(packing.WINDOW + 1, int), 0
    for way, often in packing.plan(histogram, packing.STEP):
        assert sum(way) <= packing.WINDOW and list(way) == sorted(way, reverse=True)
        np.add.at(used, list(way), often)
        sequences += often
    assert (used == histogram).all()
    assert (histogram * np.arange(packing.WINDOW + 1)).sum() / (sequences * packing.WINDOW) > 0.995


def test_replaced_words_do_not_hide_short_items(spark):
    items = {n: [f"w{n}x{k}" for k in range(n)] for n in (4, 5, 7, 10, 12, 15, 18)}

    def changed(n, *places):
        return " ".join("other" if k in places else w for k, w in enumerate(items[n]))

    found = [(15, changed(15, 1, 13), 13), (18, changed(18, 1, 16), 16), (5, changed(5, 2), 4), (7, changed(7, 0), 6), (10, changed(10, 3, 6), 8), (12, changed(12, 2, 8), 10)]
    missed = [changed(5, 1, 3), changed(4), changed(10, 0, 4, 8)]
    texts = [f"before {t} after" for t in [x[1] for x in found] + missed]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()] + [(0, ""), (1, None)], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.n_words) for r in decontaminate.overlaps(docs, benchmark).collect())
    assert got == [(k, n, words) for k, (n, _, words) in enumerate(found)]


def test_own_masks_ignore_every_choice_of_words():
    for n in range(decontaminate.SHORTEST, len(decontaminate.MASKS[-1])):
        masks = decontaminate.short_masks(n)
        for gone in itertools.combinations(range(n), n - math.ceil(decontaminate.SHARE * n)):
            assert any(all(mask[k] == "0" for k in gone) for mask in masks)
        assert all(len(mask) == n and mask.count("1") >= 4 for mask in masks) and len(masks) <= 2 * n
