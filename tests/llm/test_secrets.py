"""What the field adds: kinds of secrets that it was not shown, and no more; the base spans by the plainest reading."""

import random
import re

import pytest

from stayline.llm import secret_scan as S

ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def plain_base(text):
    """The definition, without a clever pattern: keyword by keyword, character by character."""
    found, at = [], 0
    while at < len(text):
        best = None
        for word in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if "".join(c.lower() if c in ALNUM else c for c in text[at : at + len(word)]) == word:
                m = re.compile(r"""["']?\x20*[:=]\x20*["']?""").match(text, at + len(word))
                if m:
                    end = m.end()
                    while end < len(text) and text[end] in ALNUM + "+/_.=-":
                        end += 1
                    # Signs may belong to the value as well: the shortest beginning that leaves one.
                    if end > m.end():
                        best = (at, end, end - m.end())
                        break
        if best:
            if best[2] >= 6:
                found.append((best[0], best[1], "assign"))
            at = best[1]
        else:
            at += 1
    for kind, letters, least, head in (("access", ALNUM[:26] + ALNUM[52:], 20, "AKIA"), ("hex", "0123456789abcdef", 24, "")):
        at = 0
        while at < len(text):
            if text[at : at + len(head)] == head and text[at] in letters:
                end = at + len(head)
                while end < len(text) and text[end] in letters:
                    end += 1
                if end > at + len(head):
                    if end - at >= least:
                        found.append((at, end, kind))
                    at = end
                    continue
            at += 1
    return sorted(found, key=lambda x: (x[0], ("assign", "access", "hex").index(x[2])))


def test_base_spans_by_definition():
    rng = random.Random(12)
    parts = ["password", "PassWd", "secret", "TOKEN", "api_key", "ApiKey", "=", ":", " ", "  ", "'", '"', "\n", "é", "abc", "x1y2z3", "AKIA", "AKIA" + "Q7" * 9, "0f" * 12, "deadbeef", "A", "-", "/+", "ſ"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert S.base_spans(text) == plain_base(text), text


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(21)
    words = ["".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9))) for _ in range(800)]
    made = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    out = []
    for k in range(900):
        text = [rng.choice(words) for _ in range(rng.randint(40, 160))]
        extra = [f"mail{k % 9}.example.com", "555-0{}-1234".format(k % 90), "2021-03-04T10:20:30", "https://a.example.com/page/12"][k % 4]
        text.insert(rng.randrange(len(text)), extra)
        if k % 9 == 0:
            text.insert(rng.randrange(len(text)), f"token = \"{made('0123456789abcdef', 40)}\"")
        if k % 9 == 4:
            text.insert(rng.randrange(len(text)), made("0123456789abcdef", 32))
        out.append(" ".join(text))
    return out


def found_in(field, text):
    return [text[s:e] for s, e, _ in field.spans(text)]


def test_a_kind_that_was_held_out_is_found(texts):
    field = S.fit(texts[:600], without_kinds=("hex",))
    held = [(t, text[s:e]) for t, text in enumerate(texts[600:]) for s, e, kind in S.base_spans(text) if kind == "hex"]
    assert len(held) > 50
    hits = sum(any(value in x for x in found_in(field, texts[600 + t])) for t, value in held)
    assert hits / len(held) > 0.7


def test_kinds_without_a_pattern_are_found_and_prose_is_left_alone(texts):
    field = S.fit(texts[:600])
    rng = random.Random(5)
    kinds = ["ghp_" + "".join(rng.choice(ALNUM) for _ in range(36)), "Bearer " + "".join(rng.choice(ALNUM) for _ in range(24)), "private key = " + "".join(rng.choice(ALNUM) for _ in range(20))]
    for secret in kinds:
        hits = 0
        for text in texts[600:650]:
            words = text.split(" ")
            at = rng.randrange(len(words))
            hits += any(secret.split()[-1] in x for x in found_in(field, " ".join([*words[:at], secret, *words[at:]])))
        assert hits >= 45, secret
    added = [x for t in texts[600:] for x in S.all_spans(t, field.spans(t)) if x[2] == "crf"]
    assert len(added) <= 3


def test_odd_samples(spark):
    rows = [(None, None), (None, ""), (7, "token = abcdef0123456789abcdef01")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = S.digest(docs).collect()
    assert len(got) == len(rows) and sum(r.n_assign for r in got) == 40
    assert S.digest(docs.limit(0)).collect() == []
