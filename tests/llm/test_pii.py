import hashlib
import math
import random
import re

import pytest
from helpers import by_id, clashing, documents
from pyspark.sql import functions as F

from pairloom.llm import pii


def plain(text):
    """The base spans by one regular expression each, failing matches dropped."""
    def luhn(d):
        return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0

    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub(r"\D", "", m.group())) <= 15]
    return out


def test_base_spans_equal_plain_patterns():
    draw = random.Random(1)
    parts = ["a", "b.c", "@", "x@y.z", "@@", ".", "..", "-", " ", "+", "1", "12", "255", "256", "0007", "1.2.3.4", "4539148803436467", "4539 1488 0343 6467", "(", ")", "+1 (959) 555-1500", "é", "😀", "%", "\n"]
    for _ in range(6000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))
        assert pii.base_spans(text) == plain(text), text


def windows():
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdehinorst") for _ in range(draw.randint(2, 8)))
    out = []
    for i in range(160):
        datum = [f"{word()}.{draw.randint(1, 99)}@mail{draw.randint(1, 9)}.example.com", f"+1 ({draw.randint(200, 999)}) 555-{draw.randint(1000, 9999)}",
                 ".".join(str(draw.randint(1, 250)) for _ in range(4)), "4539148803436467", f"version {draw.randint(1, 9)}.{draw.randint(0, 9)}", f"key {draw.getrandbits(80):x}"][i % 6]
        out.append(f"{word()} {word()} {datum} {word()} {word()}")
    return out


@pytest.fixture(scope="module")
def weights():
    return pii.train(windows())


def found(text, weights):
    return [(k, text[a:b]) for k, a, b in pii.added_spans(text, pii.base_spans(text), weights)]


def test_other_writings_are_found(weights):
    assert found("write to bob.smith [at] mail dot example dot com now", weights) == [("email", "bob.smith [at] mail dot example dot com")]
    assert found("call (212) 555-1234 today", weights) == [("phone", "(212) 555-1234")]
    assert found("seen at 10[.]20[.]3[.]77 then", weights) == [("ip", "10[.]20[.]3[.]77")]


def test_plain_numbers_are_left_alone(weights):
    for text in ("in 2019 there were 12345 items", "version 2.0 of 10.5", "key 7c529a94f5d1c3f6a960", "meet at the point, a dot on the map", "no digits here"):
        assert found(text, weights) == []


def test_gradient_by_differences(weights):
    text, gold = pii.examples(windows())[1]
    stretch = pii._Stretch(text, 0, len(text))
    some = {f: 0.1 for *_, fs in stretch.segments for f in fs[:2]}

    def likelihood(w):
        n = len(stretch.tokens)
        total, best = [0.0] + [-math.inf] * n, 0.0
        for j in range(1, n + 1):
            total[j] = total[j - 1]
            for i, k, kind, fs in stretch.segments:
                if k == j:
                    total[j] = pii._log_add(total[j], total[i] + pii._score(w, fs))
        for i, k, kind, fs in stretch.segments:
            if (kind, stretch.tokens[i][0], stretch.tokens[k - 1][1]) in gold:
                best += pii._score(w, fs)
        return best - total[n]

    grads = pii._gradient(stretch, gold, some)
    for f in list(grads)[:12]:
        up, down = dict(some), dict(some)
        up[f], down[f] = some.get(f, 0) + 1e-4, some.get(f, 0) - 1e-4
        assert grads[f] == pytest.approx((likelihood(up) - likelihood(down)) / 2e-4, abs=1e-3)


def test_dynamic_programme_equals_all_cuts(weights):
    text = "ab 1.22.3.44 [at] x dot com 555-123-4567"
    stretch = pii._Stretch(text, 0, len(text))

    def best(at):
        if at == len(stretch.tokens):
            return 0.0
        return max([best(at + 1)] + [pii._score(weights, fs) + best(j) for i, j, _, fs in stretch.segments if i == at])

    places = {a: i for i, (a, _) in enumerate(stretch.tokens)}
    ends = {b: i + 1 for i, (_, b) in enumerate(stretch.tokens)}
    score = sum(max(pii._score(weights, fs) for i, j, kind, fs in stretch.segments if (i, j, kind) == (places[a], ends[b], k)) for k, a, b in pii.best_segments(stretch, weights))
    assert score == pytest.approx(best(0))


def test_documents(spark):
    texts = [(i, w) for i, w in enumerate(windows())] + [(500, None), (501, ""), (502, "9" * 40_000), (503, "a@b.c " * 3000), (504, "1 " * 20_000), (500, None)]
    got = by_id(pii.find(clashing(documents(spark, texts)).repartition(3)))
    for doc_id, text in texts:
        base = plain(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        counts = tuple(sum(k == kind for k, *_ in base) for kind in pii.KINDS)
        assert got[doc_id][:5] == counts + (hashlib.sha256(joined.encode()).hexdigest(),)
        assert set(joined.split(",")) - {""} <= set(got[doc_id][5].split(","))
    assert pii.find(documents(spark, [])).count() == 0


def test_masking(spark):
    docs = documents(spark, [(1, "to a.b@c.example.org, +1 (959) 555-1500."), (2, None), (3, "nothing")])
    got = {r.doc_id: r.text for r in docs.withColumn("text", pii.mask_column(docs, F.col("text"))).collect()}
    assert got == {1: "to [email], [phone].", 2: None, 3: "nothing"}


def test_long_texts_take_time_in_proportion():
    """Addresses and other numbers in turn: every token near a span, in one stretch."""
    import time
    weights = pii.train(["call 555 0100 now", "mail me a.b@example.com please", "at 10.0.0.1 or 4111 1111 1111 1111 there"] * 3, epochs=2)
    took = []
    for n in (1500, 6000):
        text = "".join(f"a{i}@example.com and {i} 1234 55 or " for i in range(n))
        begun = time.process_time()
        found = pii.added_spans(text, pii.base_spans(text), weights)
        took.append(time.process_time() - begun)
        assert all(not (a < y and x < b) for _, a, b in found for _, x, y in pii.base_spans(text)[:20])
    assert took[1] < 8 * took[0] + 0.5


def test_five_megabytes_of_spans_and_numbers():
    text = "".join(f"a{i}@example.com {i} 12 and words in between that hold no number at all, so " for i in range(62_000))
    assert len(text) > 5_000_000
    base = pii.base_spans(text)
    pii.added_spans(text, base, {"ip:bias": -1.0, "card:bias": -1.0, "phone:bias": -1.0, "email:bias": -1.0})
    assert sum(k == "email" for k, *_ in base) == 62_000


def test_merged_places_and_overlaps():
    spans = [(0, 10), (2, 4), (10, 12), (20, 25)]
    assert pii.merged(spans) == [(0, 12), (20, 25)]
    tokens = [(i, i + 2) for i in range(0, 30, 2)]
    assert pii._overlaps(tokens, pii.merged(spans)) == [any(s < b and a < e for a, b in spans) for s, e in tokens]
