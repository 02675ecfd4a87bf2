import random
import zlib

import numpy as np
import pytest
from helpers import clashing, documents

from pairloom.llm import language

SOUNDS = {"aa": ["ka", "to", "mi", "ra"], "bb": ["sch", "ung", "ein", "pf"], "cc": ["éau", "ç", "oi", "ent"]}


def spoken(lang, words, seed):
    draw = random.Random(f"{lang}{seed}")
    return " ".join("".join(draw.choice(SOUNDS[lang]) for _ in range(draw.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def net():
    return language.train([(spoken(k, 40, i).encode(), k) for k in SOUNDS for i in range(30)], steps=120)


def test_gradient_by_differences():
    net = language.ByteNetwork(["x", "y"], hidden=3)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    draw = np.random.default_rng(0)
    codes = draw.integers(0, 256, (5, 4)).astype(np.uint8)
    target, weight = np.array([0, 1, 1, 0]), draw.random((5, 4))
    _, grads = net.gradients(codes, target, weight)
    for name, at in (("hf", (1, 4)), ("hb", (2, 7)), ("cf", (1,)), ("xf", (int(codes[2, 1]), 5)), ("xb", (int(codes[3, 0]), 2)), ("out", (4, 1)), ("bias", (0,))):
        value = net.weights[name][at]
        sides = []
        for move in (1e-2, -1e-2):
            net.weights[name][at] = value + move
            sides.append(net.gradients(codes, target, weight)[0])
        net.weights[name][at] = value
        assert grads[name][at] == pytest.approx((sides[0] - sides[1]) / 2e-2, rel=0.05, abs=2e-4), name


def test_held_out_texts(net):
    texts = [(spoken(k, n, 1000 + i), k) for k in SOUNDS for i in range(20) for n in (8, 60)]
    found = language.label_texts(net, [t for t, _ in texts])
    assert np.mean([f[0] == k for f, (_, k) in zip(found, texts)]) > 0.95
    assert all(0 <= s <= 1 for _, s in found)


def test_batching_does_not_matter(net):
    texts = [spoken("aa", 300, 1), "", spoken("cc", 4, 3), spoken("bb", 30, 2), "12 34", spoken("aa", 9, 8)]
    together = language.label_texts(net, texts)
    alone = [language.label_texts(net, [t])[0] for t in texts]
    assert [a[0] for a in together] == [a[0] for a in alone]
    assert np.allclose([a[1] for a in together], [a[1] for a in alone], atol=1e-5)
    assert together[1] == together[4] == ("und", 0.0)


def test_every_position_has_a_label(net):
    text = spoken("cc", 80, 5)
    labels = language.label_positions(net, text)
    assert len(labels) == len(text.encode()) and labels.count("cc") > 0.8 * len(labels)


def test_documents(spark):
    rows = [(i, spoken(k, 30, i), k) for i, k in enumerate(list(SOUNDS) * 60)]
    odd = [(900, None, "aa"), (901, "", "aa"), (902, "123 ... 456", None), (903, "ka" * 60_000, None), (904, spoken("bb", 20, 7), None), (904, spoken("bb", 20, 7), None)]
    docs = clashing(documents(spark, rows + odd)).repartition(4)
    got = {r.doc_id: r for r in language.predict(docs, language.model(docs)).collect()}
    assert set(got) == {r[0] for r in rows + odd}
    for i, _, k in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
    held = [(got[i].lang_pred, k) for i, _, k in rows if got[i].held_out]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and got[900].score == 0
    assert got[903].lang_pred == "aa" and got[904].lang_pred == "bb"


def test_labels_of_held_out_documents_are_not_learned(spark):
    rows = [(i, spoken("aa", 30, i), "aa" if zlib.crc32(str(i).encode()) % 3 != 1 else "zz") for i in range(40)]
    assert {label for _, label in language.training_rows(documents(spark, rows))} == {"aa"}


def test_no_rows(spark):
    empty = documents(spark, [])
    assert language.predict(empty, language.model(empty)).count() == 0
    only = documents(spark, [(1, "word", None)])
    assert language.predict(only, language.model(only)).first().lang_pred == "und"


def plain_label(net, text):
    """Every byte on its own, in ordinary floating-point numbers."""
    import math

    w, n = {k: v.astype(float).tolist() for k, v in net.weights.items()}, net.hidden
    data = [b + 32 if 65 <= b <= 90 else b for b in text.encode()]
    sigma = lambda v: 1 / (1 + math.exp(-v))

    def states(part, side):
        state, out = [0.0] * n, []
        for byte in part:
            back = [sum(state[i] * w["h" + side][i][j] for i in range(n)) for j in range(3 * n)]
            x = w["x" + side][byte]
            z, r = ([sigma(x[k + j] + back[k + j]) for j in range(n)] for k in (0, n))
            new = [math.tanh(r[j] * (back[2 * n + j] + w["c" + side][j]) + x[2 * n + j]) for j in range(n)]
            state = [new[j] + z[j] * (state[j] - new[j]) for j in range(n)]
            out.append(state)
        return out

    total, counted = [0.0] * len(net.labels), 0
    for at in range(0, len(data), language.SEGMENT):
        part = data[at:at + language.SEGMENT]
        for byte, f, b in zip(part, states(part, "f"), states(part[::-1], "b")[::-1]):
            if 97 <= byte <= 122 or byte >= 128:
                logits = [sum((f + b)[i] * w["out"][i][k] for i in range(2 * n)) + w["bias"][k] for k in range(len(net.labels))]
                odds = [math.exp(v - max(logits)) for v in logits]
                total = [t + o / sum(odds) for t, o in zip(total, odds)]
                counted += 1
    if not counted or not any(c.isalpha() for c in text):
        return "und", 0.0
    best = max(range(len(total)), key=lambda k: total[k])
    return net.labels[best], total[best] / counted


def test_labels_equal_a_plain_run_over_the_bytes(net):
    texts = [spoken(k, n, n) for k in SOUNDS for n in (1, 7, 60)] + ["KA to Éau", "", "12 34", "x", "é" * 200, spoken("aa", 30, 1) + " " + spoken("bb", 30, 2)]
    for (lang, score), text in zip(language.label_texts(net, texts), texts):
        want, value = plain_label(net, text)
        assert (lang, score) == (want, pytest.approx(value, abs=2e-5)), text


def test_told_is_the_filter_of_the_predictions(spark, net):
    rows = [(i, t) for i, t in enumerate([None, "", "1 2 3", spoken("aa", 9, 1), spoken("bb", 9, 1), "ka sch éau", "?"])]
    docs = clashing(documents(spark, rows)).repartition(3)
    for least in (0.0, 0.6, 1.1):
        want = {r.doc_id for r in language.predict(docs, net).collect() if r.lang_pred != "und" and r.score >= least}
        assert {r.doc_id for r in docs.filter(language.told(net, least)(docs["text"])).collect()} == want
    assert docs.filter(language.told(None, 0.0)(docs["text"])).count() == 0
