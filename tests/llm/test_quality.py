import random

import numpy as np
import pytest
from helpers import clashing, documents

from pairloom.llm import quality


def rated(n, seed):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdehinorst") for _ in range(draw.randint(2, 6)))
    out = []
    for i in range(n):
        grade = i % 3
        words = [word() for _ in range(draw.randint(20, 60))]
        for _ in range(4):
            words[draw.randrange(len(words))] = {0: "vileness", 1: "junk***", 2: "lovely"}[grade]
        out.append((i, " ".join(words), grade))
    return out


def test_held_out_grades():
    rows = [(*quality.features(t), g) for _, t, g in rated(600, 1)]
    model = quality.train(rows, 3)
    other = [(*quality.features(t), g) for _, t, g in rated(150, 2)]
    tails = model.tails(np.array([model.weights[f].sum() / quality._scale(n) for f, n, _ in other]))
    assert ((tails >= 0.5).sum(axis=1) == [g for *_, g in other]).mean() > 0.9
    assert (tails[:, 0] >= tails[:, 1]).all() and (np.diff(model.thresholds()) > 0).all()


def test_documents(spark):
    rows = rated(300, 3)
    labels = spark.createDataFrame([(i, int(g == 2), int(g == 0)) for i, _, g in rows[:270]] + [(280, None, 1), (None, 1, 1), (999, 1, 0)], "doc_id long, quality int, toxic int")
    odd = [(700, None), (701, ""), (702, "lovely " * 60_000), (0, rows[0][1])]
    got = quality.assess(clashing(documents(spark, [r[:2] for r in rows] + odd)).repartition(3), labels).collect()
    assert len(got) == 304
    by = {r.doc_id: r for r in got}
    assert by[700].expected_grade == by[701].expected_grade is not None
    assert np.mean([by[i].keep == (g > 0) for i, _, g in rows[270:]]) > 0.85
    assert all(r.expected_grade == pytest.approx(r.tail_1 + r.tail_2) for r in got)
    same = [r for r in got if r.doc_id == 0]
    assert same[0] == same[1]


def test_no_ratings(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    row = quality.assess(documents(spark, [(1, "a b")]), none).first()
    assert row.keep and row.expected_grade is None
    assert quality.assess(documents(spark, []), none).count() == 0
