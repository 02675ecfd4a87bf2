import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import neighbours


def asked():
    return F.col("vec_id") % 20 == 0


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("score", F.lit("x")).withColumn("tree", F.lit("x"))


def exact(rows, k=20):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float32).astype(np.float64)
    out = {}
    for q in ids[ids % 20 == 0]:
        score = (x * x[ids == q][0]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
        out[int(q)] = [(int(ids[i]), score[i]) for i in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_with_uneven_norms(spark):
    draw = np.random.default_rng(2)
    rows = [(i, (draw.normal(size=16) * draw.uniform(0.2, 3)).tolist(), 0) for i in range(1500)]
    want, got = exact(rows), found(neighbours.nearest(table(spark, rows), asked()))
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert np.mean([len({a for a, _ in want[q]} & {a for a, _ in got[q]}) / 20 for q in want]) >= 0.9
    x = {i: np.array(v, np.float32).astype(np.float64) for i, v, _ in rows}
    for q, near in got.items():
        assert all(s == pytest.approx((x[q] * x[v]).sum(), abs=1e-12) for v, s in near)


def test_copies_ties_and_rows_that_take_no_part(spark):
    draw = np.random.default_rng(3)
    one = draw.normal(size=8).tolist()
    rows = [(i, one, 0) for i in range(100)] + [(i, draw.normal(size=8).tolist(), 0) for i in range(100, 130)]
    odd = [(200, None, 0), (220, [0.0] * 8, 0), (240, [float("nan")] + one[1:], 0), (260, [None] + one[1:], 0), (280, [float("inf")] + one[1:], 0), (300, [1.0, 2.0], 0), (320, [], 0)]
    got = found(neighbours.nearest(table(spark, rows + odd), asked()))
    want = exact(rows)
    assert set(got) == set(want)
    assert [v for v, _ in got[0]] == list(range(1, 21)) and [v for v, _ in got[80]] == list(range(20))


def test_few_rows(spark):
    rows = [(i, [1.0, float(i)], 0) for i in range(15)]
    got = found(neighbours.nearest(table(spark, rows), asked()))
    assert got[0] == exact(rows)[0] and len(got[0]) == 14
    assert neighbours.nearest(table(spark, []), asked()).count() == 0
    assert neighbours.nearest(table(spark, [(20, [1.0], 0)]), asked()).count() == 0
    assert found(neighbours.nearest(table(spark, rows + rows), asked()))[0][:3] == exact(rows)[0][:3]


def test_queue_takes_the_nearest_leaf_first():
    draw = np.random.default_rng(4)
    points = draw.normal(size=(400, 6)).astype(np.float32)
    forest = neighbours.Forest(points, trees=3, leaves=8)
    leaves = forest.leaves_of(points)
    for i in range(20):
        taken = forest.search(points[i], {}, 1)
        assert set(enumerate(leaves[i].tolist())) <= set(taken[:3]) | set(taken)
        assert len(taken) == len(set(taken))


def test_repeated_rows_leave_every_tied_id(spark):
    draw = np.random.default_rng(5)
    one = draw.normal(size=8).tolist()
    rows = [(i, one, 0) for i in range(100)] + [(i, draw.normal(size=8).tolist(), 0) for i in range(100, 130)]
    for repeated in (rows + rows, rows + rows[:1] * 21):
        got = found(neighbours.nearest(table(spark, repeated), asked()))
        assert [v for v, _ in got[0]] == list(range(1, 21)) and [v for v, _ in got[80]] == list(range(20))
