import itertools
import random

import numpy as np
import pytest
from helpers import by_id, clashing, documents, prose

from pairloom.llm import jaccard


def plain(rows):
    sets = {}
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        sets[doc_id] = {tuple(words)} if 0 < len(words) < 4 else {tuple(words[i:i + 4]) for i in range(len(words) - 3)}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 85 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def edited(words, edits, draw):
    out = list(words)
    for _ in range(edits):
        at = draw.randrange(len(out))
        out[at:at + draw.randint(0, 1)] = [f"new{draw.randrange(10**6)}"] * draw.randint(0, 1)
    return out


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    out = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "oNE "), (6, "a b"), (7, "a b c"), (8, "a b c d"), (9, "A\vB\fC D"), (10, "a " * 3000), (11, "a " * 40), (12, "İ é"), (13, "i̇ É")]
    for family in range(25):
        base = prose(family, draw.choice([5, 7, 9, 14, 30, 60, 150, 400]))
        for _ in range(draw.randint(2, 14)):
            out.append((100 + len(out), " ".join(edited(base, draw.randint(0, 1 + len(base) // 12), draw))))
    return out


def test_groups_equal_brute_force(spark, rows):
    got = by_id(jaccard.groups(clashing(documents(spark, rows)).repartition(5)))
    assert got == plain(rows)


def test_a_chain_that_its_smallest_does_not_reach(spark):
    """Near copies of which each links to the next only; the first pass by shared signatures has to be completed."""
    words, rows = prose(9, 120), []
    for step in range(12):
        words = list(words)
        words[step * 9 + 4] = f"step{step}"
        rows.append((50 - step, " ".join(words)))
    want = plain(rows)
    assert len({c for _, c in want.values()}) < 12
    assert by_id(jaccard.groups(documents(spark, rows).repartition(3))) == want


def test_signatures_of_linked_sets_always_meet():
    """No linked pair may go without a common signature, also at the very threshold."""
    draw = np.random.default_rng(1)
    tops, plan = jaccard.schemes({n: 1000 for n in range(1, 400)})
    for n in list(range(1, 60)) + [80, 131, 200, 333]:
        for _ in range(12):
            shared = int(np.ceil(0.85 * n / (0.85 + 0.15 * draw.random())))
            a, b = 0, 0
            while True:
                a, b = int(draw.integers(0, n)), int(draw.integers(0, n))
                if 100 * shared >= 85 * (shared + a + b):
                    break
            codes = np.unique(draw.integers(0, 1 << 63, shared + a + b).astype(np.uint64))
            one, two = np.sort(codes[:shared + a]), np.sort(np.concatenate([codes[:shared], codes[shared + a:]]))
            if len(one) <= 400 and len(two) <= 400:
                assert np.intersect1d(jaccard.signatures(one, tops, plan), jaccard.signatures(two, tops, plan)).size


def test_allocation_covers_the_differences():
    tops, plan = jaccard.schemes({n: 10 ** 6 // n for n in range(1, 3000)})
    for top, (a, b, c) in zip(tops, plan):
        assert 2 * a + b - c >= jaccard.differences(top) + 1


def test_no_rows(spark):
    assert jaccard.groups(documents(spark, [])).count() == 0
    assert by_id(jaccard.groups(documents(spark, [(5, None), (4, "")]))) == {5: (0, 5), 4: (0, 4)}


def test_repeated_rows_come_back(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (2, "a b c d e"), (3, "z")]
    got = sorted(tuple(r) for r in jaccard.groups(documents(spark, rows)).collect())
    assert got == [(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 1, 3)]


def test_parities_never_exceed_the_differences():
    import numpy as np
    draw = np.random.default_rng(3)
    for n, m, common in ((5, 5, 3), (200, 40, 30), (3000, 2800, 2600), (64, 64, 64), (1, 900, 1)):
        both = draw.integers(0, 1 << 62, n + m - common).astype(np.uint64)
        x, y = np.unique(both[:n]), np.unique(both[n - common:])
        least = jaccard.fewest_differences(jaccard.parities(x), jaccard.parities(y))
        differ = len(np.setxor1d(x, y))
        assert least <= differ and (least > differ / 4 or differ < 8 or min(n, m) * 3 < max(n, m))
