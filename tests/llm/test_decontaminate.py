import itertools
import random
import re

from helpers import clashing, documents, prose

from pairloom.llm import decontaminate


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'x' as words", "1 as shift")


def plain(docs, tests):
    def tokens(t):
        return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]

    out = set()
    for (d, text), (i, item) in itertools.product(docs, tests):
        a, b = tokens(text), tokens(item)
        size = min(15, len(b))
        least = len(b) if len(b) < 15 else 12
        if len(b) < 5:
            continue
        for shift in range(-len(b), len(a)):
            same = [0 <= shift + j < len(a) and a[shift + j] == b[j] for j in range(len(b))]
            inside = [0 <= shift + j < len(a) for j in range(len(b))]
            if any(all(inside[s:s + size]) and sum(same[s:s + size]) >= least for s in range(len(b) - size + 1)):
                out.add((d, i))
    return out


def test_masks_lie_unharmed_in_every_window():
    for gone in itertools.combinations(range(15), 3):
        assert any(all(s + o not in gone for o in mask) for mask in decontaminate.MASKS for s in range(15 - mask[-1])), gone


def test_equal_to_brute_force(spark):
    draw = random.Random(8)
    tests = [(i, " ".join(prose(50 + i, n, 60))) for i, n in enumerate([1, 4, 5, 6, 9, 14, 15, 16, 25, 40, 60])] + [(90, None), (91, ""), (92, " ".join(prose(60, 60, 60)))]
    docs = [(900, None), (901, ""), (902, "x " * 30_000)]
    for n in range(70):
        words = prose(500 + n, draw.randint(0, 50), 60)
        part = (draw.choice(tests)[1] or "").split()
        part = part[draw.choice([0, 0, 3]):]
        for _ in range(draw.randint(0, 5) if part else 0):
            part[draw.randrange(len(part))] = "Other"
        at = draw.randint(0, len(words))
        docs.append((n, "; ".join(words[:at] + [p.upper() if n % 3 == 0 else p for p in part] + words[at:])))
    docs.append((5000, docs[10][1]))
    got = decontaminate.contaminated(clashing(documents(spark, docs)).repartition(3), items(spark, tests)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == plain(docs, tests)
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})


def test_shuffled_join_gives_the_same(spark):
    tests = [(1, " ".join(prose(1, 30, 60)))]
    docs = documents(spark, [(i, " ".join(prose(i, 20, 60) + prose(1, 30, 60)[i:])) for i in range(12)])
    one = sorted(map(tuple, decontaminate.contaminated(docs, items(spark, tests)).collect()))
    two = sorted(map(tuple, decontaminate.contaminated(docs, items(spark, tests), limit=0).collect()))
    assert one == two and one


def test_no_rows(spark):
    some = items(spark, [(1, " ".join(prose(1, 30)))])
    assert decontaminate.contaminated(documents(spark, []), some).count() == 0
    assert decontaminate.contaminated(documents(spark, [(1, "a b c d e f")]), items(spark, [])).count() == 0


def test_pieces_outlast_every_allowed_substitution():
    for size in range(5, 15):
        for share in (0.8, 1.0):
            masks = decontaminate.pieces(size, share)
            assert sorted(o for m in masks for o in m) == list(range(size))
            for gone in itertools.combinations(range(size), int(size * (1 - share) + 1e-9)):
                assert any(not set(m) & set(gone) for m in masks), (size, gone)


def test_short_items_may_differ_on_request(spark):
    draw = random.Random(9)
    tests = [(n, " ".join(f"w{n}x{j}" for j in range(n))) for n in range(3, 15)]
    docs, want = [], set()
    for n, item in tests:
        for changed in range(5):
            words = item.split()
            for j in draw.sample(range(n), min(changed, n)):
                words[j] = "other"
            docs.append((10 * n + changed, " ".join(["front", *words, "back"])))
            if n >= 5 and n - changed >= 0.8 * n - 1e-9:
                want.add((10 * n + changed, n))
    got = decontaminate.contaminated(documents(spark, docs), items(spark, tests), short_share=0.8).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert all(r.start == 1 and r.matched >= 0.8 * r.item_id for r in got)


def test_two_texts_of_one_item_id(spark):
    for n in (8, 20):
        one, two = (" ".join(prose(70 + i, n, 5000)) for i in range(2))
        docs = documents(spark, [(1, f"a {one} b"), (2, f"a {two} b"), (3, "a b")])
        for tests in ([(7, one), (7, two)], [(7, two), (7, one), (7, one)]):
            got = decontaminate.contaminated(docs, items(spark, tests)).collect()
            assert sorted((r.doc_id, r.item_id, r.start, r.matched) for r in got) == [(1, 7, 1, min(n, 15)), (2, 7, 1, min(n, 15))]
