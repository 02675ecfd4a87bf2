import hashlib
import random

from helpers import by_id, clashing, documents, prose

from pairloom.llm import substring


def plain(rows, window=50):
    first = {}
    split = {d: (t or "").encode().split() for d, t in rows}
    for doc_id in sorted(split):
        words = split[doc_id]
        for s in range(len(words) - window + 1):
            first.setdefault(tuple(words[s:s + window]), doc_id)
    out = {}
    for doc_id, words in split.items():
        gone = set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s:s + window])] < doc_id:
                gone.update(range(s, s + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out[doc_id] = (len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def passages():
    draw = random.Random(2)
    shared = [prose(100 + i, draw.choice([49, 50, 51, 75, 140])) for i in range(8)]
    rows = [(0, None), (1, ""), (2, "one two"), (3, "la " * 400), (4, "la " * 70), (5, "la le " * 90)]
    for i in range(40):
        text = prose(i, draw.randint(0, 80), 5000)
        for part in draw.sample(shared, draw.randint(0, 3)):
            text += part + prose(1000 + i, draw.randint(0, 5), 5000)
        rows.append((90 - i, "\n".join(text)))
    rows += [(200, rows[10][1]), (201, rows[10][1])]
    return rows


def test_equal_to_brute_force(spark):
    rows = passages()
    assert by_id(substring.without_repeats(clashing(documents(spark, rows)).repartition(4))) == plain(rows)


def test_pieces_of_long_texts_join_up(spark, monkeypatch):
    rows = [(1, " ".join(prose(1, 900, 5000))), (2, " ".join(prose(2, 100, 5000) + prose(1, 900, 5000)[200:700]))]
    codes = substring.hash_words(rows[1][1].encode().split())
    import numpy as np
    whole = substring._path_blocks(codes, np.array([len(codes)]), 50)
    covered = sum(whole[2])
    assert covered == len(codes) - 49
    assert by_id(substring.without_repeats(documents(spark, rows))) == plain(rows)


def test_blocks_do_not_depend_on_what_stands_around():
    import numpy as np
    part = prose(5, 130, 5000)
    codes = substring.hash_words([w.encode() for w in part])
    other = substring.hash_words([w.encode() for w in prose(6, 77, 5000) + part])
    alone = substring._path_blocks(codes, np.array([len(codes)]), 50)
    behind = substring._path_blocks(other, np.array([len(other)]), 50)
    assert len(set(alone[4]) & set(behind[4])) >= len(set(alone[4])) - 2


def test_repeated_rows_and_none(spark):
    text = " ".join(prose(3, 80, 5000))
    got = [tuple(r)[:3] for r in substring.without_repeats(documents(spark, [(7, text), (7, text)])).collect()]
    assert got == [(7, 80, 0), (7, 80, 0)]
    assert substring.without_repeats(documents(spark, [])).count() == 0


def test_kept_text_on_request(spark):
    text = prose(3, 60, 5000)
    rows = [(1, " ".join(text)), (2, " ".join(["x", *text, "y"]))]
    got = {r.doc_id: r.kept for r in substring.without_repeats(documents(spark, rows), with_text=True).collect()}
    assert got[2] == "x y"


def plain_rows(rows, window=50):
    first, out = {}, []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        words = (text or "").encode().split()
        for s in range(len(words) - window + 1):
            first.setdefault(tuple(words[s:s + window]), doc_id)
    for doc_id, text in rows:
        words, gone = (text or "").encode().split(), set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s:s + window])] < doc_id:
                gone.update(range(s, s + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_repeated_rows_equal_brute_force(spark):
    rows = passages()
    for doubled in (rows + rows, rows + rows[6:20] * 2):
        got = substring.without_repeats(documents(spark, doubled).repartition(4))
        assert sorted(map(tuple, got.collect())) == plain_rows(doubled)


def test_two_texts_of_one_id(spark):
    rows = passages()
    other = rows + [(a, b) for (a, _), (_, b) in zip(rows[6:], rows[16:])]
    got = substring.without_repeats(documents(spark, other).repartition(4))
    assert sorted(map(tuple, got.collect())) == plain_rows(other)
