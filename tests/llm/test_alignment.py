import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from helpers import clashing, documents, prose
from tokenizers import Tokenizer

from pairloom.llm import alignment, perfect_hash, queries, tokens

A, B = public_tokenizers.path(queries.BYTES), public_tokenizers.path(queries.PIECES)
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain(rows):
    """The query's rows from its definition, with the two libraries and byte offsets."""
    a_lib, b_lib = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_lib.encode_special_tokens = True
    letters = tokens._bytes_of_letters()
    aligned, count = [], Counter()
    for doc_id, text in rows:
        pieces = []
        if text:
            a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
            a_bytes = [bytes(letters[c] for c in a_lib.id_to_token(i)) for i in a]
            b_bytes = [bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i) else b_lib.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                ends = lambda sizes: np.cumsum([len(x) for x in sizes]).tolist()
                a_ends, b_ends = ends(a_bytes), ends(b_bytes)
                both, a_at, b_at = sorted(set(a_ends) & set(b_ends)), 0, 0
                for end in both:
                    i, j = a_ends.index(end, a_at) + 1, b_ends.index(end, b_at) + 1
                    pieces.append((a[a_at:i], b[b_at:j]))
                    a_at, b_at = i, j
        aligned.append((doc_id, pieces))
        count.update((x[-1], y[-1]) for x, y in pieces)
    best = Counter()
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    out = []
    for doc_id, pieces in aligned:
        links = [(x[-1], y[-1]) for x, y in pieces]
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in pieces)
        out.append((doc_id, sum(len(x) for x, _ in pieces), sum(len(y) for _, y in pieces), len(pieces), len(links), sum(count[k] == best[k[1]] for k in links),
                    sum(count[k] for k in links), hashlib.sha256(written.encode()).hexdigest() if pieces else ""))
    return sorted(out, key=str)


def rows_of(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def odd_rows():
    draw = random.Random(3)
    rows = [(1, None), (2, ""), (3, " "), (4, "a ▁ b"), (5, "<s> </s> <unk> <0x41> <|endoftext|>"), (6, "\x00\x01 naïve 漢字 🤷🏽‍♀️  \n\n\ttabs"), (7, "x" * 3000),
            (None, "no id"), (8, "don't  stop   1234567 "), (9, " " * 2500 + "end"), (10, "word " * 4000), (11, "\r\n \x1c \xa0 　")]
    rows += [(100 + i, " ".join(prose(i, draw.randint(1, 200)))) for i in range(30)]
    rows += [(200 + i, "".join(chr(draw.choice([draw.randrange(32, 127), draw.randrange(160, 1200), draw.randrange(0x4E00, 0x4F00), draw.randrange(0x1F600, 0x1F640)])) for _ in range(80))) for i in range(30)]
    return rows + rows[:12] + rows[20:25]


@pytest.mark.parametrize("slice_pairs", [alignment.SLICE_PAIRS, 700])
def test_rows_equal_the_definition(spark, slice_pairs):
    rows = odd_rows()
    docs = clashing(documents(spark, rows)).withColumnRenamed("rank", "row").repartition(5)
    assert rows_of(alignment.align(docs, A, B, slice_pairs)) == plain(rows)


def test_query_over_a_whole_table(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(queries.op13_alignment(spark, data)) == plain(rows)


def test_empty_table_and_real_groups(spark):
    assert alignment.align(documents(spark, []), A, B).collect() == []
    row = alignment.align(documents(spark, [(1, "hello")]), A, B, with_groups=True).first()
    assert row.groups.count("|") == row.n_groups and hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256
    none = alignment.align(documents(spark, [(1, None), (2, "▁")]), A, B).collect()
    assert [tuple(r)[1:] for r in none] == [(0, 0, 0, 0, 0, 0, "")] * 2


@pytest.mark.parametrize("size", [0, 1, 2, 3, 10, 1000, 20_000])
def test_hash_is_minimal_and_knows_its_keys(size):
    draw = np.random.default_rng(size)
    keys = np.unique(draw.integers(0, 1 << 40, size).astype(np.uint64))
    segments = 4
    own = perfect_hash.mix(keys, perfect_hash._DEAL) % np.uint64(segments)
    parts = [(s, *perfect_hash.build_segment(keys[own == s])) for s in range(segments) if (own == s).any()]
    function = perfect_hash.assembled(parts, segments)
    assert sorted(function.number(keys).tolist()) == list(range(len(keys)))
    others = np.setdiff1d(draw.integers(0, 1 << 40, 500).astype(np.uint64), keys)
    assert (function.number(others) == -1).all()


def test_hash_built_by_tasks(spark):
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 50, 9000))
    function = perfect_hash.build(spark.createDataFrame(pa.table({"key": keys})).repartition(7), len(keys), segment_keys=1000)
    assert len(function.begins) == len(keys) // 1000 + 2 or len(function.begins) == -(-len(keys) // 1000) + 1
    assert sorted(function.number(keys).tolist()) == list(range(len(keys)))


def test_both_encoders_equal_their_libraries():
    lib, own = Tokenizer.from_file(A), tokens.byte_tokens(A)
    for _, text in odd_rows():
        if text is not None:
            assert own.encode(text).tolist() == lib.encode(text, add_special_tokens=False).ids
    assert own.encode("a<|endoftext|>b").tolist()[1] == 50256 and 50256 not in own.encode("a<|endoftext|>b", plain=True)
    assert own.encode("é" * 100_000).size and own.encode("<|endoftext|>" + "y" * 2500).tolist()[0] == 50256
