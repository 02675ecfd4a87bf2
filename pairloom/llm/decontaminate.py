"""Benchmark passages in training texts, found by spaced seeds and verified along their alignment.

Words are the runs of letters and digits of the lower-cased text. A mask fixes some offsets and ignores those
between. The fixed words of every place of a mask are hashed; equal hashes in a benchmark item and a document
give an alignment, and the alignment counts when some ``window`` consecutive item words have at least ``share``
of them equal to the document's. Both default masks together lie unharmed in every window of 15 words with
up to 3 substitutions, so nothing above the threshold is missed (a test goes through all cases). Items of
``shortest`` to ``window - 1`` words have to be found whole, with at least ``short_share`` of their words in place (1,
the value of the query and its SQL, leaves no substitution). Such an item is cut into one more piece than it may have
substitutions, so one piece is unharmed. Shorter items are never matched: runs of up to four words stand in texts that
have nothing to do with the benchmark.

Null text has no words; repeated documents or items give the rows of one; several texts of one item id are matched
each by its own words; empty tables give an empty result; other columns are not read. Built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.llm.common import COUNTED_BROADCAST, Scratch, counted_broadcast

# Fixed offsets: the words between them may differ.
MASKS = ((0, 1, 2, 4), (0, 1, 3, 4))
WINDOW, SHARE, SHORTEST = 15, 0.8, 5
# Of the words of an item below the window.
SHORT_SHARE = 1.0
NO_WORD = r"[^\p{L}\p{N}]+"


def _tokens(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(key, F.array_remove(F.split(F.lower("text"), NO_WORD), "").alias("words"))


def _hash(mask, at: Column, label: int) -> Column:
    return F.xxhash64(F.lit(label), *[F.get("words", at + o) for o in mask])


def _places(rows: DataFrame, masks, key: str) -> DataFrame:
    """One row per mask and place: ``key, words, at, hash``; a place that has no room for a mask has a null hash."""
    at = F.col("at")
    placed = rows.filter(F.size("words") >= min(m[-1] for m in masks) + 1).select(
        key, "words", F.explode(F.sequence(F.lit(0), F.size("words") - 1 - min(m[-1] for m in masks))).alias("at"))
    hashes = [F.when(at + m[-1] < F.size("words"), _hash(m, at, len(m) * 1000 + m[-1])) for m in masks]
    if len(set(m[-1] for m in masks)) == 1:
        hashes = [_hash(m, at, 1000 * i) for i, m in enumerate(masks)]
    return placed.select(key, "words", "at", F.explode(F.array(*hashes)).alias("hash")).filter(F.col("hash").isNotNull())


def _need(size: int, share: float) -> int:
    """The fewest equal words that are ``share`` of ``size``; a share is a decimal, so no rounding adds a word."""
    return math.ceil(round(size * share, 9))


def pieces(size: int, share: float) -> tuple[tuple[int, ...], ...]:
    """Masks of an item: adjoining pieces, one more than the substitutions that ``share`` leaves."""
    count = min(size, size - _need(size, share) + 1)
    cuts = [size * i // count for i in range(count + 1)]
    return tuple(tuple(range(a, b)) for a, b in zip(cuts, cuts[1:]))


def _hits(docs: DataFrame, items: DataFrame, masks, limit: int, first_only: bool = False) -> DataFrame:
    """Distinct alignments ``doc_id, item_id, item_text, shift, part``: ``part`` is the document's text over the item's extent.

    With ``first_only`` the masks lie at the first word of the items.

    The item side is broadcast only after its rows are counted; beyond the limit both sides are shuffled by hash.
    """
    keyed = items.select(F.struct("item_id", "item_text").alias("item"), "words")
    wanted = _places(keyed, masks, "item").filter(F.lit(not first_only) | (F.col("at") == 0))
    wanted = wanted.select("item.*", F.col("at").alias("item_at"), "hash", F.size("words").alias("item_n"))
    count = wanted.count()
    if not count:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, item_text long, shift int, part string")
    here = _places(docs, masks, "doc_id")
    met = here.join(counted_broadcast(wanted, count, limit), "hash")
    shift = F.col("at") - F.col("item_at")
    first = F.greatest(shift, F.lit(0))
    part = F.slice("words", first + 1, F.col("item_n") + shift - first)
    return met.select("doc_id", "item_id", "item_text", shift.alias("shift"), F.array_join(part, " ").alias("part")).distinct()


def _best(flags: Column, size: Column) -> Column:
    """The most ones in ``size`` consecutive places of ``flags``."""
    return F.array_max(F.transform(F.sequence(F.lit(1), F.size(flags) - size + 1),
                                   lambda s: F.aggregate(F.slice(flags, s, size), F.lit(0), lambda a, b: a + b)))


def contaminated(docs: DataFrame, items: DataFrame, masks=MASKS, window=WINDOW, share=SHARE, shortest=SHORTEST,
                 limit=COUNTED_BROADCAST, short_share=SHORT_SHARE) -> DataFrame:
    """``doc_id, item_id, start, matched, n_windows``: one row per document and item found in it.

    ``start`` is the word of the document where the first alignment begins (negative when the item begins before
    the text), ``matched`` the most equal words in a window, ``n_found`` the number of alignments.
    """
    docs = _tokens(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    scratch = Scratch(docs.sparkSession, "decontaminate")
    items = _tokens(items.select(F.col("item_id").cast("long").alias("item_id"), "text"), "item_id")
    items = scratch.stage(items.withColumn("item_text", F.xxhash64("words")).dropDuplicates(["item_id", "item_text"]), "items")
    n = F.size("words")
    hits = _hits(docs, items.filter(n >= window), masks, limit)
    sizes = [r[0] for r in items.filter(n.between(shortest, window - 1)).select(n).distinct().collect()]
    for size in sorted(sizes):
        hits = hits.unionByName(_hits(docs, items.filter(n == size), pieces(size, short_share), limit, True))
    found = hits.join(items, ["item_id", "item_text"])
    skipped = F.greatest(-F.col("shift"), F.lit(0))
    flags = F.zip_with(F.split("part", " "), F.slice("words", skipped + 1, F.size(F.split("part", " "))),
                       lambda a, b: F.when(a == b, 1).otherwise(0))
    size = F.least(F.size("words"), F.lit(window))
    least = F.when(F.size("words") < window, F.ceil(F.round(F.size("words") * F.lit(float(short_share)), 9)).cast("int")).otherwise(F.ceil(F.lit(share) * F.lit(window)).cast("int"))
    scored = found.select("doc_id", "item_id", "shift", flags.alias("flags"), size.alias("size"), least.alias("least"))
    scored = scored.filter(F.size("flags") >= F.col("size")).withColumn("matched", _best(F.col("flags"), F.col("size")))
    return scored.filter(F.col("matched") >= F.col("least")).groupBy("doc_id", "item_id").agg(
        F.min("shift").cast("long").alias("start"), F.max("matched").cast("long").alias("matched"), F.count(F.lit(1)).alias("n_found"))
