"""Exact similarity join on word shingles by a partition of the shingle universe, and the groups its links form.

Words are lower-cased (A-Z) runs between white space; a document's set holds its distinct shingles of ``width``
words (``WORDS`` by default), or the whole sequence when it has fewer. Two documents link when their sets have a Jaccard similarity of at
least ``least`` in 100 (85 by default). Documents without words have the empty set and link with nothing.

Candidates. Sizes fall into bands. Two linked sets whose smaller one lies in band k differ in at most
``H`` shingles, ``H`` following from the band's largest size. The scheme of band k hashes the universe into ``b``
segments that a set matches unchanged (threshold 0) and ``a`` segments it may match with one deletion on either
side (threshold 1). With ``b + 2a > H`` some segment matches. Segments empty on both sides match without telling
anything; ``c`` spare segments make up for the first ``c`` empty ones of a set, and only empty segments beyond them
are signed. ``allocate`` chooses a, b and c for each band by the rows and the false pairs they are expected to
cost, from the counts of all sizes.

Verification. A pair is first tested by the parities of both sets, a few bits a shingle, each of which a differing shingle flips:
more differing bits than a link allows differing shingles rule it out exactly. Only what passes moves whole sets.

Groups. A signature shared by g sets gives g - 1 pairs with its smallest id, not g * g. Each set is first checked
against the partner it shares most signatures with; pairs already connected need no check. What is left are
signatures whose sets still lie in different groups. Up to ``HOT`` sets, all pairs across groups are checked. The sets of
larger ones are near copies below the threshold, or share a common passage; of their pairs across groups those are
checked that also share one of their rarest shingles, which every linked pair does. So no link is lost.

Null text counts as empty; ties, repeated rows of the same id and extra columns do not matter (a repeated id counts
as one document with the copies' sets, each row being returned); an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from pairloom.llm.common import Scratch, id_and_text, tidy
from pairloom.llm.components import components
from pairloom.llm.words import hash_words, mix

WORDS = 4
# Similarity as the fraction LEAST / 100.
LEAST = 85
BAND = 1.3
PAIR_COST = 300.0
FLUSH = 300_000
# Signatures with more sets than this are settled by the rarest shingles instead of by their pairs.
HOT = 16
_FACTORS = mix(np.arange(1, 65, dtype=np.uint64), 7) | np.uint64(1)


def shingles(text: str, width: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles of ``width`` words."""
    words = hash_words(text.encode().lower().split())
    if len(words) < width:
        return words[:0] if not len(words) else mix(np.array([xxhash.xxh64_intdigest(words.tobytes())], np.uint64), len(words))
    code = words[:len(words) - width + 1] * _FACTORS[0]
    for i in range(1, width):
        code += words[i:len(words) - width + 1 + i] * _FACTORS[i]
    code = mix(code, 11)
    code.sort()
    return code[np.concatenate([[True], code[1:] != code[:-1]])]


def band_tops(largest: int, least=LEAST) -> list[int]:
    """The largest size of each band."""
    tops = [max(1, math.ceil(least / (100 - least)) - 1)]
    while tops[-1] < largest:
        tops.append(max(tops[-1] + 1, int(tops[-1] * BAND)))
    return tops


def differences(size: int, least=LEAST) -> int:
    """The most shingles in which a linked pair differs whose smaller set has at most ``size``."""
    return size * (100 - least) // least


def _poisson_above(rate: float, c: int) -> float:
    """The chance of more than ``c`` events; beyond a rate of 500 the normal limit."""
    if rate > 500:
        return 0.5 * math.erfc((c + 0.5 - rate) / math.sqrt(2 * rate))
    term = held = math.exp(-rate)
    for j in range(1, c + 1):
        term *= rate / j
        held += term
    return max(0.0, 1 - held)


def allocate(low: int, top: int, count: int, least=LEAST) -> tuple[int, int, int]:
    """(a, b, c) of a band: expected signatures plus the expected cost of the pairs that say nothing."""
    need, best = differences(top, least) + 1, None
    size = (low + top) / 2
    for a in sorted({0, 1, need // 2, (need + 1) // 2}):
        for c in range(0, 2 + int(8 + need * 0.06)):
            b = max(0, need + c - 2 * a)
            if (c and not b) or a + b == 0:
                continue
            mean = size / (b + a)
            empty = math.exp(-low / (b + a))
            rate = b * empty
            surplus = _poisson_above(rate, c) if b else 0.0
            pairs = (count * surplus) ** 2 / (2 * b) if b else 0.0
            if a + b > 1:
                pairs += a * (count * empty * (1 + mean)) ** 2 / 2
            cost = count * (b + a * (1 + mean)) + PAIR_COST * pairs
            if best is None or cost < best[0]:
                best = cost, (a, b, c)
    return best[1]


def schemes(histogram: dict[int, int], least=LEAST) -> tuple[list[int], list[tuple[int, int, int]]]:
    """Band tops and the allocation of each band, for a histogram of set sizes."""
    tops = band_tops(max(histogram, default=1), least)
    counts = [0] * len(tops)
    for size, n in histogram.items():
        counts[int(np.searchsorted(tops, size))] += n
    lows = [1] + [t + 1 for t in tops[:-1]]
    return tops, [allocate(low, top, max(1, n), least) for low, top, n in zip(lows, tops, counts)]


def _sign(codes: np.ndarray, band: int, a: int, b: int, c: int) -> np.ndarray:
    """Signatures of a set under the scheme of a band; the first ``a`` segments take one deletion."""
    total = a + b
    value = mix(codes, 1000 + band)
    segment = (value >> np.uint64(32)) * np.uint64(total) >> np.uint64(32)
    # Small numbers are sorted by digits.
    order = np.argsort(segment.astype(np.uint16 if total < 1 << 16 else np.uint32), kind="stable")
    segment, value = segment[order].astype(np.int64), value[order]
    counts = np.bincount(segment, minlength=total)
    ends = np.cumsum(counts)
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
    sums = running[ends] - running[ends - counts]
    names = mix(np.arange(total, dtype=np.uint64), 5000 + band)
    full = counts > 0
    skipped = np.flatnonzero(~full[a:])[:c] + a
    signed = np.ones(total, bool)
    signed[skipped] = False
    out = [mix(sums[signed] + names[signed], 9)]
    if a:
        n = int(ends[a - 1])
        out.append(mix(sums[segment[:n]] - value[:n] + names[segment[:n]], 9))
    return np.concatenate(out)


def signatures(codes: np.ndarray, tops, plan, least=LEAST) -> np.ndarray:
    """All signatures of a set: of its own band, and of the bands below that hold smaller partners."""
    n = len(codes)
    if not n:
        return codes
    band = int(np.searchsorted(tops, n))
    out = [_sign(codes, band, *plan[band])]
    smallest = -(-n * least // 100)
    while band and tops[band - 1] >= smallest:
        band -= 1
        out.append(_sign(codes, band, *plan[band]))
    return np.concatenate(out)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n, digest``."""
    @tidy
    def run(batches):
        for batch in batches:
            sizes, digests = [], []
            for text in batch.column(1):
                codes = shingles(text.as_py(), width)
                sizes.append(len(codes))
                digests.append(xxhash.xxh3_128_digest(codes.tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())], ["doc_id", "n", "digest"])

    return docs.mapInArrow(run, "doc_id long, n long, digest binary")


def _signed(docs: DataFrame, tops, plan, least, width: int) -> DataFrame:
    """``sig, doc_id, leader``: a signature met again within a task points to the first document that had it.

    Copies of a set within a task are signed once: they share a digest, by which they are grouped elsewhere.
    """
    @tidy
    def run(batches):
        seen, parts, ids, rows = set(), [], [], 0

        def flush():
            sig = np.concatenate(parts)
            doc = np.repeat(np.array([i for i, _ in ids], np.int64), [n for _, n in ids])
            order = np.argsort(sig, kind="stable")
            run = sig[order]
            first = np.concatenate([[True], run[1:] != run[:-1]])
            leader = np.empty_like(doc)
            leader[order] = doc[order][np.maximum.accumulate(np.where(first, np.arange(len(sig)), 0))]
            return pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(doc), pa.array(leader)], ["sig", "doc_id", "leader"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                codes = shingles(text.as_py(), width)
                digest = xxhash.xxh3_128_digest(codes.tobytes())
                if not len(codes) or digest in seen:
                    continue
                seen.add(digest)
                sig = signatures(codes, tops, plan, least)
                parts.append(sig)
                ids.append((doc_id, len(sig)))
                rows += len(sig)
                if rows >= FLUSH:
                    yield flush()
                    parts, ids, rows = [], [], 0
        if rows:
            yield flush()

    return docs.mapInArrow(run, "sig long, doc_id long, leader long")


def parities(codes: np.ndarray) -> np.ndarray:
    """Packed bits, two to four a shingle, a power of two of them: whether an even or an odd number of shingles falls on each.

    Each shingle in which two sets differ flips one bit, so at least as many shingles differ as bits do. The bits of a smaller
    power are those of a larger one folded upon themselves.
    """
    bits = max(64, 1 << (2 * len(codes) - 1).bit_length()) if len(codes) else 64
    place = mix(codes, 13) & np.uint64(bits - 1)
    return np.packbits(np.bincount(place.astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little")


def fewest_differences(x: np.ndarray, y: np.ndarray) -> int:
    """A lower bound of the shingles in which two sets differ, from their parities."""
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _codes(docs: DataFrame, width: int) -> DataFrame:
    @tidy
    def run(batches):
        for batch in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
            sets = [shingles(t.as_py(), width) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.tobytes() for c in sets], pa.binary()), pa.array([len(c) for c in sets], pa.int64()),
                                              pa.array([parities(c).tobytes() for c in sets], pa.binary())], ["id", "codes", "n", "bits"])

    return docs.mapInArrow(run, "id long, codes binary, n long, bits binary")


def _possible(pairs: DataFrame, codes: DataFrame, least) -> DataFrame:
    """The pairs ``a, b`` that their parities do not rule out: an exact test that moves a thirtieth of the sets."""
    @tidy
    def run(batches):
        for batch in batches:
            sizes = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            differ = [fewest_differences(np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8)) for x, y in zip(batch.column(4), batch.column(5))]
            keep = np.array(differ, np.int64) * (100 + least) <= sizes * (100 - least)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep))

    sides = [codes.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("bits").alias(f"bits_{s}")) for s in "ab"]
    both = pairs.select("a", "b").join(sides[0], "a").join(sides[1], "b")
    return both.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, codes: DataFrame, least) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar enough; whole sets are moved only for pairs that their parities allow."""
    pairs, codes = _possible(pairs, codes, least), codes.select("id", "codes")

    @tidy
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int(np.count_nonzero(large[at] == small))
                keep.append(100 * both >= least * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = pairs.join(codes.withColumnsRenamed({"id": "a", "codes": "codes_a"}), "a")
    two = one.join(codes.withColumnsRenamed({"id": "b", "codes": "codes_b"}), "b")
    return two.select("a", "b", "codes_a", "codes_b").mapInArrow(run, "a long, b long")


def _rarest(sets: DataFrame, least) -> DataFrame:
    """``code, id, n, place, alone``: the shingles of which a linked pair of ``sets`` (``id, n, codes``) shares one.

    In any one order of all shingles, linked sets share a shingle among the first n - ceil(n * least / 100) + 1 of each;
    the order here begins with those in the fewest sets. Shingles of a single set, ``alone`` of them, only count.
    """
    @tidy
    def run(batches):
        for batch in batches:
            found = [np.frombuffer(c.as_py(), np.int64) for c in batch.column(2)]
            who = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(who) for i in range(2)), pa.array(np.concatenate(found) if found else np.zeros(0, np.int64))], ["id", "n", "code"])

    rows = sets.select("id", "n", "codes").mapInArrow(run, "id long, n long, code long")
    common = rows.groupBy("code").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    by_set = W.partitionBy("id")
    placed = rows.join(common, "code").withColumn("place", F.row_number().over(by_set.orderBy("sets", "code"))).withColumn("alone", F.col("n") - F.count(F.lit(1)).over(by_set))
    placed = placed.withColumn("place", F.col("place") + F.col("alone"))
    return placed.filter(F.col("place") <= F.col("n") - F.expr(f"(n * {least} + 99) div 100") + 1).select("code", "id", "n", "place", "alone")


def groups(docs: DataFrame, least: int = LEAST, width: int = WORDS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    docs = id_and_text(docs)
    sets = scratch.stage(_sets(docs, width), "sets")
    # Staged, so that the join below reads both sides from exchanges of its own and a digest of many copies can be split.
    classes = sets.filter("n > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = scratch.stage(classes.filter("copies > 1").select("digest", "rep"), "classes")
    members = scratch.stage(sets.join(classes, "digest", "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep")), "members")
    histogram = {r["n"]: r["count"] for r in sets.filter("n > 0").groupBy("n").count().collect()}
    tops, plan = schemes(histogram, least)
    signed = scratch.stage(_signed(docs, tops, plan, least, width), "signed")

    by_sig = W.partitionBy("sig")
    lead = signed.filter("doc_id = leader").select("sig", "doc_id").withColumn("lo", F.min("doc_id").over(by_sig)).withColumn("hi", F.max("doc_id").over(by_sig))
    shared = lead.filter("lo < hi").select("sig", "doc_id", "lo").unionByName(signed.filter("doc_id <> leader").select("sig", "doc_id", F.col("leader").alias("lo")))
    shared = scratch.stage(shared, "shared")
    scratch.drop("signed")

    size = members.filter("doc_id = rep").select(F.col("rep").alias("id"), "n")
    rep = members.select("doc_id", "rep")

    def candidates(rows: DataFrame) -> DataFrame:
        """Pairs ``a < b`` of classes that may link by their sizes, with the number of rows that gave them."""
        pairs = (rows.groupBy("x", "y").agg(F.count(F.lit(1)).alias("weight"))
                 .join(rep.withColumnsRenamed({"doc_id": "x", "rep": "rx"}), "x").join(rep.withColumnsRenamed({"doc_id": "y", "rep": "ry"}), "y")
                 .filter("rx <> ry").groupBy(F.least("rx", "ry").alias("a"), F.greatest("rx", "ry").alias("b")).agg(F.sum("weight").alias("weight")))
        sized = pairs.join(size.withColumnsRenamed({"id": "a", "n": "na"}), "a").join(size.withColumnsRenamed({"id": "b", "n": "nb"}), "b")
        return sized.filter(100 * F.least("na", "nb") >= least * F.greatest("na", "nb")).select("a", "b", "weight")

    pairs = scratch.stage(candidates(shared.filter("doc_id <> lo").select(F.col("doc_id").alias("x"), F.col("lo").alias("y"))), "pairs")
    wanted = shared.select("doc_id").union(shared.select("lo")).distinct().join(rep, "doc_id").select(F.col("rep").alias("doc_id")).distinct()
    codes = scratch.stage(_codes(docs.join(wanted, "doc_id", "left_semi"), width), "codes")

    def grouped(links: DataFrame | None, name: str) -> DataFrame:
        return components(links, scratch, name)

    # First each set with the smaller-id partner it shares most with.
    best = W.partitionBy("b").orderBy(F.desc("weight"), "a")
    first = pairs.withColumn("place", F.row_number().over(best)).filter("place = 1").select("a", "b")
    links = scratch.stage(_verified(first, codes, least), "links1")
    root = grouped(links, "root1")

    def apart(rows: DataFrame, root: DataFrame) -> DataFrame:
        side = rows.join(root.withColumnsRenamed({"id": "a", "root": "ra"}), "a", "left").join(root.withColumnsRenamed({"id": "b", "root": "rb"}), "b", "left")
        return side.filter(F.coalesce("ra", "a") != F.coalesce("rb", "b"))

    rest = apart(pairs.join(first, ["a", "b"], "left_anti"), root).select("a", "b")
    links = scratch.stage(links.unionByName(_verified(rest, codes, least)), "links2")
    root = grouped(links, "root2")

    # Then what the signatures that still have several groups leave open.
    held = shared.select("sig", "doc_id").unionByName(shared.select("sig", F.col("lo").alias("doc_id"))).join(rep, "doc_id").select("sig", F.col("rep").alias("id")).distinct()
    held = held.join(root, "id", "left").select("sig", "id", F.coalesce("root", "id").alias("root"))
    several = held.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("members")).filter("low < high").select("sig", "members")
    open_rows = scratch.stage(held.join(several, "sig").join(size, "id").select("sig", "id", "root", "n", "members"), "open")
    few = open_rows.filter(F.col("members") <= HOT).select(F.col("sig").alias("key"), "id", "n", F.lit(0).alias("place"))
    hot = open_rows.filter(F.col("members") > HOT).select("id", "n").distinct()
    rare = scratch.stage(_rarest(hot.join(codes.select("id", "codes").dropDuplicates(["id"]), "id"), least).withColumnRenamed("code", "key"), "rare")
    # A set's first shared shingle stands so early in both that the rest of each can hold the overlap a link needs.
    overlap = F.expr(f"((na + nb) * {least} + {99 + least}) div {100 + least}")
    fits = (100 * F.least("na", "nb") >= least * F.greatest("na", "nb")) & (F.col("na") - F.col("placea") + 1 >= overlap) & (F.col("nb") - F.col("placeb") + 1 >= overlap)

    # Each set with the one of fewest shingles of its own in reach, most often the text the copies were made from.
    lead = rare.groupBy("key").agg(F.min(F.struct("alone", "id", "n", "place")).alias("lead"))
    star = rare.join(lead, "key").select("id", F.col("n").alias("na"), F.col("place").alias("placea"), F.col("lead.id").alias("to"), F.col("lead.n").alias("nb"), F.col("lead.place").alias("placeb"))
    star = star.filter(fits & (F.col("id") != F.col("to"))).select(F.least("id", "to").alias("a"), F.greatest("id", "to").alias("b")).distinct().join(pairs.select("a", "b"), ["a", "b"], "left_anti")
    star = scratch.stage(apart(star, root).select("a", "b"), "star")
    links = scratch.stage(links.unionByName(_verified(star, codes, least)), "links3")
    root = grouped(links, "root3")

    def across(rows: DataFrame) -> DataFrame:
        rows = rows.join(root, "id", "left").select("key", "id", "n", "place", F.coalesce("root", "id").alias("root"))
        one, two = (rows.withColumnsRenamed({c: c + s for c in ("id", "n", "place", "root")}) for s in "ab")
        return (one.join(two, "key").filter(fits & F.expr("ida < idb and roota <> rootb")).select(F.col("ida").alias("a"), F.col("idb").alias("b")).distinct())

    tried = pairs.select("a", "b").unionByName(star)
    cross = scratch.stage(across(few).unionByName(across(rare)).distinct().join(tried, ["a", "b"], "left_anti"), "cross")
    links = scratch.stage(links.unionByName(_verified(cross, codes, least)), "links4")
    root = grouped(links, "root4")
    # The result reads the members and the last roots alone.
    scratch.drop("sets", "classes", "shared", "pairs", "codes", "links1", "links2", "links3", "links4", "open", "rare", "star", "cross")
    return (members.join(root.withColumnsRenamed({"id": "rep"}), "rep", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "rep").alias("component_id")))
