"""Refreshing hard negatives with the current vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pairloom.functions.hashing import shuffle_key
from pairloom.functions.vectors import DECIMALS, cosine
from pairloom.operators.blocks import band_join
from pairloom.operators.pairs import HARD_NEGATIVE, POSITIVE, run_time
from pairloom.operators.positions import hash_position
from pairloom.operators.splits import first_rows
from pairloom.session import counted_broadcast, stage

# Fixed values of a refresh: queries, candidates per query, open similarity band, most new rows.
QUERIES, CANDIDATES = 10, 10
BAND = (0.4, 0.8)
NEW_ROWS = 25


def is_refresh_epoch(epoch: int, every: int) -> bool:
    return epoch > 0 and epoch % every == 0


def _numbered(df: DataFrame, n: int, seed, tag: str, id_col: str, name: str, encode) -> DataFrame:
    """n rows in hash order with their number; the window runs over n rows only.

    The keys are drawn alone; the other columns join the n keys, and only these rows are encoded.
    """
    key = shuffle_key(seed, tag, F.col(id_col))
    top = first_rows(df.select(id_col, key.alias("_key")), n, "_key", id_col)
    top = stage(top.select(id_col, (F.row_number().over(Window.orderBy("_key", id_col)) - 1).alias(name)), "drawn")
    rows = df.join(counted_broadcast(top), id_col)
    return encode(rows) if encode else rows


def band_candidates(pairs: DataFrame, seed, epoch: int, per_query: int = CANDIDATES, band=BAND, exclude_known: bool = True,
                    id_col: str = "training_sample_id", query_vec: str = "query_vec", doc_vec: str = "doc_vec", query_carry=(), doc_carry=(),
                    encode=None) -> DataFrame:
    """Every positive with ``per_query`` documents drawn from all those inside the band, as ``refresh_candidates`` gives them.

    Nothing is sampled beforehand: all pairs are compared in rectangles (``blocks.band_join``), and only ids and similarities leave them.
    A known positive of a query is left out after the join, for which each query gets as many documents more as it can have of these.
    """
    tag = f"refresh{epoch}"
    rows = stage(encode(pairs) if encode else pairs, "refresh-rows")
    positives = rows.where(F.col("label") == POSITIVE)
    numbered = hash_position(positives.select(id_col), shuffle_key(seed, f"{tag}q", F.col(id_col)), "_i", ties=[id_col])
    known = positives.select("query_id", F.col("document_id").alias("_doc")).distinct()
    spare = (rows.groupBy("query_id").agg(F.count_if(F.col("label") == POSITIVE).alias("n")).agg(F.max("n")).first()[0] or 0) if exclude_known else 0
    if exclude_known and spare:
        # A document may stand in several rows.
        spare *= rows.groupBy("document_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    found = band_join(positives.select(F.col(id_col).alias("query_id"), F.col(query_vec).alias("query_vec")),
                      rows.select(F.col(id_col).alias("doc_id"), F.col(doc_vec).alias("doc_vec")), per_query + spare, band, f"{seed}:{tag}")
    found = stage(found.select(F.col("query_id").alias("_q"), F.col("doc_id").alias("_d"), F.col("similarity").alias("similarity_score"), "priority"), "band")
    met = found.join(rows.select(F.col(id_col).alias("_q"), "query_id"), "_q").join(rows.select(F.col(id_col).alias("_d"), F.col("document_id").alias("_doc")), "_d")
    if exclude_known:
        met = met.join(known, ["query_id", "_doc"], "left_anti")
    order = Window.partitionBy("_q").orderBy("priority", "_d")
    chosen = met.withColumn("_j", F.row_number().over(order) - 1).where(F.col("_j") < per_query).join(numbered.withColumnRenamed(id_col, "_q"), "_q")
    asked = rows.select(F.col(id_col).alias("_q"), "query_text", *query_carry)
    docs = rows.select(F.col(id_col).alias("_d"), "document_text", *doc_carry)
    return chosen.join(asked, "_q").join(docs, "_d")


def refresh_candidates(pairs: DataFrame, seed, epoch: int, queries: int | None = QUERIES, candidates: int | None = CANDIDATES,
                       band=BAND, exclude_known: bool = True, id_col: str = "training_sample_id",
                       query_vec: str = "query_vec", doc_vec: str = "doc_vec", query_carry=(),
                       doc_carry=(), encode=None) -> DataFrame:
    """Sampled positives, each with sampled documents, that fall strictly inside the similarity band.

    ``queries * candidates`` documents are drawn in hash order and dealt out, query i taking the numbers
    from ``i * candidates`` on, modulo how many there are, so each query meets different documents. Both
    samples are bounded by the parameters. ``exclude_known`` leaves out documents that are a known positive
    of the same query. ``query_carry`` and ``doc_carry`` name columns to keep from either side. ``encode``
    maps a frame of sampled rows to one with the vector columns, where those are not stored.
    With ``queries=None`` and ``candidates=None`` nothing is sampled: see ``band_candidates``.
    """
    if queries is None and candidates is None:
        return band_candidates(pairs, seed, epoch, band=band, exclude_known=exclude_known, id_col=id_col, query_vec=query_vec, doc_vec=doc_vec,
                               query_carry=query_carry, doc_carry=doc_carry, encode=encode)
    if queries is None or candidates is None:
        raise ValueError("queries and candidates are both sampled or both not")
    tag = f"refresh{epoch}"
    asked = stage(_numbered(pairs.where(F.col("label") == POSITIVE), queries, seed, f"{tag}q", id_col, "_i", encode).select(
        "_i", F.col("query_id"), F.col("query_text"), F.col(query_vec).alias("_qv"), *query_carry), "asked")
    pool = stage(_numbered(pairs, queries * candidates, seed, f"{tag}d", id_col, "_slot", encode).select(
        "_slot", F.col("document_id").alias("_doc"), F.col("document_text"), F.col(doc_vec).alias("_dv"), *doc_carry), "pool")
    size = pool.count()  # at most queries * candidates
    dealt = asked.withColumn("_j", F.explode(F.array(*[F.lit(j) for j in range(min(candidates, size))]))).withColumn(
        "_slot", F.pmod(F.col("_i") * candidates + F.col("_j"), F.lit(size)))
    met = dealt.join(counted_broadcast(pool), "_slot")
    if exclude_known:
        known = pairs.where(F.col("label") == POSITIVE).join(
            counted_broadcast(asked.select("query_id")), "query_id", "left_semi").select(
            "query_id", F.col("document_id").alias("_doc"))
        met = met.join(known, ["query_id", "_doc"], "left_anti")
    scored = met.withColumn("similarity_score", F.round(cosine("_qv", "_dv"), DECIMALS))
    low, high = band
    return scored.where((F.col("similarity_score") > low) & (F.col("similarity_score") < high))


def refresh_hard_negatives(pairs: DataFrame, run_ts, seed, epoch: int, new_rows: int = NEW_ROWS,
                           allow_growth: bool = False, id_col: str = "training_sample_id", query_carry=(),
                           doc_carry=(), **sampling) -> DataFrame:
    """The pairs with their oldest hard negatives replaced by new ones, at most ``new_rows`` of them.

    As many old rows go as new ones come, so the size stays; when fewer old rows exist, only that many new
    ones are taken unless ``allow_growth``. All columns are carried; new rows have NULL in those they lack.
    """
    found = refresh_candidates(pairs, seed, epoch, id_col=id_col, query_carry=query_carry, doc_carry=doc_carry,
                               **sampling)
    limit = new_rows
    if not allow_growth:
        limit = min(limit, first_rows(pairs.where(F.col("label") == HARD_NEGATIVE), new_rows, id_col).count())
    chosen = first_rows(found, limit, "_i", "_j")
    number = F.row_number().over(Window.orderBy("_i", "_j")) - 1  # over at most `new_rows` rows
    stamp = F.date_format(run_time(run_ts), "yyyyMMddHHmmss")
    new = chosen.withColumn("_n", number).select(
        F.concat_ws("_", F.lit("dynamic_hard"), F.col("_n").cast("string"), stamp).alias(id_col),
        "query_text",
        "document_text",
        F.lit(HARD_NEGATIVE).alias("label"),
        "similarity_score",
        F.concat_ws("_", F.lit("dynamic"), "query_id").alias("query_id"),
        F.concat_ws("_", F.lit("dynamic_doc"), F.col("_j").cast("string")).alias("document_id"),
        F.to_json(F.struct(F.lit("dynamic_hard_negative").alias("type"),
                           F.col("similarity_score").alias("similarity"))).alias("metadata"),
        run_time(run_ts).alias("event_timestamp"),
        *query_carry,
        *doc_carry,
    )
    new = stage(new, "refreshed")
    n_new = new.count()  # at most `new_rows`
    oldest = pairs.where(F.col("label") == HARD_NEGATIVE).select(id_col, "event_timestamp")
    oldest = stage(first_rows(oldest, n_new, "event_timestamp", id_col).select(id_col), "replaced")
    kept = pairs.join(counted_broadcast(oldest), id_col, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)
