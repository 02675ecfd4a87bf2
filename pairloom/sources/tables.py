"""Reading and writing Parquet tables, and the passage table derived from raw documents."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from pairloom.session import counted_broadcast, stage

PASSAGE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("embeddings", T.ArrayType(T.FloatType(), False)),
    T.StructField("event_timestamp", T.TimestampNTZType()),
])


def require_columns(df: DataFrame, names) -> None:
    """Raise at plan time when a column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; the table has {df.columns}")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, required=()) -> DataFrame:
    """Scan a Parquet table; a declared schema saves the footer read."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    require_columns(df, required)
    return df


def with_file_position(scan: DataFrame, name: str = "source_row") -> DataFrame:
    """A scan of Parquet files with each row's position in file order: files by path, rows as they stand in their file.

    The files' row counts, prefix-summed, are the only thing that is aggregated (one row per file, no column is read); the
    rows take their number within the file from the reader and are neither sorted nor moved.
    """
    counts = scan.select(F.col("_metadata.file_path").alias("_file")).groupBy("_file").agg(F.count("*").alias("_n"))
    counts = stage(counts, "file-rows")
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    placed = scan.select(*scan.columns, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return placed.join(counted_broadcast(offsets), "_file").select(*scan.columns, (F.col("_offset") + F.col("_row")).alias(name))


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=()) -> str:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def chunked_path(path: str) -> str:
    """Default output name of the chunk job: ``_chunked`` goes before the extension."""
    base, ext = os.path.splitext(path.rstrip("/"))
    return f"{base}_chunked{ext}"


def spread(df: DataFrame) -> DataFrame:
    """A scan of a single split is dealt out to all slots; any other table is left where it is.

    For a small input in one file before work that costs far more than the move.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if df.rdd.getNumPartitions() == 1 else df


def driver_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def passages_from_documents(documents: DataFrame) -> DataFrame:
    """``id, title, text`` (and ``source_row`` where given): the first line is the title and what follows it the text; a single line is all text."""
    cut = F.instr("text", "\n")
    given = ["source_row"] if "source_row" in documents.columns else []
    split = documents.select("doc_id", "text", *given, cut.alias("_cut"))
    title = F.when(F.col("_cut") >= 2, F.nullif(F.trim(F.expr("substring(text, 1, _cut - 1)")), F.lit("")))
    rest = F.nullif(F.trim(F.expr("substring(text, _cut + 1)")), F.lit(""))
    return split.select(
        F.col("doc_id").cast("string").alias("id"),
        title.alias("title"),
        F.when(F.col("_cut") > 0, rest).otherwise(F.col("text")).alias("text"),
        *given,
    )
