"""Secret scanning with an incremental ledger of content-addressed blobs.

Every historical version of a text is addressed by its SHA-256. The ledger keeps which rules, by version, have
scanned which blob; a scan looks only at pairs of blob and rule version the ledger does not hold, adds what it
finds, and joins the findings back to all versions that carry the blob. Built-in functions only.

Null text counts as empty and has no findings; repeated rows share one blob and each get its findings; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from pairloom.llm.common import Scratch, id_and_text


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches leftmost and without overlap; a match counts when ``group`` has ``least`` characters.

    ``hints`` are lower-case strings of which a text with a match holds at least one; ``probe`` is a pattern such
    a text matches. Both only save work.
    """

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    hints: tuple[str, ...] = ()
    probe: str = ""

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"

    def may_match(self) -> Column:
        if self.hints:
            lower = F.lower("text")
            return reduce(lambda a, b: a | b, [F.contains(lower, F.lit(h)) for h in self.hints])
        return F.col("text").rlike(self.probe or self.pattern)


# The patterns and lengths of the three base kinds.
BASE_RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12,
         hints=("password", "passwd", "secret", "token", "api_key", "apikey")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18, hints=("akia",)),
    Rule("hex", 1, r"[0-9a-f]+", 0, 16, probe=r"[0-9a-f]{16}"),
)
MORE_RULES = (
    Rule("forge", 1, r"gh[pousr]_[A-Za-z0-9]+", 0, 40, hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40, hints=("eyj",)),
    Rule("key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, hints=("private key-----",)),
)
RULES = BASE_RULES + MORE_RULES
FOUND = "blob binary, kind string, version int, start long, stop long"


class Ledger:
    """Two tables under one folder: which rule versions have scanned a blob, and what they found.

    One writer at a time. Findings are written before the blob counts as scanned, so a broken run is repeated
    and its findings are taken once.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.scanned_at, self.found_at = spark, f"{folder}/scanned", f"{folder}/found"

    def _read(self, path: str, schema: str) -> DataFrame:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        there = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop)
        return self.spark.read.schema(schema).parquet(path) if there else self.spark.createDataFrame([], schema)

    def scanned(self) -> DataFrame:
        return self._read(self.scanned_at, "blob binary, rules array<string>")

    def found(self, rules=RULES) -> DataFrame:
        kept = reduce(lambda a, b: a | b, [(F.col("kind") == r.kind) & (F.col("version") == r.version) for r in rules])
        return self._read(self.found_at, FOUND).filter(kept).distinct()


def versions(docs: DataFrame, rules=RULES) -> DataFrame:
    """``doc_id, blob, text``: the content address of each version, and the text where some rule may match."""
    hit = reduce(lambda a, b: a | b, [r.may_match() for r in rules])
    return id_and_text(docs).select("doc_id", F.unhex(F.sha2("text", 256)).alias("blob"), F.when(hit, F.col("text")).alias("text"))


def _matches(blobs: DataFrame, rules) -> DataFrame:
    """Spans of every due rule: the gaps between matches and the matches give the places as running lengths."""
    def pieces(rule: Rule) -> Column:
        rx = F.lit(rule.pattern)
        found = F.regexp_extract_all("text", rx, F.lit(0))
        judged = found if rule.group == 0 else F.regexp_extract_all("text", rx, F.lit(rule.group))
        cut = F.transform(F.arrays_zip(
            F.transform(F.split("text", rule.pattern, -1), F.length).alias("gap"), F.transform(found, F.length).alias("size"),
            F.transform(judged, F.length).alias("judged")),
            lambda p: F.struct(p["gap"].alias("gap"), p["size"].alias("size"), p["judged"].alias("judged")))
        return F.when(F.array_contains("due", rule.key) & rule.may_match(),
                      F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), F.lit(rule.least).alias("least"), cut.alias("cut")))

    by_rule = blobs.select("blob", F.explode(F.array_compact(F.array(*map(pieces, rules)))).alias("r"))
    rows = by_rule.select("blob", "r.kind", "r.version", "r.least", F.posexplode("r.cut").alias("at", "p"))
    before = W.partitionBy("blob", "kind", "version").orderBy("at")
    ends = F.sum(F.col("p.gap") + F.coalesce("p.size", F.lit(0))).over(before.rowsBetween(W.unboundedPreceding, 0))
    return rows.withColumn("stop", ends.cast("long")).filter(F.col("p.judged") >= F.col("least")).select(
        "blob", "kind", "version", (F.col("stop") - F.col("p.size")).alias("start"), "stop")


def scan(seen: DataFrame, ledger: Ledger, rules=RULES) -> DataFrame:
    """Bring the ledger up to date with ``seen`` (of :func:`versions`) and return all findings of these rules.

    Copies of a blob meet in one row by a partial aggregate, so a text that a third of all versions share moves
    once per task.
    """
    blobs = seen.groupBy("blob").agg(F.first("text", ignorenulls=True).alias("text"))
    known = ledger.scanned().groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("known"))
    wanted = F.array(*[F.lit(r.key) for r in rules])
    due = F.when(F.col("known").isNull(), wanted).otherwise(F.array_except(wanted, "known"))
    todo = blobs.join(known, "blob", "left").select("blob", "text", due.alias("due")).filter(F.size("due") > 0)
    _matches(todo.filter(F.col("text").isNotNull()), rules).write.mode("append").parquet(ledger.found_at)
    fresh = seen.select("blob").distinct().join(known, "blob", "left").select("blob", due.alias("rules")).filter(F.size("rules") > 0)
    fresh.write.mode("append").parquet(ledger.scanned_at)
    return ledger.found(rules)


def report(docs: DataFrame, ledger_folder: str | None = None, rules=RULES, base=BASE_RULES) -> DataFrame:
    """Per document: how many spans of each base kind, their digest, and all spans as text.

    Spans are ``kind:start:end`` in code points, the end exclusive, by start and then by the order of the rules.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "secrets")
    seen = scratch.stage(versions(docs, rules), "versions")
    found = scan(seen, Ledger(spark, ledger_folder or f"{scratch.root}/ledger"), rules)
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    spans = found.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", rank[F.col("kind")].alias("rank"), "stop", "kind"))).alias("s"))

    def joined(items: Column) -> Column:
        return F.array_join(F.transform(items, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def of_kind(kind: str) -> Column:
        return F.size(F.filter("s", lambda s: s["kind"] == kind)).cast("long")

    of_base = F.filter("s", lambda s: s["rank"] < len(base))
    rows = spans.select("blob", *[of_kind(r.kind).alias(f"n_{r.kind}") for r in base],
                        F.sha2(joined(of_base), 256).alias("base_sha256"), joined(F.col("s")).alias("spans"))
    # Staged, so that a blob of many versions is split over tasks in this join.
    out = seen.select("doc_id", "blob").join(scratch.stage(rows, "spans"), "blob", "left")
    return out.select("doc_id", *[F.coalesce(f"n_{r.kind}", F.lit(0).cast("long")).alias(f"n_{r.kind}") for r in base],
                      F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
