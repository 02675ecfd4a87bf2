"""URL verdicts from host rules, and for the rest from trust propagated over the link graph of hosts.

Trust is a personalised PageRank from hosts that rules allow, along links; distrust is one from hosts that rules
block, along reversed links (who links to a blocked host inherits from it). Both are measured against the mean weight of
their seeds, so that a host's score does not depend on how many other hosts the rules judge: a host that alone links to a blocked host
has ``DAMPING * (1 - DAMPING)`` of it, 0.1275, whether there is one blocked host or a thousand; several that link to the same one
share that. A host is blocked when the distrust that reaches it over links, its own seed aside, is above its trust and at least
``LEAST_DISTRUST``: pages of a host that the rules leave open are not blocked for the sake of its other pages. Built-in functions only.

A null url, or one without ``://``, has an empty host and path, fits no rule and is allowed. Null html has no
links. Repeated rows each get their row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.llm.common import Scratch

# An absolute link in a page.
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""
DAMPING, STEPS = 0.85, 8
# The least distrust of a blocked host, as a multiple of the mean seed of distrust.
LEAST_DISTRUST = 0.05


@dataclass(frozen=True)
class HostRule:
    verdict: str
    rule: str

    @property
    def host(self) -> str:
        return self.rule.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.split("/", 1)[1]


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(pages: DataFrame) -> DataFrame:
    """``page_id, host, path, html``."""
    url = F.coalesce("url", F.lit(""))
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    out = pages.select("page_id", rest.alias("rest"), "html")
    host = F.regexp_extract("rest", r"^([^/?#]*)", 1)
    return out.select("page_id", _ascii_lower(host).alias("host"),
                      F.regexp_extract(F.substr("rest", F.length(host) + 1), r"^([^?#]*)", 1).alias("path"), "html")


def _fitting(rules) -> Column:
    """The longest rule that fits ``host`` and ``path``, as a struct, or null. The rules are part of the plan."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.rule), r.rule)):
        fits = ((F.col("host") == r.host) | F.endswith("host", F.lit(f".{r.host}"))) & F.startswith("path", F.lit(r.path))
        chosen = F.when(fits, F.struct(F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def host_edges(judged: DataFrame) -> DataFrame:
    """``src, dst, weight``: links between different hosts; one row per task and pair reaches the shuffle."""
    target = F.explode(F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), _ascii_lower)).alias("dst")
    return (judged.filter(F.contains("html", F.lit("//"))).select(F.col("host").alias("src"), target)
            .filter((F.col("src") != "") & (F.col("dst") != F.col("src")))
            .groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight")))


def propagate(seeds: DataFrame, edges: DataFrame, scratch: Scratch, name: str, damping=DAMPING, steps=STEPS) -> DataFrame:
    """Personalised PageRank ``host, score`` from ``host, seed`` (summing to 1) over ``src, dst, share``."""
    rank = seeds.select("host", F.col("seed").alias("score"))
    for step in range(steps):
        moved = rank.join(edges, rank["host"] == edges["src"]).select(F.col("dst").alias("host"), (damping * F.col("score") * F.col("share")).alias("score"))
        kept = seeds.select("host", ((1 - damping) * F.col("seed")).alias("score"))
        rank = scratch.stage(moved.unionByName(kept).groupBy("host").agg(F.sum("score").alias("score")), f"{name}{step}")
        if step:
            scratch.drop(f"{name}{step - 1}")
    return rank


def _shares(edges: DataFrame, src: str, dst: str) -> DataFrame:
    total = edges.groupBy(F.col(src).alias("src")).agg(F.sum("weight").alias("total"))
    return edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"), "weight").join(total, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("share"))


def _seeds(hosts: DataFrame, column: str) -> DataFrame:
    """Seed weights: the share of a host's pages that the rules judge so, scaled to sum to 1."""
    own = hosts.filter(F.col(column) > 0).select("host", (F.col(column) / F.col("n")).alias("part"))
    return own.crossJoin(own.agg(F.sum("part").alias("whole"))).select("host", (F.col("part") / F.col("whole")).alias("seed"))


def judge(pages: DataFrame, rules, damping=DAMPING, steps=STEPS, least_distrust=LEAST_DISTRUST) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every page."""
    scratch = Scratch(pages.sparkSession, "urls")
    cut = parts(pages).withColumn("fit", _fitting(rules)).select("page_id", "host", "path", "fit.rule", "fit.verdict", "html")
    edges = scratch.stage(host_edges(cut), "edges")
    judged = scratch.stage(cut.drop("html"), "judged")
    hosts = scratch.stage(judged.filter(F.col("host") != "").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("verdict") == "allow").alias("allowed"),
        F.count_if(F.col("verdict") == "block").alias("blocked")), "hosts")
    score = None
    for name, column, src, dst in (("trust", "allowed", "src", "dst"), ("distrust", "blocked", "dst", "src")):
        seeds = scratch.stage(_seeds(hosts, column), f"seeds-{name}")
        one = propagate(seeds, scratch.stage(_shares(edges, src, dst), f"shares-{name}"), scratch, name, damping, steps)
        # Seeds sum to 1, so their number is the inverse of their mean.
        if name == "distrust":
            one = one.join(seeds, "host", "left").select("host", (F.col("score") - (1 - damping) * F.coalesce("seed", F.lit(0.0))).alias("score"))
        one = one.crossJoin(F.broadcast(seeds.agg(F.count(F.lit(1)).alias("seeds")))).select("host", (F.col("score") * F.col("seeds")).alias(name))
        score = one if score is None else score.join(one, "host", "full")
    bad = score.filter((F.coalesce("distrust", F.lit(0.0)) > F.coalesce("trust", F.lit(0.0))) & (F.col("distrust") >= least_distrust)).select("host", F.lit(True).alias("bad"))
    return judged.join(bad, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"))
