"""Point-in-time join: for each spine row the newest feature row at or before its time, within a TTL."""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairloom.session import stage

HOT_ROWS = 2_000_000  # rows of one key beyond which the key is cut into time slices
MAX_SLICES = 10_000
MAX_BROADCAST = 2_000_000  # keys or time points in one broadcast


def interval(span: dt.timedelta) -> Column:
    return F.make_dt_interval(F.lit(span.days), F.lit(0), F.lit(0), F.lit(span.seconds + span.microseconds / 1e6))


def point_in_time(spine: DataFrame, features: DataFrame, keys, spine_ts: str, feature_ts: str, columns,
                  ttl: dt.timedelta | None = None, tie_break=(), hot_rows: int = HOT_ROWS) -> DataFrame:
    """The spine with the feature ``columns`` added; no spine row is lost or doubled.

    Keys are equal and ``spine_ts - ttl <= feature_ts <= spine_ts``, both ends included. Among equal times
    the highest ``tie_break`` wins. One shuffle by key; a key with more than ``hot_rows`` rows is cut into
    time slices at its own quantiles, and each slice starts from the last value of the slices before it.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    columns = list(columns)
    clash = [c for c in columns if c in spine.columns]
    if clash:
        raise ValueError(f"feature column(s) {clash} are already in the spine")
    value = F.struct(F.col(feature_ts).alias("_at"), *columns)
    tie = F.struct(*tie_break) if tie_break else F.struct(F.lit(0).alias("none"))
    usable = features.where(F.col(feature_ts).isNotNull())
    for key in keys:
        usable = usable.where(F.col(key).isNotNull())
    facts = usable.select(*keys, F.col(feature_ts).alias("_ts"), F.lit(0).alias("_kind"), tie.alias("_tie"),
                          value.alias("_value"))
    asks = spine.select(*keys, F.col(spine_ts).alias("_ts"), F.lit(1).alias("_kind"),
                        F.struct(*spine.columns).alias("_row"))
    cuts = _time_cuts(facts, asks, keys, hot_rows)
    if cuts is None:
        found = _as_of(facts, asks, keys)
    else:
        found = _split_as_of(facts, asks, cuts, keys)
    fresh = F.col("_seen._at").isNotNull()
    if ttl is not None:
        fresh = F.col("_seen._at") >= F.col("_ts") - interval(ttl)
    return found.select(*[F.col("_row")[c].alias(c) for c in spine.columns],
                        *[F.when(fresh, F.col("_seen")[c]).alias(c) for c in columns])


def _as_of(facts: DataFrame, asks: DataFrame, partition: list, order=("_ts", "_kind", "_tie")) -> DataFrame:
    """The asks with ``_seen``, the last value at or before them within their partition."""
    window = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = facts.unionByName(asks, allowMissingColumns=True)
    return rows.withColumn("_seen", F.last("_value", ignorenulls=True).over(window)).where(F.col("_kind") == 1)


def _split_as_of(facts: DataFrame, asks: DataFrame, cuts: DataFrame, keys: list) -> DataFrame:
    """``_as_of`` where the keys in ``cuts`` are cut into time slices.

    Of a hot key, each instant takes part once: features of one instant are reduced to the winner of the
    tie-break, and spine rows of one instant share its answer, fetched by an equi-join that AQE may split.
    """
    hot = _bounded(cuts.select(*keys), cuts.count())
    timed = F.col("_ts").isNotNull()
    hot_asks = asks.where(timed).join(hot, keys, "left_semi")
    calm_asks = asks.where(timed).join(hot, keys, "left_anti").unionByName(asks.where(~timed))
    calm = _as_of(facts.join(hot, keys, "left_anti"), calm_asks, keys)
    values = facts.join(hot, keys, "left_semi").groupBy(*keys, "_ts").agg(F.max_by("_value", "_tie").alias("_value"))
    values = _with_slice(values, cuts, keys).withColumn("_kind", F.lit(0))
    instants = _with_slice(hot_asks.select(*keys, "_ts").distinct(), cuts, keys).withColumn("_kind", F.lit(1))
    known = values.unionByName(_carried(values, cuts, keys), allowMissingColumns=True)
    answers = _as_of(known, instants, [*keys, "_slice"], ["_ts", "_kind"]).select(*keys, "_ts", "_seen")
    columns = ["_row", "_ts", "_seen"]
    return calm.select(*columns).unionByName(hot_asks.join(answers, [*keys, "_ts"]).select(*columns))


def _bounded(df: DataFrame, entries: int) -> DataFrame:
    """A broadcast hint where the counted size allows it; otherwise the optimizer chooses."""
    return F.broadcast(df) if entries <= MAX_BROADCAST else df


def _time_cuts(facts: DataFrame, asks: DataFrame, keys: list, hot_rows: int) -> DataFrame | None:
    """For each key of over ``hot_rows`` rows the quantiles of its times; None without such a key.

    Stored, so that every use sees the same cuts. A key gets about one cut per ``hot_rows`` of its rows, so
    all cuts together are at most about ``2 * rows / hot_rows``.
    """
    times = facts.select(*keys, "_ts").unionAll(asks.select(*keys, "_ts"))
    sizes = times.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows)
    for key in keys:
        sizes = sizes.where(F.col(key).isNotNull())
    hot = stage(sizes, "hot-keys")
    totals = hot.agg(F.max("_n").alias("largest"), F.count("*").alias("keys")).first()
    if not totals["keys"]:
        return None
    slices = max(2, min(MAX_SLICES, math.ceil(totals["largest"] / hot_rows)))
    quantiles = [i / slices for i in range(1, slices)]
    hot_times = times.join(_bounded(hot, totals["keys"]), keys)
    points = F.percentile_approx("_ts", quantiles, 10 * slices)
    every = hot_times.groupBy(*keys).agg(points.alias("_points"), F.max("_n").alias("_n"))
    step = F.greatest(F.lit(1), F.floor(F.lit(slices) / F.ceil(F.col("_n") / hot_rows)))
    thinned = F.filter("_points", lambda x, i: (i + 1) % step == 0)
    return stage(every.select(*keys, F.array_distinct(thinned).alias("_cuts")), "time-cuts")


def _with_slice(df: DataFrame, cuts: DataFrame, keys: list) -> DataFrame:
    """Rows of the keys in ``cuts`` with the number of cuts before their time."""
    points = cuts.agg(F.sum(F.size("_cuts"))).first()[0]
    before = F.size(F.filter("_cuts", lambda c: c < F.col("_ts")))
    return df.join(_bounded(cuts, points), keys).withColumn("_slice", before).drop("_cuts")


def _carried(values: DataFrame, cuts: DataFrame, keys: list) -> DataFrame:
    """For each slice of a key, the newest value of the slices before; sorted first by its null time."""
    slices = cuts.select(*keys, F.explode(F.sequence(F.lit(0), F.size("_cuts"))).alias("_slice"))
    newest = values.groupBy(*keys, "_slice").agg(F.max_by("_value", "_ts").alias("_newest"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.join(newest, [*keys, "_slice"], "left").withColumn(
        "_value", F.last("_newest", ignorenulls=True).over(earlier))
    return carried.where(F.col("_value").isNotNull()).select(*keys, "_slice", F.lit(-1).alias("_kind"), "_value")


# ---------------------------------------------------------------- several sources in one pass

@dataclass(frozen=True)
class AsOfSource:
    """Time-stamped feature rows of one kind, as one of several that a spine is joined with."""

    features: DataFrame
    ts: str
    columns: tuple
    ttl: dt.timedelta | None = None
    tie_break: tuple = ()


def point_in_time_many(spine: DataFrame, sources: list[AsOfSource], keys, spine_ts: str, bucket: dt.timedelta | None = None) -> DataFrame:
    """The spine with the feature columns of all ``sources``, which share its ``keys``: what ``point_in_time`` adds one after the other.

    Spine and sources are laid together once and exchanged once. With ``bucket``, a key's rows are cut at fixed
    times, so that a key with very many rows is many groups, and no pass over the data has to find it first: the newest value of each key,
    bucket and source is a partial aggregate, and a bucket begins with what the buckets before it carry over. Column names of the sources
    have to differ from each other and from the spine's.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    names = [c for s in sources for c in s.columns]
    clash = sorted({c for c in names if c in spine.columns or names.count(c) > 1})
    if clash:
        raise ValueError(f"feature column(s) {clash} are already in the spine or in another source")
    # One time type for all sides; only zoneless times stay zoneless.
    kinds = {spine.schema[spine_ts].dataType.typeName(), *(s.features.schema[s.ts].dataType.typeName() for s in sources)}
    kind = "timestamp_ntz" if kinds == {"timestamp_ntz"} else "timestamp"
    parts, ties, values = [], [f"_tie{i}" for i in range(len(sources))], [f"_value{i}" for i in range(len(sources))]
    for i, s in enumerate(sources):
        usable = s.features.where(F.col(s.ts).isNotNull())
        for key in keys:
            usable = usable.where(F.col(key).isNotNull())
        tie = F.struct(*s.tie_break) if s.tie_break else F.struct(F.lit(0).alias("none"))
        parts.append(usable.select(*keys, F.col(s.ts).cast(kind).alias("_ts"), F.lit(0).alias("_kind"), tie.alias(ties[i]), F.struct(F.col(s.ts).alias("_at"), *s.columns).alias(values[i])))
    asks = spine.select(*keys, F.col(spine_ts).cast(kind).alias("_ts"), F.lit(1).alias("_kind"), F.struct(*spine.columns).alias("_row"))
    facts = parts[0]
    for part in parts[1:]:
        facts = facts.unionByName(part, allowMissingColumns=True)
    rows, groups = facts.unionByName(asks, allowMissingColumns=True), keys
    if bucket is not None:
        number = F.floor(_seconds("_ts", kind) / F.lit(max(1, int(bucket.total_seconds()))))
        carried = _carried_over(facts.withColumn("_bucket", number), asks.select(*keys, number.alias("_bucket")), keys, ties, values)
        rows = rows.withColumn("_bucket", number).unionByName(carried, allowMissingColumns=True)
        groups = [*keys, "_bucket"]
    window = Window.partitionBy(*groups).orderBy("_kind_first", "_ts", "_kind", *ties).rowsBetween(Window.unboundedPreceding, 0)
    ordered = rows.withColumn("_kind_first", F.when(F.col("_kind") < 0, 0).otherwise(1))
    seen = ordered.select("_row", "_ts", "_kind", *[F.last(v, ignorenulls=True).over(window).alias(v) for v in values]).where(F.col("_kind") == 1)
    out = [F.col("_row")[c].alias(c) for c in spine.columns]
    for s, v in zip(sources, values):
        fresh = F.col(f"{v}._at").isNotNull() if s.ttl is None else F.col(f"{v}._at") >= F.col("_ts") - interval(s.ttl)
        out += [F.when(fresh, F.col(v)[c]).alias(c) for c in s.columns]
    return seen.select(*out)


def _seconds(ts: str, kind: str) -> Column:
    """Whole seconds since 1970 in the order of the times: by the clock for zoneless times, whatever the session's zone."""
    if kind == "timestamp":
        return F.unix_seconds(ts)
    return F.unix_date(F.to_date(ts)).cast("long") * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60 + F.second(ts)


def _carried_over(facts: DataFrame, asked: DataFrame, keys: list, ties: list, values: list) -> DataFrame:
    """For each key and bucket with spine rows, the newest value of every source in the buckets before it, as rows of kind -1."""
    newest = facts.groupBy(*keys, "_bucket").agg(*[F.max_by(v, F.struct(F.when(F.col(v).isNotNull(), F.col("_ts")), t)).alias(v) for v, t in zip(values, ties)])
    wanted = asked.where(F.col("_bucket").isNotNull()).groupBy(*keys, "_bucket").agg(F.lit(True).alias("_wanted"))
    both = newest.unionByName(wanted, allowMissingColumns=True).groupBy(*keys, "_bucket").agg(
        *[F.max(v).alias(v) for v in values], F.max("_wanted").alias("_wanted"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = both.select(*keys, "_bucket", "_wanted", *[F.last(v, ignorenulls=True).over(earlier).alias(v) for v in values])
    return carried.where(F.col("_wanted")).drop("_wanted").withColumn("_kind", F.lit(-1))
