"""The feature store as Spark jobs: historical reads, materialisation, online reads, vector search."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.operators.encode import with_vector
from pairloom.operators.materialize import latest_per_key, online_lookup, time_window
from pairloom.operators.pit import AsOfSource, point_in_time_many
from pairloom.operators.similarity import VectorIndex, build_index, extend_index, probe_topk, pruned_topk, topk_join
from pairloom.session import stage
from pairloom.sources.keyed import KeyedTable
from pairloom.sources.versions import VersionedTable, last_upto
from pairloom.sources.views import FeatureView, Registry

BUCKETS_PER_TTL = 4  # time buckets in the longest TTL of a historical read
COMPACT_AFTER = 16  # deltas after which a materialisation writes a new base


@dataclass
class FeatureStore:
    spark: SparkSession
    root: str
    registry: Registry
    key_buckets: int | None = None  # online tables in so many buckets of keys (``KeyedTable``); None keeps base and deltas

    def source(self, view: FeatureView) -> DataFrame:
        return self.spark.read.parquet(view.source)

    # ------------------------------------------------------------ historical

    def historical(self, spine: DataFrame, features, spine_ts: str = "event_timestamp") -> DataFrame:
        """Point-in-time features by ``view:column`` name for every spine row.

        Views with the same keys are joined in one pass, cut into time buckets of a ``BUCKETS_PER_TTL``-th of their longest TTL.
        """
        out, by_keys, wanted = spine, {}, self.registry.resolve(features)
        for name, columns in wanted.items():
            view = self.registry.view(name)
            by_keys.setdefault(tuple(view.keys), []).append(AsOfSource(self.source(view), view.ts_col, tuple(columns), view.ttl, tuple(view.tie_break)))
        for keys, sources in by_keys.items():
            spans = [s.ttl for s in sources]
            out = point_in_time_many(out, sources, list(keys), spine_ts, max(spans) / BUCKETS_PER_TTL if all(spans) else None)
        return out.select(*spine.columns, *[c for columns in wanted.values() for c in columns])

    # ------------------------------------------------------------ materialise

    def online_table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root.rstrip('/')}/online/{self.registry.online_view(name).name}")

    def keyed_table(self, name: str) -> KeyedTable:
        view = self.registry.online_view(name)
        return KeyedTable(self.spark, f"{self.root.rstrip('/')}/online/{view.name}", tuple(view.keys), view.ts_col, tuple(view.tie_break), self.key_buckets)

    def materialize(self, name: str, df: DataFrame | None = None, use_event_time: bool = True,
                    run_id: str = "materialize") -> int:
        """Write the latest row per key as a new base version."""
        view = self.registry.online_view(name)
        table = self.online_table(name)
        rows = self.source(view) if df is None else df
        latest = latest_per_key(rows, view.keys, view.ts_col if use_event_time else None, view.tie_break)
        if self.key_buckets:
            return self.keyed_table(name).write(latest, run_id)
        return table.write(latest, run_id)

    def materialize_incremental(self, name: str, end: dt.datetime, df: DataFrame | None = None,
                                run_id: str = "materialize-incremental", compact_after: int = COMPACT_AFTER) -> int:
        """Add the rows of ``(last end, end]``; the first run starts at ``end - ttl``.

        Only the new window is written, as a delta of latest rows; reads merge it. After ``compact_after``
        deltas the table is rewritten as one base.
        """
        view = self.registry.online_view(name)
        table = self.online_table(name)
        past = self.keyed_table(name).history() if self.key_buckets else table.history()
        last = last_upto(past)
        start = dt.datetime.fromisoformat(last) if last else end - view.ttl
        if last and end <= start:
            return past[-1]["version"]
        rows = time_window(self.source(view) if df is None else df, view.ts_col, start, end)
        latest = latest_per_key(rows, view.keys, view.ts_col, view.tie_break)
        if self.key_buckets:
            return self.keyed_table(name).merge(latest, run_id, end.isoformat(sep=" ", timespec="microseconds"))
        version = table.write(latest, run_id, kind="delta", upto=end.isoformat(sep=" ", timespec="microseconds"),
                              past=past)
        if len(table.parts(past=past)) + 1 > compact_after:
            version = table.write(self.online(name), run_id, kind="base")
        return version

    def online(self, name: str, version: int | None = None) -> DataFrame:
        """The online table: one row per key, newest wins across base and deltas."""
        view = self.registry.online_view(name)
        if self.key_buckets:
            return self.keyed_table(name).read(version=version)
        return self.online_table(name).read_latest(view.keys, view.ts_col, view.tie_break, version)

    # ------------------------------------------------------------ online reads

    def online_features(self, requests: DataFrame, features) -> DataFrame:
        """Features by key for a table of requests; on-demand ones are computed from the request's text."""
        stored, computed = [], []
        for feature in features:
            name, _, column = feature.partition(":")
            (computed if (name, column) in self.registry.on_demand else stored).append((feature, name, column))
        out = requests
        for name, columns in self.registry.resolve([f for f, _, _ in stored]).items():
            rows = self.keyed_table(name).read_for(out) if self.key_buckets else self.online(name)
            out = online_lookup(out, rows, self.registry.view(name).keys, columns)
        for _, name, column in computed:
            text, encoder = self.registry.on_demand[(name, column)]
            out = with_vector(out, encoder, text, column)
        return out

    def search(self, name: str, queries: DataFrame, query_id: str, query_vec: str, top_k: int,
               features=(), index: VectorIndex | None = None, nprobe: int | None = None) -> DataFrame:
        """The ``top_k`` nearest stored rows of each query, with ``distance`` and the asked features.

        ``distance`` is the cosine, best 1.0; ``rank`` counts from 0 by distance, then key. With an index,
        ``nprobe`` lists are searched, or without ``nprobe`` all lists that can hold a result.
        """
        view = self.registry.online_view(name)
        if view.vector is None:
            raise ValueError(f"view {name} has no vector")
        table, key = self.online(name), view.keys[0]
        common = {"query_id": query_id, "query_vec": query_vec, "exclude_same_id": False}
        if index is None:
            found = topk_join(queries, table, top_k, doc_id=key, doc_vec=view.vector.name, **common)
        elif nprobe is None:
            found = pruned_topk(queries, index, top_k, **common)
        else:
            found = probe_topk(queries, index, top_k, nprobe, **common)
        found = found.select(F.col("query_id").alias(query_id), F.col("doc_id").alias(key),
                             F.col("similarity").alias("distance"), "rank")
        columns = [f.partition(":")[2] for f in features] or ["text"]
        return found.join(table.select(key, *columns), key)

    def vector_index(self, name: str, lists: int, seed: int = 42) -> tuple[VectorIndex, int]:
        """A centroid index of the online table, and the version it holds."""
        view = self.registry.online_view(name)
        version = self.online_table(name).history()[-1]["version"]
        return build_index(self.online(name, version), view.keys[0], view.vector.name, lists, seed), version

    def follow(self, name: str, index: VectorIndex, since: int, max_list: int | None = None) -> tuple[VectorIndex, int]:
        """The index with what the online table has got since version ``since``: only keys of later deltas are assigned.

        Their current rows count, so a late row that lost against a newer one changes nothing. A new base written by ``materialize`` is
        compared as a whole.
        """
        view, table = self.registry.online_view(name), self.online_table(name)
        past = table.history()
        later = [(before, r) for before, r in zip([None, *past], past) if r["version"] > since]
        if not later:
            return index, since
        # A base right behind a delta of its own run only rewrites what is there; any other base brings rows of its own.
        written = [r for before, r in later if r["kind"] == "delta" or before is None or (before["kind"], before["run_id"]) != ("delta", r["run_id"])]
        now = self.online(name)
        if written:
            keys = table.read_parts(written).select(*view.keys).distinct()
            changed = stage(now.join(keys, list(view.keys), "left_semi"), "changed")
            index = extend_index(index, changed, view.keys[0], view.vector.name, max_list=max_list)
        return index, past[-1]["version"]

    def answer(self, name: str, questions: DataFrame, question_id: str, text_col: str, encoder, top_k: int = 10,
               **search) -> DataFrame:
        """Questions to passages: encode each question, then search the view."""
        asked = with_vector(questions, encoder, text_col, "_question_vec")
        return self.search(name, asked, question_id, "_question_vec", top_k, **search)
