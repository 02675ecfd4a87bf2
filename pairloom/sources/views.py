"""Feature views: keyed, time-stamped, TTL-bounded tables with a declared schema."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F, types as T

from pairloom.operators.encode import VECTOR

CHECKS = ("missing_columns", "wrong_types", "null_keys", "null_times", "wrong_vector_lengths")


@dataclass(frozen=True)
class Entity:
    name: str
    join_keys: tuple
    value_type: T.DataType = T.StringType()


@dataclass(frozen=True)
class VectorField:
    name: str
    length: int
    metric: str = "COSINE"


@dataclass(frozen=True)
class FeatureView:
    """A declared view over a Parquet source. ``online=False`` views are read point-in-time only."""

    name: str
    entity: Entity
    fields: T.StructType
    ttl: dt.timedelta
    source: str | None = None
    ts_col: str = "event_timestamp"
    online: bool = True
    vector: VectorField | None = None
    tie_break: tuple = ()
    description: str = ""

    @property
    def keys(self) -> list:
        return list(self.entity.join_keys)

    @property
    def schema(self) -> T.StructType:
        keys = [T.StructField(k, self.entity.value_type, False) for k in self.keys]
        return T.StructType([*keys, *self.fields.fields, T.StructField(self.ts_col, T.TimestampNTZType())])

    def problems(self, actual: T.StructType) -> dict:
        """Schema faults that show without reading any data."""
        types = {f.name: f.dataType for f in actual}
        missing = [f.name for f in self.schema if f.name not in types]
        wrong = [f.name for f in self.schema if f.name in types and not _same_type(f.dataType, types[f.name])]
        return {"missing_columns": missing, "wrong_types": wrong}

    def check(self, df: DataFrame) -> DataFrame:
        """One row per check, ``view, check_name, failed``; data checks read the rows once."""
        faults = self.problems(df.schema)
        have = set(df.columns)
        keys = [k for k in self.keys if k in have]
        null_key = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)) if keys else F.lit(True)
        null_time = F.col(self.ts_col).isNull() if self.ts_col in have else F.lit(True)
        short = F.lit(False)
        if self.vector and self.vector.name in have:
            short = F.coalesce(F.size(self.vector.name), F.lit(-1)) != self.vector.length
        counts = df.agg(F.count_if(null_key).alias("null_keys"), F.count_if(null_time).alias("null_times"),
                        F.count_if(short).alias("wrong_vector_lengths"))
        failed = [F.lit(len(faults[c])).cast("bigint") if c in faults else F.col(c) for c in CHECKS]
        entries = F.array(*[F.struct(F.lit(c).alias("check_name"), n.alias("failed")) for c, n in zip(CHECKS, failed)])
        return counts.select(F.lit(self.name).alias("view"), F.inline(entries))

    def conform(self, df: DataFrame) -> DataFrame:
        """The declared columns with the declared types, as a view stores and serves them."""
        return df.select(*[F.col(f.name).cast(_nullable(f.dataType)).alias(f.name) for f in self.schema])


def _nullable(kind: T.DataType) -> T.DataType:
    """The type to cast to: a cast cannot promise that an array holds no nulls."""
    return T.ArrayType(_nullable(kind.elementType), True) if isinstance(kind, T.ArrayType) else kind


def _same_type(declared: T.DataType, actual: T.DataType) -> bool:
    """Equal up to nullability; a double may stand for a declared float."""
    if isinstance(declared, T.ArrayType) and isinstance(actual, T.ArrayType):
        return _same_type(declared.elementType, actual.elementType)
    if isinstance(declared, T.FloatType) and isinstance(actual, T.DoubleType):
        return True
    if isinstance(declared, T.TimestampNTZType) and isinstance(actual, T.TimestampType):
        return True
    return declared == actual


@dataclass
class Registry:
    """View definitions by name, and on-demand features computed by an encoder at read time."""

    views: dict = field(default_factory=dict)
    on_demand: dict = field(default_factory=dict)

    def register(self, view: FeatureView, df: DataFrame | None = None) -> FeatureView:
        """Add a view; given its data, refuse it when the schema does not match."""
        if df is not None:
            faults = {k: v for k, v in view.problems(df.schema).items() if v}
            if faults:
                raise ValueError(f"view {view.name}: {faults}")
        self.views[view.name] = view
        return view

    def register_on_demand(self, name: str, feature: str, input_col: str, encoder) -> None:
        self.on_demand[(name, feature)] = (input_col, encoder)

    def view(self, name: str) -> FeatureView:
        if name not in self.views:
            raise ValueError(f"unknown view {name}; known: {sorted(self.views)}")
        return self.views[name]

    def online_view(self, name: str) -> FeatureView:
        view = self.view(name)
        if not view.online:
            raise ValueError(f"view {name} is offline only")
        return view

    def resolve(self, features) -> dict:
        """``"view:column"`` names as ``{view: [columns]}``, checked against the definitions."""
        wanted: dict = {}
        for feature in features:
            name, colon, column = feature.partition(":")
            if not colon:
                raise ValueError(f"feature {feature!r} is not of the form view:column")
            view = self.view(name)
            if column not in view.fields.names:
                raise ValueError(f"view {name} has no feature {column}")
            wanted.setdefault(name, []).append(column)
        return wanted


def standard_views(root: str, dim: int = 384, fine_tuned=None) -> Registry:
    """The stored views of the training pipeline, and the two that use a fine-tuned encoder's vectors.

    The vectors of ``fine_tuned_query_embeddings`` are computed on demand, by the encoder given as ``fine_tuned``.
    """
    text, vector = T.StringType(), VECTOR
    # Names, fields and lifetimes of the views.
    passage = Entity("id", ("id",))
    sample = Entity("training_sample_id", ("training_sample_id",))
    query = Entity("query_id", ("query_id",))
    passage_fields = T.StructType([T.StructField("text", text), T.StructField("embeddings", vector)])
    pair_fields = T.StructType([
        T.StructField("query_text", text), T.StructField("document_text", text), T.StructField("label", text),
        T.StructField("similarity_score", T.FloatType()), T.StructField("query_id", text),
        T.StructField("document_id", text), T.StructField("metadata", text)])
    query_fields = T.StructType([
        T.StructField("query_text", text), T.StructField("query_embedding", vector),
        T.StructField("query_type", text)])
    registry = Registry()
    registry.register(FeatureView(
        "wiki_passages", passage, passage_fields, dt.timedelta(days=1), f"{root}/passages_chunked.parquet",
        vector=VectorField("embeddings", dim), description="Passage text and vector"))
    registry.register(FeatureView(
        "embedding_training_pairs", sample, pair_fields, dt.timedelta(days=30),
        f"{root}/embedding_training_data.parquet", online=False, description="Labelled query/document pairs"))
    registry.register(FeatureView(
        "query_embeddings", query, query_fields, dt.timedelta(days=7), f"{root}/query_embeddings.parquet",
        vector=VectorField("query_embedding", dim), description="Distinct queries and their vectors"))
    registry.register(FeatureView(
        "fine_tuned_wiki_passages", passage, passage_fields, dt.timedelta(days=1),
        f"{root}/wiki_fine_tuned_embeddings.parquet", vector=VectorField("embeddings", dim),
        description="Passages embedded again after training"))
    if fine_tuned is not None:
        registry.register_on_demand("fine_tuned_query_embeddings", "query_embedding", "query_text", fine_tuned)
    return registry
