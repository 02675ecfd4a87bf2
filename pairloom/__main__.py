"""Command line: ``chunk`` a corpus, ``prepare`` the training tables, ``train`` on them, ``reembed`` a corpus, ``materialize`` views, ``answer`` questions, ``search`` by vectors."""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pairloom.functions.text import CHUNK_BUDGET
from pairloom.operators.encode import HashingEncoder, ModelEncoder, loader_named
from pairloom.operators.train import AdaptedEncoder, load_adapter
from pairloom.plans.jobs import TrainConfig, build_training_data, chunk_job, load_pairs, reembed_job, train_job
from pairloom.plans.store import FeatureStore
from pairloom.session import build_session
from pairloom.operators.materialize import time_window
from pairloom.operators.similarity import build_index
from pairloom.sources.tables import write_table
from pairloom.sources.views import standard_views


def _encoder(args, spark):
    """The model that the command line names, or feature hashing; behind an adapter where one is given.

    A module of one file is sent to the executors; a package has to be there, for example by ``--py-files``.
    """
    base = HashingEncoder(args.dim)
    if args.base_model:
        loader = loader_named(args.base_model)
        if "." not in loader.__module__:
            spark.sparkContext.addPyFile(sys.modules[loader.__module__].__file__)
        base = ModelEncoder(loader, args.dim, name=args.base_model)
    adapter = getattr(args, "adapter", None)
    return AdaptedEncoder(base, load_adapter(spark.read.parquet(adapter))) if adapter else base


def main(argv=None) -> int:
    parser = argparse.ArgumentParser(prog="pairloom")
    parser.add_argument("--master", help="for example local[8]; leave out under spark-submit")
    jobs = parser.add_subparsers(dest="job", required=True)
    # Option names and defaults of the chunk, prepare and train jobs.
    c = jobs.add_parser("chunk")
    c.add_argument("-i", "--input", required=True)
    c.add_argument("-o", "--output")
    c.add_argument("-m", "--max-chars", type=int, default=CHUNK_BUDGET)
    p = jobs.add_parser("prepare")
    p.add_argument("--source-data", required=True)
    p.add_argument("--output-dir", required=True)
    p.add_argument("--hard-negatives-per-query", type=int, default=2)
    p.add_argument("--random-negative-ratio", type=float, default=0.5)
    p.add_argument("--index-lists", type=int, help="mine with a centroid index of this many lists")
    p.add_argument("--nprobe", type=int, default=8, help="lists searched for each title; 0 searches all that can hold a result, which is exact")
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--row-order", choices=("id", "file"), default="id", help="what row numbers count")
    r = jobs.add_parser("reembed")
    r.add_argument("-i", "--input", required=True)
    r.add_argument("-o", "--output", required=True)
    r.add_argument("--adapter", help="the adapter folder of a training run")
    for name in ("materialize", "materialize-incremental"):
        m = jobs.add_parser(name)
        m.add_argument("--data-dir", required=True, help="the folder of the views' sources")
        m.add_argument("-o", "--output", required=True, help="the folder of the online tables")
        m.add_argument("--view", required=True)
        m.add_argument("--end", required=name != "materialize", help="the end of the time window")
        m.add_argument("--dim", type=int, default=384)
    t = jobs.add_parser("train")
    t.add_argument("--data-dir", required=True, help="the output folder of prepare")
    t.add_argument("-o", "--output", required=True)
    t.add_argument("--mode", choices=("pit", "direct"), default="pit")
    t.add_argument("--max-samples", type=int)
    t.add_argument("--epochs", type=int, default=TrainConfig.epochs)
    t.add_argument("--batch-size", type=int, default=TrainConfig.batch_size)
    t.add_argument("--learning-rate", type=float, default=TrainConfig.learning_rate)
    t.add_argument("--world-size", type=int, default=TrainConfig.world_size)
    t.add_argument("--hard-negative-update-freq", type=int, default=TrainConfig.hard_negative_update_freq)
    t.add_argument("--write-shards", action="store_true")
    t.add_argument("--warmup", type=int, default=TrainConfig.warmup, help="steps of linear warm-up")
    t.add_argument("--full-batch", action="store_true", help="one step an epoch over all pairs")
    t.add_argument("--refresh-queries", type=int, default=TrainConfig.refresh_queries)
    t.add_argument("--refresh-candidates", type=int, default=TrainConfig.refresh_candidates)
    t.add_argument("--refresh-rows", type=int, default=TrainConfig.refresh_rows)
    t.add_argument("--final-rows", type=int, help="test rows of the final evaluation; all without it")
    for name in ("answer", "search"):
        a = jobs.add_parser(name)
        a.add_argument("--store", required=True, help="the folder of the online tables")
        a.add_argument("--view", default="wiki_passages")
        a.add_argument("-i", "--input", required=True, help="a table of questions, or of vectors")
        a.add_argument("-o", "--output", required=True)
        a.add_argument("--id-col", default="question_id")
        a.add_argument("--text-col" if name == "answer" else "--vector-col", default="question" if name == "answer" else "query_embedding")
        a.add_argument("--top-k", type=int, default=10)
        a.add_argument("--features", nargs="*", default=["text"], help="columns of the view to return")
        a.add_argument("--index-lists", type=int, help="search through a centroid index of this many lists")
        a.add_argument("--nprobe", type=int, default=0, help="lists searched; 0 searches all that can hold a result, which is exact")
        if name == "answer":
            a.add_argument("--adapter", help="the adapter folder of a training run")
            a.add_argument("--base-model", help="a model's loader as package.module:function")
        a.add_argument("--dim", type=int, default=384)
    for sub in (p, r, t):
        sub.add_argument("--base-model", help="a model's loader as package.module:function; feature hashing without it")
        sub.add_argument("--dim", type=int, default=384)
        sub.add_argument("--run-ts", default=dt.datetime.now().isoformat(sep=" "))
    args = parser.parse_args(argv)
    spark = build_session(args.master)
    if args.job == "chunk":
        print(chunk_job(spark, args.input, args.output, args.max_chars))
    elif args.job == "prepare":
        search = {"index_lists": args.index_lists, "nprobe": args.nprobe or None} if args.index_lists else {}
        print(build_training_data(spark, args.source_data, args.output_dir, _encoder(args, spark), args.run_ts,
                                  args.hard_negatives_per_query, args.random_negative_ratio, args.seed, args.row_order, **search))
    elif args.job == "train":
        store = FeatureStore(spark, args.output, standard_views(args.data_dir, args.dim))
        config = TrainConfig(args.epochs, args.batch_size, args.learning_rate, args.world_size,
                             warmup=args.warmup, hard_negative_update_freq=args.hard_negative_update_freq,
                             full_batch=args.full_batch, write_shards=args.write_shards, refresh_queries=args.refresh_queries,
                             refresh_candidates=args.refresh_candidates, refresh_rows=args.refresh_rows,
                             final_rows=args.final_rows)
        now = dt.datetime.fromisoformat(args.run_ts)
        done = train_job(spark, load_pairs(store, args.mode, args.max_samples, now), _encoder(args, spark),
                         args.output, config, now)
        print({key: done[key] for key in ("run_id", "losses", "hard_negative_updates")})
    elif args.job == "reembed":
        print(reembed_job(spark, args.input, args.output, _encoder(args, spark), args.run_ts))
    elif args.job in ("answer", "search"):
        store = FeatureStore(spark, args.store, standard_views("unused", args.dim))
        asked, table, view = spark.read.parquet(args.input), store.online(args.view), store.registry.online_view(args.view)
        index = build_index(table, view.keys[0], view.vector.name, args.index_lists) if args.index_lists else None
        options = {"features": [f"{args.view}:{c}" for c in args.features], "index": index, "nprobe": args.nprobe or None}
        if args.job == "answer":
            found = store.answer(args.view, asked, args.id_col, args.text_col, _encoder(args, spark), args.top_k, **options)
        else:
            found = store.search(args.view, asked, args.id_col, args.vector_col, args.top_k, **options)
        print(write_table(found, args.output))
    else:
        store = FeatureStore(spark, args.output, standard_views(args.data_dir, args.dim))
        if args.job == "materialize":
            view, end = store.registry.online_view(args.view), args.end
            rows = time_window(store.source(view), view.ts_col, None, dt.datetime.fromisoformat(end)) if end else None
            print(store.materialize(args.view, rows))
        else:
            print(store.materialize_incremental(args.view, dt.datetime.fromisoformat(args.end)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
