"""Command line: ``spark-submit run_job.py`` or ``python -m tickloom.jobs``.

    pipeline  run the bronze, silver and gold streams (and the reject table)
    train     fit the forest on the stored candles, report the hold-out accuracy, save the model
    score     score new candles as they arrive (or the newest ones, once)
    sql       run a statement over the stored tables
    compact   gather the loads of the tables into files by day, and delete what was replaced long ago
"""

from __future__ import annotations

import argparse
import sys
import time
from collections.abc import Sequence

from pyspark.errors import PySparkException

from tickloom.config import TickConfig
from tickloom.plans.model import load_model, train_and_evaluate
from tickloom.plans.serving import volatility_overview
from tickloom.plans.sql import SqlResult, run_sql
from tickloom.schemas import TABLES
from tickloom.session import build_session
from tickloom.sources.tables import Tables
from tickloom.streaming.pipeline import LayeredPipeline
from tickloom.streaming.scoring import StreamScorer, append_latest


def parser() -> argparse.ArgumentParser:
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("--base", required=True, help="folder of the tables")
    shared.add_argument("--format", default="parquet", help="table format")
    top = argparse.ArgumentParser(prog="tickloom")
    jobs = top.add_subparsers(dest="job", required=True)

    pipeline = jobs.add_parser("pipeline", parents=[shared])
    pipeline.add_argument("--source-format", default="kafka")
    pipeline.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    pipeline.add_argument("--topic", default=TickConfig.topic)
    pipeline.add_argument("--window", default=TickConfig.window)
    pipeline.add_argument("--max-per-batch", type=int)
    pipeline.add_argument("--once", action="store_true", help="work off what is there and end")

    train = jobs.add_parser("train", parents=[shared])
    train.add_argument("--model", required=True)
    train.add_argument("--trees", type=int, default=TickConfig.num_trees)
    train.add_argument("--seed", type=int, default=TickConfig.seed)

    score = jobs.add_parser("score", parents=[shared])
    score.add_argument("--model", required=True)
    score.add_argument("--model-id", required=True)
    score.add_argument("--once", action="store_true", help="score the newest candles and end")

    sql = jobs.add_parser("sql", parents=[shared])
    sql.add_argument("statement", nargs="?", help="without one, the volatility overview of the candles")
    sql.add_argument("--out", help="write the result here as Parquet instead of printing it")

    compact = jobs.add_parser("compact", parents=[shared])
    compact.add_argument("--table", action="append", help="one or more tables; without any, all that are there")
    compact.add_argument("--keep-hours", type=float, default=168, help="how long replaced files stay for readers and streams")
    return top


def main(arguments: Sequence[str] | None = None) -> int:
    given = parser().parse_args(arguments)
    spark = build_session(f"tickloom-{given.job}")
    base = TickConfig(base_path=given.base, table_format=given.format)
    return {"pipeline": _pipeline, "train": _train, "score": _score, "sql": _sql, "compact": _compact}[given.job](spark, given, base)


def _pipeline(spark, given, base: TickConfig) -> int:
    cfg = TickConfig(
        base_path=base.base_path,
        table_format=base.table_format,
        source_format=given.source_format,
        source_options=dict(pair.split("=", 1) for pair in given.option),
        topic=given.topic,
        window=given.window,
        max_per_batch=given.max_per_batch,
    )
    pipeline = LayeredPipeline(spark, cfg)
    if given.once:
        pipeline.run_available()
    else:
        pipeline.run_continuously()
    return 0


def _compact(spark, given, base: TickConfig) -> int:
    tables = Tables(spark, base)
    for name in given.table or [n for n in TABLES if tables.exists(n)]:
        replaced, deleted = tables.compact(name), tables.vacuum(name, given.keep_hours)
        print(f"{name}: {replaced} loads gathered, {len(deleted)} folders deleted")
    return 0


def _train(spark, given, base: TickConfig) -> int:
    cfg = TickConfig(
        base_path=base.base_path, table_format=base.table_format, num_trees=given.trees, seed=given.seed
    )
    tables = Tables(spark, cfg)
    if not tables.exists("gold"):
        print("there are no candles yet", file=sys.stderr)
        return 1
    _, report = train_and_evaluate(tables.read("gold"), cfg, given.model)
    print(report)
    return 0


def _score(spark, given, base: TickConfig) -> int:
    tables, model = Tables(spark, base), load_model(given.model)
    if given.once:
        append_latest(tables, model, given.model_id)
    else:
        StreamScorer(tables, model, given.model_id).start().awaitTermination()
    return 0


def _sql(spark, given, base: TickConfig) -> int:
    tables = Tables(spark, base)
    tables.create_views()
    started, count = time.monotonic(), 0
    if given.statement:
        result = run_sql(spark, given.statement)
    else:
        result = SqlResult(volatility_overview(tables.read("gold")))
    try:
        if result.frame is not None and given.out:
            result.frame.write.parquet(given.out)
            count = spark.read.parquet(given.out).count()
        for row in [] if given.out else result.rows():
            print(row.asDict())
            count += 1
    except PySparkException as problem:
        result = SqlResult(error=str(problem))
    if result.error:
        print(result.error, file=sys.stderr)
        return 1
    print(f"{count} rows in {time.monotonic() - started:.3f} s")
    return 0


if __name__ == "__main__":
    sys.exit(main())
