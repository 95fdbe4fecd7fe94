"""Run the stages as Spark jobs: ``spark-submit ... -m gleanery`` style entry.

Each stage takes the tables it reads and a root folder for what it writes, and
prints the manifest of its artefacts as one JSON object.
"""

from __future__ import annotations

import argparse
import importlib
import json
from dataclasses import replace
from functools import partial

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from gleanery.operators.labeling import RULES
from gleanery.params import CleaningParams, FeedParams, LabelingParams, SplitParams
from gleanery.plans import flow
from gleanery.schemas import FEED_PAGE, GOOGLE_PLAY_RAW
from gleanery.sources.artefacts import Artefacts, new_run_id
from gleanery.sources.readers import scan_pages, scan_records, scan_table, source_or_empty


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="gleanery", description=__doc__.splitlines()[0])
    parser.add_argument("stage", choices=("land", "merge", "prepare", "label", "split", "run-all"))
    parser.add_argument("--out", required=True, help="root folder of the artefacts")
    parser.add_argument("--run-id", default=None, help="default: the current time")
    parser.add_argument("--resume", action="store_true", help="run-all: go on behind the stages that run-id has committed")
    parser.add_argument("--records", help="record dump of the first platform")
    parser.add_argument("--records-format", default="json", choices=("json", "csv", "parquet"))
    parser.add_argument("--pages", help="landed feed pages of the second platform")
    parser.add_argument("--pages-format", default="parquet", choices=("parquet", "json"))
    parser.add_argument("--google", help="first platform's table (merge)")
    parser.add_argument("--app-store", help="second platform's table (merge)")
    parser.add_argument("--table", help="the table to prepare, label or split")
    parser.add_argument(
        "--format", default="auto", choices=("auto", "parquet", "csv", "json", "json-array"), help="of the stage's tables; auto goes by the path"
    )
    parser.add_argument("--labeler", default=RULES, help="'rules' or module:function")
    parser.add_argument("--skip-validation", action="store_true")
    parser.add_argument("--no-export", action="store_true", help="write no CSV and JSON copies")
    feed, clean, labels, split = FeedParams(), CleaningParams(), LabelingParams(), SplitParams()
    parser.add_argument("--review-count", type=int, default=feed.review_count)
    parser.add_argument("--max-pages", type=int, default=feed.max_pages)
    parser.add_argument("--min-length", type=int, default=clean.min_length)
    parser.add_argument("--min-script-chars", type=int, default=clean.min_script_chars)
    parser.add_argument("--keep-emoji", action="store_true")
    parser.add_argument("--batch-size", type=int, default=labels.batch_size)
    parser.add_argument("--max-retries", type=int, default=labels.max_retries)
    parser.add_argument("--retry-delay", type=float, default=labels.retry_delay)
    parser.add_argument("--max-rate", type=float, default=labels.max_rate, help="labeler calls a second over all tasks")
    parser.add_argument("--ledger", help="folder of the labeler's answers, for runs that are repeated")
    parser.add_argument("--max-rounds", type=int, default=labels.max_rounds)
    parser.add_argument("--test-size", type=float, default=split.test_size)
    parser.add_argument("--seed", type=int, default=split.seed)
    parser.add_argument("--by", default=split.by)
    return parser.parse_args(argv)


def flow_params(args: argparse.Namespace) -> flow.FlowParams:
    return flow.FlowParams(
        feed=FeedParams(args.review_count, args.max_pages),
        cleaning=CleaningParams(args.min_length, args.min_script_chars, not args.keep_emoji),
        labeling=replace(
            LabelingParams(),
            batch_size=args.batch_size,
            max_retries=args.max_retries,
            retry_delay=args.retry_delay,
            max_rounds=args.max_rounds,
            max_rate=args.max_rate,
        ),
        split=SplitParams(args.test_size, args.seed, args.by),
        validate=not args.skip_validation,
        export=not args.no_export,
        ledger=args.ledger,
    )


def _table(spark: SparkSession, path: str | None, file_format: str) -> DataFrame | None:
    return None if path is None else scan_table(spark, path, file_format)


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, str]:
    params = flow_params(args)
    out = Artefacts(spark, args.out, args.run_id or new_run_id())
    labeler = args.labeler
    if args.resume and not args.run_id:
        raise ValueError("--resume needs --run-id")
    if labeler != RULES:
        module, _, name = labeler.partition(":")
        own = importlib.import_module(module)
        cloudpickle.register_pickle_by_value(own)  # executors need no copy of it
        labeler = getattr(own, name)
    if args.stage in ("land", "run-all"):
        records = pages = None
        failed: list[str] = []
        if args.records:
            read = partial(scan_records, spark, args.records, GOOGLE_PLAY_RAW, args.records_format)
            records = source_or_empty(spark, GOOGLE_PLAY_RAW, read, lambda _: failed.append("google_play"))
        if args.pages:
            scan = partial(scan_pages, spark, args.pages, args.pages_format)
            pages = source_or_empty(spark, FEED_PAGE, scan, lambda _: failed.append("app_store"))
        if args.stage == "run-all":
            out = flow.run_all(spark, args.out, records, pages, labeler, params, out.run_id, args.resume, failed)
        else:
            for source in failed:
                out.note(f"{source}_failed", "", 0)
            flow.run_land(out, records, pages, params)
    elif args.stage == "merge":
        flow.run_merge(out, _table(spark, args.google, args.format), _table(spark, args.app_store, args.format), params.export)
    else:
        if not args.table:
            raise ValueError(f"{args.stage} needs --table")
        rows = _table(spark, args.table, args.format)
        if args.stage == "prepare":
            flow.run_prepare(out, rows, params.cleaning, params.export)
        elif args.stage == "label":
            flow.run_labeling(out, rows, labeler, params, params.export)
        else:
            flow.run_split(out, rows, params=params.split)
    return dict(out.paths)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName("gleanery").getOrCreate()
    print(json.dumps(run(spark, args), indent=2))


if __name__ == "__main__":
    main()
