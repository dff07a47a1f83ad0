"""Command line: ``python -m consolida run`` and ``python -m consolida evaluate``.

Both work on a folder with a folder of decrees for each site; all sites go
through one Spark job.
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Sequence

from pyspark.sql import SparkSession

from consolida import settings as config
from consolida.operators import evaluation
from consolida.plans import pipeline
from consolida.sources import decrees as readers
from consolida.sources import http_calls, sinks


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="consolida", description="Consolidation of dated decrees, site by site.")
    out.add_argument("--settings", help="JSON file of settings")
    out.add_argument("--master", help="Spark master; by default the session's own")
    commands = out.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="operations, history and permits of the sites of a folder")
    run.add_argument("input", help="folder with a folder of .html files for each site")
    run.add_argument("--output", required=True, help="folder for operations.json, history.json and permis.html of each site")
    run.add_argument("--tagged-output", help="folder for the decrees as they were read")
    run.add_argument("--operations-from", help="folder with operations.json of each site, in place of a model")
    run.add_argument("--include", nargs="+", metavar="DATE", help="decrees to take; all without")
    run.add_argument("--aiot", nargs="+", help="sites to take; all without")
    run.add_argument("--start-date", help="only later decrees are searched for operations; by default the site's first")
    run.add_argument("--principal-id", metavar="DATE", help="date of the principal decree")
    run.add_argument("--tagging-ops", action="store_true", help="merge operations of the verb grammar with the others")
    run.add_argument("--no-rendering", action="store_true")
    test = commands.add_parser("evaluate", help="a score sheet against ground truth")
    test.add_argument("input")
    test.add_argument("--truth", required=True, help="folder with operations.json of each site")
    test.add_argument("--output", required=True, help="folder for the sheet's own folder")
    test.add_argument("--operations-from")
    test.add_argument("--aiot", nargs="+")
    test.add_argument("--tagging-ops", action="store_true")
    test.add_argument("--rates", help="CSV of model, cost_in, cost_out for a million tokens")
    return out


def _decrees(spark: SparkSession, args: argparse.Namespace):  # noqa: ANN202
    rows = readers.load_decrees(spark, args.input)
    return rows.where(rows["aiot"].isin(*args.aiot)) if args.aiot else rows


def _given(spark: SparkSession, args: argparse.Namespace):  # noqa: ANN202
    """Operations that are given, without those out of form, which are told."""
    if not args.operations_from:
        return None
    rows, bad = readers.valid_operations(readers.operations(spark, args.operations_from))
    for r in bad.groupBy("reject_reason").count().collect():  # a row for each reason
        config.LOG.warning("%d given operations out of form: %s", r["count"], r["reject_reason"])
    return rows


def _call(settings: config.Settings, args: argparse.Namespace):  # noqa: ANN202
    return None if args.operations_from or not settings.models else http_calls.caller(settings.models, settings.timeout)


def run(spark: SparkSession, args: argparse.Namespace, settings: config.Settings) -> int:
    rows = pipeline.chosen(_decrees(spark, args), args.include, args.principal_id)
    if rows.isEmpty():
        config.LOG.error("no decree matches")
        return 1
    if args.principal_id and rows.where("principal").isEmpty():
        config.LOG.error("no decree of %s", args.principal_id)
        return 1
    candidates = _given(spark, args)
    threshold, retry = settings.confidence()
    counts: dict[str, int] = {}
    done = pipeline.run(
        rows, _call(settings, args), settings.calls(), candidates, args.start_date, tagging_ops=args.tagging_ops, threshold=threshold, retry=retry, render=not args.no_rendering,
        template=settings.template_text(), generated_by=", ".join(settings.chosen()), counts=counts,
    )
    sinks.save(done, rows, args.output, args.tagged_output)
    for name, n in counts.items():
        config.LOG.info("%s: %d", name, n)
    return 0


def evaluate(spark: SparkSession, args: argparse.Namespace, settings: config.Settings) -> int:
    truth = readers.ground_truth(spark, args.truth)
    candidates = _given(spark, args)
    rates = spark.read.schema("model string, cost_in double, cost_out double").option("header", True).csv(args.rates) if args.rates else spark.createDataFrame([], "model string, cost_in double, cost_out double")
    threshold, retry = settings.confidence()
    found = pipeline.evaluate(_decrees(spark, args), truth, rates, _call(settings, args), settings.calls(), candidates, args.tagging_ops, threshold, retry)
    model = "-".join(settings.chosen()) or "operations"
    path = sinks.run_folder(args.output, time.strftime("%Y-%m-%d_%H-%M"), model)
    sinks.save_scores(found.select(*evaluation.SHEET), path)
    config.LOG.info("sheet: %s", path)
    return 0


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    """0, or 1 with a message where the input or the settings cannot be used."""
    args = parser().parse_args(arguments)
    try:
        settings = config.load(args.settings)
        config.start_logging(settings)
        if spark is None:
            builder = SparkSession.builder.appName("consolida")
            spark = (builder.master(args.master) if args.master else builder).getOrCreate()
        return {"run": run, "evaluate": evaluate}[args.command](spark, args, settings)
    except (config.SettingsError, readers.EmptyFolder) as problem:
        config.LOG.error("%s", problem)
        return 1
