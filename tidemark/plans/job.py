"""The batch job: arguments, audit of its stage, and all tables."""

from __future__ import annotations

import dataclasses
import datetime as dt
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import Expression
from tidemark.operators.definitions import check_definitions
from tidemark.plans import outputs, sinks
from tidemark.sources import paths, tables
from tidemark.sources.paths import RuntimeArgs, Settings, TableConfig
from tidemark.store import materialise, shared_dir

STAGE = "SCAN"


def run(
    spark: SparkSession,
    args: RuntimeArgs,
    config: TableConfig,
    read_view: Callable[[], DataFrame],
    read_messages: Callable[[str, str, DataFrame], DataFrame],
    load_lexicon: Callable[[list[str]], tuple[DataFrame, list[Expression]]],
    attachment_limit: int | None = None,
    now: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
    fmt: str = "parquet",
    created_by: str = "tidemark",
    inputs: Callable[[], str] | None = None,
) -> None:
    """Scan all datasets of the arguments and append the tables named in config. A row of the stage audit says that the
    job began, another how it ended; a failure is raised again after that. read_messages(dataset_id, partition, ids)
    gives a dataset's messages; load_lexicon(features) the terms and expressions of the features that the view names.
    A run that was stopped anywhere may be started again: its tables have each of its rows once then. inputs() names all
    that is read; a run with the name of one that failed behind its evaluation goes on from there without scanning."""
    start = now()

    def audit(status: str, end: dt.datetime | None = None, count: str | None = None, error: str | None = None) -> None:
        row = sinks.stage_row(spark, args.process_id, args.trigger_type, args.pipeline_exec_id, STAGE, status, start, end, count, error, start.date())
        sinks.write_stage_audit(row, config["pipeline_stage_audit"], fmt)

    audit("IN_PROGRESS")
    try:
        view = read_view()
        parts = [tables.view_rows(view, d.dataset_partition_value, args.feature_partition_value, args.process_id) for d in args.dataset_details]
        rows = tables.union_views(parts).persist()
        check_definitions(rows)
        terms, expressions = load_lexicon(tables.features_of(rows))
        ids = materialise(rows.select("message_id").distinct(), "ids")
        messages = tables.union_messages([read_messages(d.dataset_id, d.dataset_partition_value, ids) for d in args.dataset_details])
        left = inputs and f"{shared_dir(spark)}/tidemark/evaluations/{inputs()}.json"
        r = outputs.Result.kept(spark, left) if left else None
        if r is None:
            r = outputs.evaluate(messages, rows, terms, expressions, attachment_limit)
            if left:
                r.keep(left)
        stamp, day = F.lit(now()).cast("timestamp"), F.lit(start.date())
        exec_id = args.pipeline_exec_id
        sinks.write_hit_summary(outputs.hit_summary(r, exec_id, created_by, stamp), config["lexicon_hit_summary"], fmt)
        detail = outputs.hit_detail(r, exec_id, created_by, stamp).persist()
        sinks.write_hit_detail(detail, config["lexicon_hit_restricted"], True, fmt)
        sinks.write_hit_detail(detail, config["lexicon_hit_unrestricted"], False, fmt)
        hit_type = rows.groupBy("message_id").agg(F.min_by("feature_tagging_type", F.struct("feature_id", "features_to_apply", "sub_feature_type")).alias("hit_type"))
        typed = dataclasses.replace(r, messages=r.messages.join(hit_type, "message_id", "left"))
        sinks.write_feature_hit_summary(outputs.feature_hit_summary(typed, F.col("hit_type"), exec_id, created_by, stamp), config["feature_hit_summary"], fmt)
        sinks.write_record_audit(outputs.record_audit(r, args.trigger_type, exec_id, STAGE, created_by, day, stamp), config["pipeline_record_audit"], fmt)
        sinks.write_csv_mirror(detail, config["csv_mirror"])
        detail.unpersist()
        rows.unpersist()
        if left:
            r.drop(left)
    except Exception as e:
        audit("FAILED", now(), "0", f"{type(e).__name__}: {e}")
        raise
    audit("SUCCESS", now())


def run_files(spark: SparkSession, args: RuntimeArgs, config: TableConfig, settings: Settings, **more) -> None:
    """The job over a deployment's folders: messages below the root of the trigger type, the view named feature_decision_view
    in config, the lexicon in the latest folder of the policy engine."""
    root = paths.message_bucket(settings.message_roots, args.trigger_type)

    def inputs() -> str:
        base = paths.resolve_base(spark, settings.lexicon_root, args.policy_engine_id)
        told = hashlib.sha256(repr((args, settings)).encode())
        for path in (config["feature_decision_view"], base, *(f"{root.rstrip('/')}/{d.dataset_id}/{d.dataset_partition_value}" for d in args.dataset_details)):
            told.update("\n".join(paths.state(spark, path)).encode())
        return told.hexdigest()

    def lexicon(features: list[str]) -> tuple[DataFrame, list[Expression]]:
        return tables.load_lexicon(spark, paths.resolve_base(spark, settings.lexicon_root, args.policy_engine_id))(features)

    run(
        spark, args, config,
        lambda: spark.read.format(settings.fmt).load(config["feature_decision_view"]),
        lambda ds, part, ids: tables.read_dataset(spark, root, ds, part, ids, settings.message_fmt or settings.fmt),
        lexicon, settings.attachment_limit, fmt=settings.fmt, created_by=settings.created_by, inputs=inputs, **more,
    )
