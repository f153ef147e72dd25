"""Writers of the output tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.plans.outputs import csv_mirror


def _loose(t: T.DataType) -> T.DataType:
    """t with all of its fields nullable: a cast can't promise more."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _loose(f.dataType)) for f in t])
    return T.ArrayType(_loose(t.elementType)) if isinstance(t, T.ArrayType) else t


def conformed(d: DataFrame, schema: T.StructType) -> DataFrame:
    """d's columns in the schema's order and types; a missing one is an error."""
    return d.select(*(F.col(f.name).cast(_loose(f.dataType)).alias(f.name) for f in schema))


def append(d: DataFrame, target: str, schema: T.StructType, fmt: str = "parquet") -> None:
    conformed(d, schema).write.mode("append").format(fmt).save(target)


def write_run(d: DataFrame, target: str, schema: T.StructType, fmt: str = "parquet") -> None:
    """Append a run's rows, in place of what an earlier attempt of the same run left: a run is a partition of the table, by
    process and execution, and only the partitions that d has are written anew. Other runs' rows stay as they are."""
    conformed(d, schema).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*_run_of(schema)).format(fmt).save(target)


def _run_of(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if f.name in ("process_id", "pipeline_exec_id", "pipelinex_exec_id")]


def read(spark: SparkSession, target: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A table that write_run or append has written, its columns in the schema's order and types (the names of partitions
    would tell numbers from words by their looks)."""
    loose = T.StructType([T.StructField(f.name, _loose(f.dataType)) for f in schema])
    return spark.read.schema(loose).format(fmt).load(target).select(*(f.name for f in schema))


def write_hit_summary(d: DataFrame, target: str, fmt: str = "parquet") -> None:
    write_run(d, target, schemas.LEXICON_HIT_SUMMARY, fmt)


def write_hit_detail(d: DataFrame, target: str, restricted: bool, fmt: str = "parquet") -> None:
    write_run(d.filter(F.col("restricted") == restricted), target, schemas.LEXICON_HIT_DETAIL, fmt)


def write_feature_hit_summary(d: DataFrame, target: str, fmt: str = "parquet") -> None:
    write_run(d, target, schemas.FEATURE_HIT_SUMMARY, fmt)


def stage_row(spark: SparkSession, process_id: str, trigger: str, exec_id: str, stage: str, status: str, start: dt.datetime, end: dt.datetime | None, error_count: str | None, error: str | None, day: dt.date) -> DataFrame:
    row = (process_id, trigger, exec_id, stage, None, None, None, None, start, end, status, error_count, error, None, day)
    return spark.createDataFrame([row], schemas.STAGE_AUDIT)


def stage_rows(runs: DataFrame, stage: str) -> DataFrame:
    """The stage audit of many runs (process_id, trigger_type, exec_id, start_time, end_time, error), as jobs leave it: a row
    when each began, and one when it ended, with the error where it failed."""
    said = lambda status, end, count, error: F.struct(F.lit(status).alias("job_status"), end.alias("end_time"), count.cast("string").alias("error_count"), error.cast("string").alias("error_message"))
    failed, none = F.col("error").isNotNull(), F.lit(None)
    ended = F.when(failed, said("FAILED", F.col("end_time"), F.lit("0"), F.col("error"))).otherwise(said("SUCCESS", F.col("end_time"), none, none))
    d = runs.withColumn("x", F.explode(F.array(said("IN_PROGRESS", F.lit(None).cast(runs.schema["end_time"].dataType), none, none), ended)))
    own = {"process_id": "process_id", "trigger_type": "trigger_type", "pipelinex_exec_id": "exec_id", "start_time": "start_time", **{c: f"x.{c}" for c in ("job_status", "end_time", "error_count", "error_message")}}
    cols = [F.col(own[f.name]) if f.name in own else F.lit(stage) if f.name == "stage_name" else F.to_date("start_time") if f.name == "execution_date" else F.lit(None) for f in schemas.STAGE_AUDIT]
    return d.filter("x.job_status = 'IN_PROGRESS' or end_time is not null").select(*(c.cast(_loose(f.dataType)).alias(f.name) for c, f in zip(cols, schemas.STAGE_AUDIT, strict=True)))


def write_stage_audit(d: DataFrame, target: str, fmt: str = "parquet") -> None:
    """Appended: every attempt of a run has its own rows."""
    append(d, target, schemas.STAGE_AUDIT, fmt)


def write_record_audit(d: DataFrame, target: str, fmt: str = "parquet") -> None:
    """Nothing is written where nothing failed."""
    if not d.isEmpty():
        write_run(d, target, schemas.RECORD_AUDIT, fmt)


def write_csv_mirror(detail: DataFrame, target: str) -> None:
    """Restricted details as one CSV part with a header, in place of what is there. Spark makes target a folder."""
    csv_mirror(detail).repartition(1).write.mode("overwrite").option("header", True).csv(target)
