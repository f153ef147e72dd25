"""Locations and run configuration: object URIs, lexicon folders, runtime arguments, table names."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_URI = re.compile(r"^gs://([^/]+)/(.+)$")


def parse_uri(uri: str) -> tuple[str, str]:
    """(bucket, object) of gs://bucket/object; anything else is an error."""
    m = _URI.match(uri or "")
    if not m:
        raise ValueError(f"not a gs:// URI: {uri}")
    return m[1], m[2]


def uri_parts(uri: Column) -> Column:
    """struct(bucket, object) of gs://bucket/object; null for anything else."""
    pattern = r"^gs://([^/]+)/(.+)$"
    return F.when(uri.rlike(pattern), F.struct(F.regexp_extract(uri, pattern, 1).alias("bucket"), F.regexp_extract(uri, pattern, 2).alias("object")))


def file_system(spark: SparkSession, path: str):
    """A path as Hadoop's, and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = file_system(spark, path)
    return fs.exists(p)


def list_children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below path, in order; none if path isn't there."""
    p, fs = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def list_objects(spark: SparkSession, path: str) -> list[str]:
    """All files below path."""
    p, fs = file_system(spark, path)
    it, out = fs.listFiles(p, True), []
    while it.hasNext():
        out.append(it.next().getPath().toString())
    return sorted(out)


def state(spark: SparkSession, path: str) -> list[str]:
    """Every file below path with its size and time, in order: it tells whether what is there is still the same."""
    p, fs = file_system(spark, path)
    if not fs.exists(p):
        return []
    it, out = fs.listFiles(p, True), []
    while it.hasNext():
        f = it.next()
        out.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return sorted(out)


def literal(path: str) -> str:
    """A path for Spark's readers, whose names may have what they would take for a pattern of names."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def file_name(path: Column) -> Column:
    """The name of a file, of its path as Spark gives it: written as a URI, in which a plus is a plus."""
    return F.url_decode(F.replace(F.substring_index(path, "/", -1), F.lit("+"), F.lit("%2B")))


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(literal(path), wholetext=True).first()[0]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, in place of what is there."""
    p, fs = file_system(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_bytes(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.format("binaryFile").load(literal(path)).select("content").first()[0])


def latest_folder(folders: DataFrame, policy_engine_id: str) -> DataFrame:
    """One row, folder: the greatest of the names (column name) that end with _<policy_engine_id>; null if none does."""
    return folders.filter(F.col("name").endswith(f"_{policy_engine_id}")).agg(F.max("name").alias("folder"))


def resolve_base(spark: SparkSession, root: str, policy_engine_id: str) -> str:
    """The latest lexicon folder below root, with a slash at its end. One listing; none that fits is an error."""
    names = [n for n in list_children(spark, root) if n.endswith(f"_{policy_engine_id}")]
    if not names:
        raise FileNotFoundError(f"no folder for policy engine {policy_engine_id} below {root}")
    return f"{root.rstrip('/')}/{max(names)}/"


def _below(base: str, feature: str, suffix: str) -> str:
    if not base.endswith("/"):
        raise ValueError(f"a base path ends with a slash: {base}")
    if not (feature or "").strip():
        raise ValueError("a feature name must not be blank")
    return base + feature + suffix


def below(base: Column, feature: Column, suffix: str) -> Column:
    """The same for columns; null where the base lacks its slash or the name is blank."""
    return F.when(base.endswith("/") & (F.trim(F.coalesce(feature, F.lit(""))) != ""), F.concat(base, feature, F.lit(suffix)))


def patterns_path(base: str, feature: str) -> str:
    return _below(base, feature, ".hdb")


def terms_path(base: str, feature: str) -> str:
    return _below(base, feature, "-compile-results.json")


def expressions_path(base: str, feature: str) -> str:
    return _below(base, feature, "-expressions.json")


@dataclass(frozen=True)
class Dataset:
    dataset_id: str
    dataset_partition_value: str


@dataclass(frozen=True)
class RuntimeArgs:
    dataset_details: tuple[Dataset, ...]
    feature_partition_value: str
    pipeline_exec_id: str
    policy_engine_id: str
    process_id: str
    trigger_type: str

    @classmethod
    def parse(cls, text: str) -> RuntimeArgs:
        """From JSON. Unknown keys are left out; a missing one is an error."""
        d = json.loads(text)
        sets = tuple(Dataset(x["dataset_id"], x["dataset_partition_value"]) for x in d["dataset_details"])
        return cls(sets, *(d[k] for k in ("feature_partition_value", "pipeline_exec_id", "policy_engine_id", "process_id", "trigger_type")))


@dataclass(frozen=True)
class TableConfig:
    """Where the view is read from and each output table goes."""

    tables: dict[str, str] = field(default_factory=dict)

    @classmethod
    def parse(cls, text: str) -> TableConfig:
        return cls({str(k): str(v) for k, v in json.loads(text).items()})

    def __getitem__(self, name: str) -> str:
        if name not in self.tables:
            raise KeyError(f"no table for {name}")
        return self.tables[name]


@dataclass(frozen=True)
class Settings:
    """Where a deployment keeps things: roots of messages by trigger type, the root of lexicon folders, the attachments'
    limit in bytes of UTF-8 (null: none), the format of messages, view and output tables, and who the rows are by."""

    message_roots: dict[str, str]
    lexicon_root: str
    attachment_limit: int | None = None
    fmt: str = "parquet"
    created_by: str = "tidemark"
    #: where it isn't that of the tables: avro, for one
    message_fmt: str | None = None

    @classmethod
    def parse(cls, text: str) -> Settings:
        """From JSON. Unknown keys are left out; missing roots are an error."""
        d = json.loads(text)
        return cls({str(k): str(v) for k, v in d["message_roots"].items()}, d["lexicon_root"], d.get("attachment_limit"), d.get("format", "parquet"), d.get("created_by", "tidemark"), d.get("message_format"))


def message_bucket(buckets: dict[str, str], trigger_type: str) -> str:
    """The bucket of a trigger type; an unknown one is an error."""
    if trigger_type not in buckets:
        raise ValueError(f"unknown trigger type: {trigger_type}")
    return buckets[trigger_type]
