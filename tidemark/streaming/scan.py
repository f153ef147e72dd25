"""The matcher on a stream of messages. Matching has no state: each message is scanned once, when it comes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import Expression, scan
from tidemark.operators.decide import areas


def scan_stream(messages: DataFrame, expressions: list[Expression], features: list[str], attachment_limit: int | None = None) -> DataFrame:
    """Raw matches of a (streaming) DataFrame of messages in the given pattern sets, in all areas."""
    d = areas(messages, attachment_limit).withColumn("features", F.array(*map(F.lit, features)))
    return scan(d, expressions)
