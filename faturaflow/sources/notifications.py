"""New-message notifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faturaflow import schemas
from faturaflow.functions import text


def parse_body(body: Column) -> Column:
    """JSON text of a notification; a body that is no JSON object gives NULL."""
    return F.from_json(body, schemas.NOTIFICATION)


def message_ids(batches: DataFrame, value: str = "value", ts: str | None = "ts") -> DataFrame:
    """One row per event of every batch; a batch without `value` gives none.

    The outer form keeps Catalyst from deriving a filter on the array, which would
    parse a JSON body twice.
    """
    keep = [F.col(ts).cast("timestamp").alias("ts")] if ts else []
    events = batches.select(*keep, F.explode_outer(value).alias("event"))
    return events.filter(F.col("event").isNotNull()).select(
        text.message_id(text.last_segment(F.col("event.resource"))).alias("message_id"),
        *(["ts"] if ts else []),
    )


def distinct_ids(events: DataFrame) -> DataFrame:
    """First arrival per message id. Partial aggregation shrinks an id that repeats often
    to one row per task before the shuffle."""
    return events.groupBy("message_id").agg(F.min("ts").alias("ts"))


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.NOTIFICATION).json(path)
