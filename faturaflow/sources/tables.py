"""ERP tables as narrow DataFrames with ASCII column names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faturaflow.schemas import ERP_COLUMNS


def narrow(df: DataFrame, table: str) -> DataFrame:
    """Only the columns the job reads, renamed. The projection reaches the scan."""
    cols = ERP_COLUMNS[table]
    return df.select(
        *(F.col(f"`{theirs}`").cast("string").alias(ours) for ours, theirs in cols.items())
    )


def read_table(spark: SparkSession, table: str, path: str, fmt: str = "parquet") -> DataFrame:
    return narrow(spark.read.format(fmt).load(path), table)


def jdbc_options(
    url: str,
    dbtable: str,
    *,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    fetch_size: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a parallel JDBC read: `partitions` range queries, none of them whole."""
    return {
        "url": url,
        "dbtable": dbtable,
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
        "pushDownPredicate": "true",
        **(properties or {}),
    }


def read_jdbc(spark: SparkSession, table: str, options: Mapping[str, str]) -> DataFrame:
    return narrow(spark.read.format("jdbc").options(**options).load(), table)


#: Sampled keys per range: a range then holds within about a third of its share of the rows.
SAMPLED = 64


def key_bounds(df: DataFrame, column: str, ranges: int, sampled: int = SAMPLED) -> list[str]:
    """Keys that cut a table into at most `ranges` of about equal rows, in Spark's order of texts.

    Keys of rows drawn at random, `sampled` for each range: every task keeps its own and sends no
    more, and so many reach the driver. A key that makes up more than a range's share is in a range
    of its own with the keys up to the next bound; a range is never split within a key.
    """
    k = ranges * sampled
    drawn = df.select(F.col(column).cast("string").alias("key"), F.rand(7).alias("place")).dropna()
    keys = sorted(r["key"] for r in drawn.orderBy("place").limit(k).collect())
    cuts = {keys[i * len(keys) // ranges] for i in range(1, ranges)} if keys else set()
    return sorted(cuts - {keys[0]} if keys else cuts)


def key_ranges(df: DataFrame, column: str, bounds: Sequence[str]) -> list[DataFrame]:
    """The table by the ranges of key_predicates, for a source that Spark reads itself."""
    key = F.col(column).cast("string")
    if not bounds:
        return [df]
    between = [(key >= a) & (key < b) for a, b in zip(bounds, bounds[1:])]
    return [df.filter(p) for p in [(key < bounds[0]) | key.isNull(), *between, key >= bounds[-1]]]


def key_predicates(column: str, bounds: Sequence[str]) -> list[str]:
    """Conditions that put every row of a table into one partition, by ranges of a text key.

    `bounds` are keys in the database's own order, such as every n-th key of an index; rows
    without a key go with the first range.
    """
    name = '"' + column.replace('"', '""') + '"'
    texts = ["'" + b.replace("'", "''") + "'" for b in bounds]
    if not texts:
        return ["1 = 1"]
    between = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(texts, texts[1:])]
    return [f"{name} < {texts[0]} OR {name} IS NULL", *between, f"{name} >= {texts[-1]}"]


def read_jdbc_by_key(
    spark: SparkSession,
    table: str,
    url: str,
    dbtable: str,
    predicates: Sequence[str],
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A parallel read of a table whose key is text: one partition per condition."""
    rows = spark.read.jdbc(url, dbtable, predicates=list(predicates), properties=dict(properties or {}))
    return narrow(rows, table)
