"""Shared pieces: words of a text, checkpoints, joins that stand hot keys, dropping rows by key.

Row identity: `doc_id` need not be unique and may be null, so rows are told apart by
(`doc_id`, XXH64 of the text). Rows equal in both are the same document listed again.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faturaflow.llm.bitplanes import RepeatFilter
from faturaflow.operators.joins import lookup_join
from faturaflow.sources.stage import shared_root

#: White space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
GAP = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"

#: Largest table that is broadcast; its rows are counted first.
BROADCAST_ROWS = 100_000


def words(text: Column) -> Column:
    """Maximal runs of characters that are not white space; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def own_names(*results: str):
    """For f(docs, ...): columns of `docs` that could clash with inner ones (those that start with
    an underscore, and `results`) have other names inside, and their own in the result."""

    def wrap(f):
        @wraps(f)
        def run(docs: DataFrame, *args, **how) -> DataFrame:
            other = {
                c: f"own{i}_{c}"
                for i, c in enumerate(docs.columns)
                if c.startswith("_") or c in results
            }
            out = f(docs.withColumnsRenamed(other), *args, **how)
            return out.withColumnsRenamed({v: k for k, v in other.items()})

        return run

    return wrap


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage in the shared folder of spark.checkpoint.dir (set here only if unset)."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint()


def hot_lookup(
    rows: DataFrame, directory: DataFrame, key: str, count: str, total: int, spread_by: str
) -> DataFrame:
    """Left join to a table with one row per `key`, where `count` says how many rows have the key.

    Fewer than 1,000 keys can each hold over a thousandth of `total` rows, so those are
    broadcast; the rest meet in a shuffle join, where no key has more than that share. Rows
    with a broadcast key are spread over all its partitions by `spread_by`.
    """
    values = [c for c in directory.columns if c != key]
    limit = max(1, total // 1000)
    hot = directory.filter(F.col(count) > limit)
    hot = hot.select(
        F.col(key).alias("_hot_key"), *[F.col(c).alias(f"_hot_{c}") for c in values]
    )
    cold = directory.filter(F.col(count) <= limit)
    cold = cold.select(
        F.col(key).alias("_cold_key"), *[F.col(c).alias(f"_cold_{c}") for c in values]
    )
    first = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    first = first.withColumn("_cold_key", F.when(F.col("_hot_key").isNull(), F.col(key)))
    both = lookup_join(first, cold, ["_cold_key"], "left", spread_by=spread_by)
    return both.select(
        *rows.columns, *[F.coalesce(f"_hot_{c}", f"_cold_{c}").alias(c) for c in values]
    )


def small_or_shuffled(small: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table of at most BROADCAST_ROWS counted rows; a larger one is shuffled."""
    return F.broadcast(small) if rows <= BROADCAST_ROWS else small


def key_halves(*cols: Column | str) -> tuple[Column, Column]:
    """Two 64-bit hashes of a key."""
    return F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols)


@own_names()
def drop_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """`docs` without the rows whose (doc_id, text hash) is in `dropped` (doc_id, _th).

    `dropped` is checkpointed by the caller. Only rows that a Bloom filter of the dropped
    keys may hold are shuffled, for the exact test; all others pass straight through.
    """
    keyed = docs.withColumn("_th", text_hash(F.col("text")))
    n = dropped.count()
    if n == 0:
        return docs
    halves = dropped.select(*[h.alias(c) for h, c in zip(key_halves("doc_id", "_th"), "ab")])
    maybe = RepeatFilter.build(halves, n, seen=1).test(*key_halves("doc_id", "_th"))
    keyed = keyed.withColumn("_maybe", maybe)
    keys = dropped.select(F.col("doc_id").alias("_id"), F.col("_th").alias("_h")).distinct()
    exact = keyed.filter("_maybe").join(
        keys, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_h")), "left_anti"
    )
    return keyed.filter("not _maybe").unionByName(exact).select(*docs.columns)
