"""Exact duplicates by two passes of a Bloom filter.

Pass one counts each text hash, up to two, in a Bloom filter whose partitions merge. In
pass two a row whose hash can not have been seen twice passes straight through; only the
others are shuffled, grouped by hash and compared. A filter has a bounded size; hashes that are too
many for one are cut into ranges, each with a filter and both passes of its own, so that the share of
single rows that shuffle stays the same.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from faturaflow.llm.bitplanes import RepeatFilter
from faturaflow.llm.common import checkpointed, hot_lookup, key_halves, own_names
from faturaflow.sources.stage import Stage


def normalised(text: Column) -> Column:
    """The text without its white space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def _hashed(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(
        *columns,
        F.sha2(normalised(F.col("text")), 256).alias("text_sha256"),
        F.length(F.coalesce("text", F.lit(""))).alias("_len"),
    )


def _flagged(rows: DataFrame, total: int) -> DataFrame:
    """Adds _maybe: false if no other row can have the text_sha256.

    Beyond one range the rows are written sorted by range, and once more with their flags.
    """
    a, b = key_halves("text_sha256")
    n = RepeatFilter.ranges(total)
    if n == 1:
        seen = RepeatFilter.build(rows.select(a.alias("a"), b.alias("b")), total)
        return rows.withColumn("_maybe", seen.test(a, b))
    stage = Stage(rows.sparkSession)
    of = F.pmod(b, F.lit(n)).cast("int")
    table = stage.table("rows", rows.withColumn("_range", of).sortWithinPartitions("_range"))
    parts = []
    for k in range(n):
        part = table.filter(F.col("_range") == k).drop("_range")
        seen = RepeatFilter.build(part.select(a.alias("a"), b.alias("b")), -(-total // n))
        parts.append(stage.table(f"range{k}", part.withColumn("_maybe", seen.test(a, b))))
        seen.drop()
    return reduce(DataFrame.unionByName, parts)


@own_names()
def exact_dedup(docs: DataFrame) -> DataFrame:
    """All rows and columns of `docs` with `keep_id`, `group_size`, `kept`, `text_sha256`.

    Texts are equal when their SHA-256 without white space is. Of equal texts the row with
    the most code points stays, then the one with the smallest doc_id (a null one last).
    Of rows that tie in both, the one whose columns have the smallest hash stays (columns that
    hold a map do not count). A null text counts as empty. An empty table
    gives an empty result. Columns of `docs` with the names of new ones are replaced.
    """
    new = ("keep_id", "group_size", "kept", "text_sha256")
    mine = [c for c in docs.columns if c not in new]
    return _decided(_hashed(docs, *mine), mine, docs.count())


def _decided(rows: DataFrame, mine: list[str], total: int) -> DataFrame:
    """rows: the columns `mine`, with doc_id among them, text_sha256 and _len."""
    rows = _flagged(rows, total)

    alone = rows.filter("not _maybe").select(
        *mine,
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    shuffled = rows.filter("_maybe")
    # Two levels, so that a hot text is reduced to one row in each task before the shuffle.
    per_row = shuffled.groupBy("text_sha256", "_len", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    best = F.max_by(
        F.struct("doc_id", "n", "_len"),
        F.struct("_len", F.col("doc_id").isNotNull(), F.bitwise_not("doc_id")),
    )
    groups = (
        per_row.groupBy("text_sha256")
        .agg(best.alias("_best"), F.sum("n").alias("group_size"))
        .withColumn("_same", F.col("_best.n"))
    )
    joined = hot_lookup(
        shuffled.drop("_maybe"), groups, "text_sha256", "group_size", total, "doc_id"
    )
    is_best = (F.col("_len") == F.col("_best._len")) & F.col("doc_id").eqNullSafe(
        F.col("_best.doc_id")
    )
    out = [*mine, F.col("_best.doc_id").alias("keep_id"), "group_size"]
    clear = joined.filter(~is_best | (F.col("_same") == 1))
    clear = clear.select(*out, is_best.alias("kept"), "text_sha256")
    # Rows with one doc_id and equal texts: the first of them stays.
    plain = [c for c in mine if "map<" not in rows.schema[c].dataType.simpleString()]
    place = F.row_number().over(W.partitionBy("text_sha256").orderBy(F.xxhash64(*plain)))
    tied = joined.filter(is_best & (F.col("_same") > 1)).withColumn("_place", place)
    tied = tied.select(*out, (F.col("_place") == 1).alias("kept"), "text_sha256")
    return alone.unionByName(clear).unionByName(tied)


@own_names("keep_id", "group_size", "kept", "text_sha256")
def drop_copies(docs: DataFrame) -> DataFrame:
    """`docs` with one row of each group of equal texts."""
    return exact_dedup(docs).filter("kept").select(*docs.columns)


def op7_exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = checkpointed(_hashed(docs, "doc_id"))
    return _decided(rows, ["doc_id"], rows.count())


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS h
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER w = 1 AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id)
"""
