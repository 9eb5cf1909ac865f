"""Mixing sources to target weights: hash-random order, prefix sums, a cut at the exact budget.

Documents have a random place from a hash, and a range of places is a bucket. Word counts are
summed by source and bucket, and prefix sums over these few rows find the bucket in which a
source's budget ends. Only the documents of these buckets are sorted and summed one by one, so
neither a hot source nor its documents ever meet in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from faturaflow.llm.common import (
    checkpointed,
    own_names,
    small_or_shuffled,
    text_hash,
    words,
)

#: The contract: weights repeat over the sources in order; share of all words; epochs at most.
WEIGHTS, SHARE, EPOCHS = (5, 2, 1), 1.5, 2.0
#: Hex digits of the place that make buckets.
DIGITS = 7


def _place() -> Column:
    return F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, and the random place (_key, then doc_id and text hash)."""
    return docs.select(
        "doc_id",
        "source",
        F.size(words(F.col("text"))).cast("long").alias("size"),
        _place().alias("_key"),
        text_hash(F.col("text")).alias("_th"),
    )


def targets(sources: DataFrame, weights=WEIGHTS, share=SHARE, epochs=EPOCHS) -> DataFrame:
    """Adds `weight` and `target` to one row per source (source, source_size).

    The budget, `share` of all words, is split by weight; a target stops at `epochs` times its
    source's size, and the excess is reshared by weight. With sources sorted by cap per weight
    the capped ones come first, so prefix sums give the level of all others.
    """
    place = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    at = (F.row_number().over(place) - 1) % len(weights)
    cap = F.col("source_size") * F.lit(float(epochs))
    rows = sources.withColumn("weight", F.get(cycle, at)).withColumn("_cap", cap)
    by = W.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = W.partitionBy()
    before = by.rowsBetween(W.unboundedPreceding, -1)
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    left = budget - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    heavy = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumn("_level", left / heavy)
    rows = rows.withColumn("_free", F.col("_cap") > F.col("_level") * F.col("weight"))
    level = F.min(F.when(F.col("_free"), F.struct(F.col("_cap") / F.col("weight"), "_level"))).over(everything)
    target = F.when(F.col("_free"), F.col("weight") * level["_level"]).otherwise(F.col("_cap"))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def cuts(docs: DataFrame, weights=WEIGHTS, share=SHARE, epochs=EPOCHS) -> DataFrame:
    """One row per source: source_size, target, whole epochs, and where the last epoch is cut.

    Documents before (`_cut_key`, `_cut_id`, `_cut_th`) are taken once more; the one there gives
    `_part` words, which makes the source's sum exactly floor(target).
    """
    rows = sized(docs)
    n = docs.count()
    # As many buckets as a bucket has documents: neither is more than a root of the input.
    buckets = min(16**DIGITS, math.isqrt(n) + 1)
    place = F.conv(F.substring("_key", 1, DIGITS), 16, 10).cast("long")
    rows = rows.withColumn("_bucket", (place * buckets / 16**DIGITS).cast("long"))
    # Sums per bucket: partial aggregates leave a row per task, source and bucket.
    sums = checkpointed(rows.groupBy("source", "_bucket").agg(F.sum("size").alias("n")))
    sources = sums.groupBy("source").agg(F.sum("n").alias("source_size"))
    plan = targets(sources, weights, share, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size")))
    plan = plan.withColumn("_epochs", F.coalesce(whole, F.lit(0)).cast("long"))
    rest = F.floor("target") - F.col("_epochs") * F.col("source_size")
    plan = checkpointed(plan.withColumn("_rest", rest.cast("long")))
    count = plan.count()

    renamed = plan.select(F.col("source").alias("_s"), "_rest")
    same = F.col("source").eqNullSafe(F.col("_s"))
    order = W.partitionBy("source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    running = sums.withColumn("_before", F.coalesce(F.sum("n").over(order), F.lit(0)))
    last = (
        running.join(small_or_shuffled(renamed, count), same)
        .filter("_before <= _rest and _rest < _before + n")
        .select(F.col("source").alias("_s"), F.col("_bucket").alias("_b"), "_before", "_rest")
    )
    within = rows.join(
        small_or_shuffled(last, count), same & (F.col("_bucket") == F.col("_b"))
    )
    # Identical rows have one place: they are summed first.
    exact = within.groupBy("source", "_key", "doc_id", "_th", "_before", "_rest").agg(
        F.sum("size").alias("n"), F.count(F.lit(1)).alias("copies")
    )
    order = W.partitionBy("source").orderBy("_key", "doc_id", "_th")
    order = order.rowsBetween(W.unboundedPreceding, -1)
    exact = exact.withColumn("_start", F.col("_before") + F.coalesce(F.sum("n").over(order), F.lit(0)))
    exact = exact.filter("_start <= _rest and _rest < _start + n").select(
        F.col("source").alias("_s"),
        F.col("_key").alias("_cut_key"),
        F.col("doc_id").alias("_cut_id"),
        F.col("_th").alias("_cut_th"),
        F.floor((F.col("_rest") - F.col("_start")) / F.col("copies")).cast("long").alias("_part"),
    )
    return checkpointed(plan.join(exact, same, "left").drop("_s", "_rest", "weight"))


def _taken() -> Column:
    mine = F.struct("_key", F.col("doc_id").alias("i"), F.col("_th").alias("h"))
    cut = F.struct(
        F.col("_cut_key").alias("_key"), F.col("_cut_id").alias("i"), F.col("_cut_th").alias("h")
    )
    more = F.when(F.col("_cut_key").isNull(), 0).when(mine < cut, F.col("size"))
    more = more.when(mine == cut, F.col("_part")).otherwise(0)
    return (F.col("_epochs") * F.col("size") + more).cast("long")


@own_names()
def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE, epochs=EPOCHS) -> DataFrame:
    """All rows and columns of `docs` with size, source_size, target and taken (its words in the mix).

    Whole epochs take every document of a source; the last one takes documents in a random
    order fixed by doc_id, up to the exact budget, so that one document per source may give
    only its first words. Sources are ordered by code point, a null source last. A document
    without words takes nothing; a null text is empty; rows identical in doc_id and text at the
    cut share its words evenly, rounded down. An empty table gives an empty result. Columns
    of `docs` with the names of new ones are replaced.
    """
    plan = cuts(docs, weights, share, epochs)
    count = plan.count()
    plan = plan.withColumnsRenamed(
        {"source": "_s", "source_size": "_source_size", "target": "_target"}
    )
    mine = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")]
    rows = docs.select(
        *mine,
        F.size(words(F.col("text"))).cast("long").alias("size"),
        _place().alias("_key"),
        text_hash(F.col("text")).alias("_th"),
    )
    joined = rows.join(
        small_or_shuffled(plan, count), F.col("source").eqNullSafe(F.col("_s")), "inner"
    )
    return joined.select(
        *mine,
        "size",
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        _taken().alias("taken"),
    )


@own_names("size", "source_size", "target", "taken")
def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix as rows of `docs`: a document is there once for each time it is taken whole, and once
    more with its first words (joined by one space) if the budget ends in it."""
    rows = mix(docs, **how)
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0)
    part = F.col("taken") - whole * F.col("size")
    parts = F.concat(
        F.array_repeat(F.lit(0).cast("long"), whole.cast("int")),
        F.when(part > 0, F.array(part.cast("long"))).otherwise(F.array().cast("array<long>")),
    )
    out = rows.withColumn("_first", F.explode(parts))
    text = F.when(F.col("_first") == 0, F.col("text")).otherwise(
        F.array_join(F.slice(words(F.col("text")), 1, F.col("_first").cast("int")), " ")
    )
    out = out.withColumn("text", text)
    if "n_chars" in docs.columns:
        chars = F.when(F.col("_first") == 0, F.col("n_chars")).otherwise(F.length("text"))
        out = out.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op10_mix(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    return mix(docs.select("doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, source, text, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, list_extract([5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE],
                CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)) AS weight FROM s),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
                 - coalesce(sum(2.0::DOUBLE * source_size) OVER o, 0)) /
                (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS lv
      FROM w WINDOW o AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT min_by(lv, 2.0::DOUBLE * source_size / weight) AS lv FROM l
      WHERE 2.0::DOUBLE * source_size > lv * weight),
t AS (SELECT source, source_size,
             CASE WHEN 2.0::DOUBLE * source_size > l.lv * weight THEN weight * f.lv
                  ELSE 2.0::DOUBLE * source_size END AS target FROM l LEFT JOIN f ON true),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM t),
p AS (SELECT d.doc_id, size, source_size, target, epochs,
             CAST(floor(target) AS BIGINT) - epochs * source_size AS rest,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, d.doc_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, rest - start)) AS BIGINT) AS taken
FROM p
"""
