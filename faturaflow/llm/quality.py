"""Quality rules: surface rules, and an n-gram log-likelihood ratio.

Two multinomials over hashed word 1- and 2-grams are counted from all documents: a target one
from the documents that the labels call good, and a raw one from the whole corpus. There are more
buckets the larger the corpus is. A document's score is the mean log ratio of its n-grams; a fixed threshold decides on every document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faturaflow.llm.common import SPACES, own_names, small_or_shuffled, words

#: The contract's surface rules.
SYMBOLS, LEAST_WORDS, REPEAT_WINDOW, MOST_REPEATED = "#*$%&|<>", 20, 8, 30
#: Least number of hash buckets of the multinomials, the bytes of text they are for, and the least
#: mean log ratio (nats per n-gram).
BUCKETS, BUCKETS_FOR, LEAST_SCORE = 1 << 14, 1 << 28, -0.12
SURFACE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def _settled(rows: DataFrame, kept: list[str], new: list[str]) -> DataFrame:
    """`kept` columns and the computed ones `new`, which come out of a generator: filters and
    projections on them stay above it, so that no later step computes them once more."""
    held = [f"_s{i}" for i in range(len(new))]
    struct = F.struct(*[F.col(c).alias(h) for c, h in zip(new, held)])
    out = rows.select(*kept, F.inline(F.array(struct)))
    return out.select(*kept, *[F.col(h).alias(c) for c, h in zip(new, held)])


def surface(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    return _settled(_measured(docs), [c for c in docs.columns if c not in SURFACE], SURFACE)


def _measured(docs: DataFrame) -> DataFrame:
    """With the columns of SURFACE, and _words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.withColumn("_words", words(F.col("text")))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    rows = rows.withColumns(
        {
            "_lines": lines,
            "_h": F.transform("_words", lambda w: F.xxhash64(w)),
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long"),
        }
    )
    last = F.col("n_words").cast("int") - REPEAT_WINDOW
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    window = F.transform(
        at, lambda i: F.xxhash64(*[F.get("_h", i + k) for k in range(REPEAT_WINDOW)])
    )
    rows = rows.withColumns(
        {
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_runs": window,
        }
    )
    # Windows with equal ones next to them, once sorted by hash; only for texts that have any.
    some = F.size(F.array_distinct("_runs")) < F.size("_runs")
    placed = F.transform("_runs", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    rows = rows.withColumn(
        "_sorted",
        F.when(some, F.array_sort(placed)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")),
    )
    edge = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
    n = F.size("_sorted")
    before = F.when(n > 0, F.concat(edge, F.slice("_sorted", F.lit(1), F.greatest(n - 1, F.lit(0))))).otherwise(F.col("_sorted"))
    after = F.when(n > 0, F.concat(F.slice("_sorted", F.lit(2), n), edge)).otherwise(F.col("_sorted"))
    left = F.zip_with("_sorted", before, lambda x, y: F.when(x["h"] == y["h"], x["i"]))
    both = F.zip_with(
        F.zip_with("_sorted", after, lambda x, y: F.when(x["h"] == y["h"], x["i"])),
        left,
        lambda x, y: F.coalesce(x, y),
    )
    rows = rows.withColumn("_repeats", F.array_sort(F.array_compact(both)))
    # Words covered: each repeated window adds what the next one does not cover.
    following = F.concat(F.slice("_repeats", F.lit(2), F.greatest(F.size("_repeats"), F.lit(1))), F.array(F.lit(1 << 30)))
    covered = F.aggregate(
        F.zip_with(
            "_repeats",
            following,
            lambda x, y: F.when(x.isNull(), 0).otherwise(F.least(y - x, F.lit(REPEAT_WINDOW))),
        ),
        F.lit(0),
        lambda a, b: a + b,
    )
    rows = rows.withColumn("n_repeat_words", covered.cast("long"))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED
    )
    return rows.withColumn("base_failed", failed)


def bucket_count(size: int) -> int:
    """Buckets for `size` bytes of text: a power of two that grows with the cube root, as the tasks'
    counts of all buckets are shuffled: 2**17 at 30 GB, 2**21 at 100 TB."""
    return BUCKETS << max(0, math.ceil(math.log2(max(1, size) / BUCKETS_FOR) / 3))


def _buckets(word: Column, count: int) -> Column:
    """Bucket of every 1-gram and 2-gram of an array of words."""
    bucket = lambda *w: F.pmod(F.xxhash64(*w), F.lit(count)).cast("int")
    pairs = F.zip_with(
        word,
        F.slice(word, F.lit(2), F.greatest(F.size(word), F.lit(1))),
        lambda a, b: F.when(b.isNotNull(), bucket(a, b)),
    )
    return F.concat(F.transform(word, lambda w: bucket(w)), F.array_compact(pairs))


def log_ratios(docs: DataFrame, good: DataFrame) -> list[float]:
    """log P(bucket | target) - log P(bucket | corpus), counted over every document.

    good: doc_id of the target documents. Add-one smoothing. A row a bucket reaches the driver;
    the corpus' size decides how many buckets there are.
    """
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = bucket_count(size)
    good = good.filter("doc_id is not null").select(F.col("doc_id").alias("_good")).distinct()
    flagged = docs.select("doc_id", "text").join(
        small_or_shuffled(good, good.count()), F.col("doc_id") == F.col("_good"), "left"
    )
    lowered = flagged.select("_good", words(F.lower("text")).alias("_words"))
    grams = lowered.select(
        F.col("_good").isNotNull().alias("target"), F.explode(_buckets(F.col("_words"), buckets)).alias("bucket")
    )
    counts = grams.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("raw"), F.count_if("target").alias("target")
    )
    raw, target = [1.0] * buckets, [1.0] * buckets
    for r in counts.toLocalIterator():
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    if sum(target) <= buckets:  # no target: nothing to compare with
        return [0.0] * buckets
    return _log_ratio(target, raw)


def _log_ratio(target: list[float], raw: list[float]) -> list[float]:
    shift = math.log(sum(raw)) - math.log(sum(target))
    return [math.log(t) - math.log(r) + shift for t, r in zip(target, raw)]


@own_names()
def quality(docs: DataFrame, good: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """All rows and columns of `docs` with the counts, base_failed, score and kept.

    A null text has no words and fails the surface rules; a text without n-grams scores 0.
    Words are lower-cased for the score. Repeated rows are judged alike. Without target
    documents every score is 0. Columns of `docs` with the names of new ones are replaced.
    """
    found = log_ratios(docs, good)
    ratios = F.split(F.lit(",".join(f"{x:.9g}" for x in found)), ",").cast("array<double>")
    mine = [c for c in docs.columns if c not in (*SURFACE, "score", "kept")]
    rows = _measured(docs.select(*mine))
    rows = rows.withColumn("_lower", words(F.lower("text"))).withColumn("_grams", _buckets(F.col("_lower"), len(found)))
    total = F.aggregate("_grams", F.lit(0.0), lambda a, b: a + F.get(ratios, b))
    score = F.when(F.size("_grams") > 0, total / F.size("_grams")).otherwise(0.0)
    rows = _settled(rows.withColumn("score", score), mine, [*SURFACE, "score"])
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= least))


def op2_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: the contract's columns, and score."""
    good = labels.filter(F.col("quality") == 1).select("doc_id")
    return quality(docs.select("doc_id", "text"), good).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score",
    )
