"""Toxicity by weak supervision.

1. Voters are mined from a bounded sample of labelled texts: words (lexicon voters) and
   beginnings of words (pattern voters) that toxic texts have far more often.
2. A generative label model sees only their votes: two classes in which each voter fires with a
   probability of its own, fitted by EM. Correlations of votes within the classes are
   estimated too, and a voter that repeats what others say is weighed down.
3. The posterior of the label model trains a linear classifier over many more words and
   beginnings of words. Every document is scored with it, by its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faturaflow.llm.bitplanes import frugal, trim
from faturaflow.llm.common import checkpointed, own_names
from faturaflow.llm.textops import Chunk, chunks, mix, rolling

#: Labelled rows that are sampled at most, by hash; features of the classifier; voters.
SAMPLE, FEATURES, VOTERS = 8_000, 2_048, 64
#: Bytes of a word's beginning that make a pattern; 0 stands for the whole word.
LENGTHS = (0, 4, 5, 6, 7, 8)
#: A feature: toxic documents that have it, and its least ratio of class frequencies (log). A
#: voter: least ratio, and least product of the two.
LEAST_DOCS, LEAST_RATIO, VOTER_RATIO, VOTER_GAIN = 3, 2.0, 4.5, 20.0
THRESHOLD = 0.3

# Letters are a-z and all bytes of other scripts; texts come lower-cased.
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _features(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature hash) of every word of a chunk, for all LENGTHS; repeats included."""
    prefixes = chunk.prefix_hashes([k for k in LENGTHS if k])
    owner = np.repeat(np.arange(len(chunk.first_word) - 1), np.diff(chunk.first_word))
    rows, keys = [owner], [chunk.word_hashes()]
    size = chunk.ends - chunk.starts
    for k, h in prefixes.items():
        rows.append(owner[size >= k])
        keys.append(h)
    return np.concatenate(rows), np.concatenate(keys)


def _distinct(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.ones(len(row), bool)
    new[1:] = (np.diff(row) != 0) | (key[1:] != key[:-1])
    return row[new], key[new]


def _one_per_family(sample: DataFrame) -> pd.DataFrame:
    """(k, toxic) of sampled texts, one of those that share a smallest hash of 8 words: copies would
    make any of their words look like a voter. The sample has at most SAMPLE rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(2), _LETTER):
                hashes = chunk.word_hashes()
                sign = np.zeros((2, len(chunk.first_word) - 1), np.uint64)
                for row, (i, j) in enumerate(zip(chunk.first_word, chunk.first_word[1:])):
                    runs = rolling(hashes[i:j], 8, 0xD6E8FEB86659FD93)
                    if not len(runs):
                        runs = mix(hashes[i:j] + np.uint64(1))
                    if len(runs):
                        sign[:, row] = runs.min(), mix(runs).min()
                part = slice(chunk.first, chunk.last)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part], batch.column(1)[part], *(pa.array(x.view(np.int64)) for x in sign)],
                    ["k", "toxic", "a", "b"],
                )

    rows = sample.select("k", "toxic", "text").mapInArrow(frugal(run), "k long, toxic int, a long, b long")
    rows = rows.toPandas().sort_values("k").drop_duplicates("a").drop_duplicates("b")
    return rows[["k", "toxic"]].reset_index(drop=True)


def _mine(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The best features, best first: (hash, whether it may be a voter).

    Counting is distributed; FEATURES rows reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(0).to_numpy(zero_copy_only=False) == 1
            for chunk in chunks(batch.column(1), _LETTER):
                row, key = _distinct(*_features(chunk))
                key, at = np.unique(key, return_inverse=True)
                pos = np.bincount(at, toxic[chunk.first + row], len(key)).astype(np.int64)
                n = np.bincount(at, minlength=len(key)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(pos), pa.array(n - pos)],
                    ["key", "pos", "neg"],
                )

    size = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    pos, neg = size.get(1, 0), size.get(0, 0)
    if not pos or not neg:
        return np.zeros(0, np.uint64), np.zeros(0)
    counted = sample.mapInArrow(frugal(count), "key long, pos long, neg long")
    sums = counted.groupBy("key").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    ratio = F.log((F.col("pos") + 0.5) / (pos + 1)) - F.log((F.col("neg") + 0.5) / (neg + 1))
    best = (
        sums.filter((F.col("pos") >= LEAST_DOCS) & (ratio > LEAST_RATIO))
        .withColumns({"ratio": ratio, "gain": ratio * F.col("pos")})
        .orderBy(F.desc("gain"), "key")
        .limit(FEATURES)
        .collect()
    )
    return (
        np.array([r["key"] for r in best], np.int64).view(np.uint64),
        np.array([r["ratio"] >= VOTER_RATIO and r["gain"] >= VOTER_GAIN for r in best], bool),
    )


class Lookup:
    """Places of feature hashes in a table, by a bitmap of their top bits and a binary search."""

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.map = np.zeros(1 << 16, bool)
        self.map[(self.keys >> np.uint64(48)).astype(np.int64)] = True

    def find(self, row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, place) of the keys that are in the table."""
        maybe = np.flatnonzero(self.map[(key >> np.uint64(48)).astype(np.int64)])
        row, key = row[maybe], key[maybe]
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == key if len(self.keys) else np.zeros(len(at), bool)
        return _distinct(row[hit], self.order[at[hit]])


def _presence(sample: DataFrame, keys: np.ndarray, docs: int) -> np.ndarray:
    """Which of the sampled documents (at most SAMPLE) has which feature (at most FEATURES)."""
    lookup = Lookup(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for chunk in chunks(batch.column(1), _LETTER):
                row, at = lookup.find(*_features(chunk))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[chunk.first + row]), pa.array(at.astype(np.int32))], ["k", "f"]
                )

    found = sample.select("k", "text").mapInArrow(frugal(run), "k long, f int").toPandas()
    out = np.zeros((docs, len(keys)), bool)
    out[found["k"].to_numpy(), found["f"].to_numpy()] = True
    return out


def choose_voters(presence: np.ndarray) -> np.ndarray:
    """Features in order of their gain, without those that fire on nearly the same documents."""
    chosen: list[int] = []
    for f in range(presence.shape[1]):
        mine = presence[:, f]
        if all(
            (mine & presence[:, c]).sum() <= 0.9 * (mine | presence[:, c]).sum() for c in chosen
        ):
            chosen.append(f)
            if len(chosen) == VOTERS:
                break
    return np.array(chosen, np.int64)


def label_model(votes: np.ndarray, prior: float, rounds: int = 50) -> tuple[np.ndarray, dict]:
    """Posterior of the toxic class for each row of votes (documents x voters), by EM.

    No label of a document is used, only the share `prior` of the toxic class. A document starts as toxic if any voter fires on it. A voter that does not
    fire abstains and says nothing, as most know one language only; one more voter, for
    the clean class, fires where all others abstain. Each voter's log-likelihood ratio is
    divided by 1 plus its correlations of over 0.3 with the others within the classes, so
    that voters which move together do not count several times.
    """
    v = np.column_stack([votes, ~votes.any(axis=1)]).astype(float)
    m = v.shape[1]
    post = np.where(votes.any(axis=1), 0.9, 0.1)
    weight = np.ones(m)
    for _ in range(rounds):
        fires = (post @ v + 0.1) / (post.sum() + 0.2)
        others = ((1 - post) @ v + 0.1) / ((1 - post).sum() + 0.2)
        mean = np.outer(post, fires) + np.outer(1 - post, others)
        rest = v - mean
        scale = np.sqrt(np.maximum((rest**2).sum(axis=0), 1e-9))
        corr = (rest.T @ rest) / np.outer(scale, scale)
        corr[-1] = corr[:, -1] = 0  # the clean voter depends on all others by its making
        np.fill_diagonal(corr, 0)
        weight = 1 / (1 + np.maximum(np.abs(corr) - 0.3, 0).sum(axis=0))
        odds = np.log(prior / (1 - prior)) + v @ (np.log(fires / others) * weight)
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        done = np.abs(new - post).max() < 1e-4
        post = new
        if done:
            break
    return post, {"fires": fires, "others": others, "weight": weight, "correlation": corr}


def train_linear(x: np.ndarray, target: np.ndarray, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels: Adam on all rows, with a small L2 penalty."""
    n, m = x.shape
    xf = np.column_stack([x, np.ones(n)]).astype(np.float32)
    w, first, second = (np.zeros(m + 1, np.float32) for _ in range(3))
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(xf @ w, -30, 30)))
        slope = xf.T @ (p - target).astype(np.float32) / n + 1e-5 * w
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        step = (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        w = (w - 0.05 * step).astype(np.float32)
    return w[:m].astype(float), float(w[m])


class Scorer:
    """A trained classifier: score of a lower-cased text, 0 to 1."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, bias: float):
        self.lookup, self.weights, self.bias = Lookup(keys), weights, bias

    def column(self, text: Column) -> Column:
        lookup, weights, bias = self.lookup, self.weights, self.bias

        @F.arrow_udf("double")
        def score(texts: pa.Array) -> pa.Array:
            out = np.full(len(texts), bias)
            for chunk in chunks(texts, _LETTER):
                row, at = lookup.find(*_features(chunk))
                size = chunk.last - chunk.first
                out[chunk.first : chunk.last] += np.bincount(row, weights[at], size)
            trim()
            return pa.array(1 / (1 + np.exp(-np.clip(out, -30, 30))))

        return score(F.lower(F.coalesce(text, F.lit(""))))


def train(docs: DataFrame, labels: DataFrame) -> Scorer:
    """A scorer learned from at most SAMPLE labelled rows that are not held out.

    Without labels of both classes, or without features, every score is 0.1 or less.
    """
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    usable = usable.filter(~held_out(F.col("doc_id"))).select(
        F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic")
    )
    # Bounded by SAMPLE rows, and so is its broadcast.
    chosen = usable.orderBy(F.md5(F.col("_id").cast("string")), "toxic").limit(SAMPLE)
    texts = docs.select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    sample = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    # An order of the rows' own, so that neither the sample nor k hangs on partitions.
    order = [F.md5(F.col("_id").cast("string")), F.xxhash64("text"), "toxic"]
    sample = sample.orderBy(*order).limit(SAMPLE).select("toxic", "text", F.monotonically_increasing_id().alias("k"))
    sample = checkpointed(sample.repartition(docs.sparkSession.sparkContext.defaultParallelism, "k"))
    ids = _one_per_family(sample)
    number = docs.sparkSession.createDataFrame(ids.reset_index()[["k", "index"]].astype("int64"), "k long, index long")
    sample = sample.join(F.broadcast(number), "k").select("toxic", "text", F.col("index").alias("k"))
    keys, able = _mine(sample.select("toxic", "text"))
    if not able.any():
        return Scorer(keys, np.zeros(len(keys)), -4.0)
    presence = _presence(sample, keys, len(ids))
    able = presence[:, able]
    votes = able[:, choose_voters(able)]
    prior = float(np.clip((ids["toxic"] == 1).mean(), 0.001, 0.999))
    posterior, _ = label_model(votes, prior)
    weights, bias = train_linear(presence, posterior)
    return Scorer(keys, weights, bias)


@own_names()
def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All rows and columns of `docs` with held_out, score and predicted.

    A null or empty text gets the score of a text without any known word. Labels teach the
    voters and nothing else about a row: held-out rows, lang, source and doc_id are never
    inputs. Repeated rows get equal scores. Columns of `docs` with new names are replaced.
    """
    scorer = train(docs, labels)
    mine = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    rows = docs.select(
        *mine, held_out(F.col("doc_id")).alias("held_out"), scorer.column(F.col("text")).alias("score")
    )
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


@own_names("held_out", "score", "predicted")
def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` without the rows that the classifier calls toxic."""
    return score_documents(docs, labels).filter("predicted = 0").select(*docs.columns)


def op5_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    return score_documents(docs.select("doc_id", "text"), labels.select("doc_id", "toxic")).select(
        "doc_id", "held_out", "score", "predicted"
    )
