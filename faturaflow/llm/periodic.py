"""Runs of periodically repeated words, caught by dyadic square catchers.

The words of a text are appended one block after another. At every power of two B, each
completed block of B words is a catcher: the B words that end at every later word, B to 2 B - 1
words on, are compared with it. Equal ones are one arm of a square of that period; the match
is then advanced to both sides, through names of 2**k words at a time. A match of p words at distance p is
a square, and squares of one period that overlap are one run, so what is reported is the run.

A run of period p that is at least three periods long holds a matching stretch of 2 p words,
and any stretch of 2 B - 1 words holds a whole aligned block of B words: the largest B <= p
catches it. Names of 2**k words are hashes of pairs of names of 2**(k-1) words (64 bits).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faturaflow.llm.bitplanes import frugal
from faturaflow.llm.textops import chunks, mix

#: A run has at least so many words, and so many periods (3 or more: see above).
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Comparisons of one catcher level that are held at once.
SLAB = 1 << 20
_PAIR = np.uint64(0x9E3779B97F4A7C15)
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class _Words:
    """Words of some texts as one sequence, with a word of its own after each text."""

    def __init__(self, hashes: np.ndarray, first_word: np.ndarray):
        counts = np.diff(first_word)
        self.begin = first_word[:-1] + np.arange(len(counts))
        self.longest = int(counts.max(initial=0))
        ends = self.begin + counts
        self.text = np.repeat(np.arange(len(counts)), counts + 1)
        marks = mix(np.arange(len(counts), dtype=np.uint64) + _PAIR)
        sequence = np.empty(len(hashes) + len(counts), np.uint64)
        is_mark = np.zeros(len(sequence), bool)
        is_mark[ends] = True
        sequence[is_mark], sequence[~is_mark] = marks, hashes
        self.names = [sequence]

    def name(self, k: int) -> np.ndarray:
        """Names of every 2**k words."""
        while len(self.names) <= k:
            last, half = self.names[-1], 1 << (len(self.names) - 1)
            self.names.append(mix(last[:-half] * _PAIR + last[half:]) if half < len(last) else last[:0])
        return self.names[k]

    def advance(self, at: np.ndarray, period: np.ndarray, step: int) -> np.ndarray:
        """How far the words from `at` on (step 1) or before it (step -1) equal those `period` later.

        Steps double as long as names agree, and then halve.
        """
        at = at.copy()
        going, top = np.arange(len(at)), 0
        while len(going):
            going = self._step(at, going, period, top, step)
            top += 1
        for k in range(top - 1, -1, -1):
            self._step(at, np.arange(len(at)), period, k, step)
        return at

    def _step(self, at: np.ndarray, which: np.ndarray, period: np.ndarray, k: int, step: int) -> np.ndarray:
        """Moves those of `which` on whose next 2**k words agree."""
        names = self.name(k)
        x = at[which] if step > 0 else at[which] - (1 << k)
        inside = (x >= 0) & (x + period[which] < len(names))
        which, x = which[inside], x[inside]
        which = which[names[x] == names[x + period[which]]]
        at[which] += step * (1 << k)
        return which


def _caught(words: _Words, k: int, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) where a completed block of 2**k words comes again `least` to `most` words on,
    for the first of the consecutive blocks that do so at one period."""
    names, size = words.name(k), 1 << k
    places, periods = [], []
    span = most - least + 1
    padded = np.concatenate([names, np.zeros(most + 1, np.uint64)])
    later = np.lib.stride_tricks.sliding_window_view(padded, span)
    per = max(1, SLAB // span)
    before = np.zeros(span, bool)
    for first in range(0, len(names), per * size):
        at = np.arange(first, min(len(names), first + per * size), size)
        equal = later[at + least] == names[at][:, None]
        fresh = equal.copy()
        fresh[0] &= ~before
        fresh[1:] &= ~equal[:-1]
        before = equal[-1]
        block, p = np.nonzero(fresh)
        places.append(at[block])
        periods.append(p + least)
    place, period = np.concatenate(places), np.concatenate(periods)
    inside = place + period < len(names)
    place, period = place[inside], period[inside]
    own = words.text[place] == words.text[place + period]
    return place[own], period[own]


def find_runs(words: _Words, least_words: int, least_periods: int) -> np.ndarray:
    """Rows (text, start, length, period), sorted by text, start and period."""
    base = ((least_words + 2) // 3).bit_length() - 1
    found = np.zeros((0, 3), np.int64)
    run_at = np.full(len(words.text), -1)
    k = base
    while words.longest >= max(least_words, least_periods * (1 << k if k > base else 1)):
        place, period = _caught(words, k, 1 if k == base else 1 << k, (2 << k) - 1)
        # Inside a run that is known already, multiples of its period are no news.
        run = run_at[place]
        last = place + period + (1 << k) - 1
        known = (run >= 0) & (run == run_at[last])
        if known.any():
            known[known] = period[known] % found[run[known], 2] == 0
            place, period = place[~known], period[~known]
        start = words.advance(place, period, -1)
        stop = words.advance(place + (1 << k), period, 1) + period
        whole = stop - start >= np.maximum(least_words, least_periods * period)
        new = np.stack([start, stop, period], axis=1)[whole]
        new = new[np.lexsort((new[:, 2], new[:, 1], new[:, 0]))]
        heads = np.ones(len(new), bool)
        heads[1:] = (new[1:, :2] != new[:-1, :2]).any(axis=1)
        new = new[heads]
        if len(new):
            offset = len(found)
            found = np.concatenate([found, new])
            for j in np.argsort(new[:, 1] - new[:, 0], kind="stable"):
                run_at[new[j, 0] : new[j, 1]] = offset + j
        k += 1
    # A stretch keeps its smallest period; larger levels find multiples of it.
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    heads = np.ones(len(found), bool)
    heads[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[heads]
    text = words.text[found[:, 0]] if len(found) else np.zeros(0, np.int64)
    out = np.stack([text, found[:, 0] - words.begin[text], found[:, 1] - found[:, 0], found[:, 2]], axis=1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _collapsed(text: bytes, runs: np.ndarray) -> bytes:
    words = text.split()
    if len(runs):
        gone = np.zeros(len(words) + 1, np.int64)
        np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
        np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
        words = [w for w, g in zip(words, np.cumsum(gone).tolist()) if not g]
    return b" ".join(words)


def _on_batches(least_words: int, least_periods: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                words = _Words(chunk.word_hashes(), chunk.first_word)
                found = find_runs(words, least_words, least_periods)
                n = chunk.last - chunk.first
                at = np.searchsorted(found[:, 0], np.arange(n + 1))
                texts = [
                    _collapsed(chunk.data[chunk.offsets[i] : chunk.offsets[i + 1]].tobytes(), found[at[i] : at[i + 1], 1:])
                    for i in range(n)
                ]
                runs = pa.StructArray.from_arrays(
                    [pa.array(np.ascontiguousarray(c)) for c in found[:, 1:].T], ["start", "length", "period"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, n),
                        pa.array(np.diff(chunk.first_word)),
                        pa.ListArray.from_arrays(pa.array(at, pa.int32()), runs),
                        pa.array([t.decode() for t in texts], pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return run


def periodic_runs(
    docs: DataFrame, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row.

    runs: stretches of words with smallest period p, at least `least_words` words and
    `least_periods` periods long (3 or more), that no neighbouring word extends; by start, then
    period. collapsed: the words outside every run and those of each run's first period, unless
    another run drops them, joined by one space. Null and empty texts have no words and no runs. Rows are
    independent of each other: repeated rows and null ids are rows like others, and other columns are ignored.
    A text is held whole, with about 8 bytes a word for every power of two up to a third of its words.
    """
    if least_periods < 3:
        raise ValueError("catchers find runs of three or more periods")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        frugal(_on_batches(least_words, least_periods)),
        f"doc_id long, n_words long, runs {RUNS}, collapsed string",
    )


def _planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for i, doc_id in enumerate(batch.column(0).to_pylist()):
            h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
            if h is None or h % 10 or not (words := (texts[i] or "").encode().split()):
                continue
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words[a:] = (words[a : a + p] * ((n - a) // p + 1))[: n - a]
            texts[i] = b" ".join(words).decode()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents, chosen by the id, the words from some place on
    repeat the first of them. A null id plants nothing."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(frugal(_planted), "doc_id long, text string")


def op13_runs(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_runs, the run of greatest exponent, and digests."""
    found = periodic_runs(with_planted_runs(docs))
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    # Runs come by start and period, so an equal exponent never replaces an earlier one.
    best = F.reduce(
        "runs",
        none,
        lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b),
    )
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "_best.start",
        "_best.length",
        "_best.period",
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
