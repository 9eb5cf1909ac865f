"""Repeated passages, removed word by word: count-min prefilter, then exact grouping.

Pass one sketches how often windows of `width` words occur. A window is counted through its
minimiser, the smallest-hashing run of `width` // 2 words in it: a window that occurs n times
has a minimiser at n places at least, so the count-min cells of the minimiser are an
overestimate of the window's count, with about a sixth of the insertions. The sketches of all
partitions merge. Pass two reads the texts again; only windows whose estimate is two or more
are grouped by a 128-bit hash of their words, after each block of documents has reduced its
own repeats, so a passage that many documents share is a row per block in the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faturaflow.llm.bitplanes import (
    PARTS,
    Planes,
    RepeatFilter,
    few_tasks,
    frugal,
    log2_cells,
    merged,
    test_plane,
)
from faturaflow.llm.common import checkpointed, key_halves, text_hash
from faturaflow.llm.textops import chunks, mix, ranges, rolling

WIDTH = 20
#: Windows of a block that are reduced together before the shuffle.
BLOCK = 1 << 18
SKETCH_ROWS = 2
_NO_ID = -(1 << 63)
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
_ROWS = "a long, b long, doc_id long, th long, start long, stop long, kind long"
#: Kinds of rows: a passage to be resolved, the first place of one, covered words.
ASK, FIRST, SPAN = 0, 1, 2
#: Windows of a segment on average (a power of two).
SEGMENT = 64


def _minimisers(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of width // 2 words, and for each window the place of its smallest."""
    short = max(1, width // 2)
    runs = rolling(hashes, short, _BASES[2])
    n = len(hashes) - width + 1
    least, place = runs[:n].copy(), np.arange(n)
    for j in range(1, width - short + 1):
        other = runs[j : j + n]
        better = other < least
        least[better] = other[better]
        place[better] = np.flatnonzero(better) + j
    return runs, place


def _windows(chunk, width: int):
    """(word hashes, runs, place of the minimiser for each window, which windows are whole)."""
    hashes = chunk.word_hashes()
    if len(hashes) < width:
        return None
    runs, place = _minimisers(hashes, width)
    row = np.repeat(np.arange(len(chunk.first_word) - 1), np.diff(chunk.first_word))
    whole = row[: len(place)] == row[width - 1 : width - 1 + len(place)]
    return hashes, runs, place, whole, row


def _sketch(docs: DataFrame, log2: int, width: int) -> np.ndarray:
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = Planes(log2, SKETCH_ROWS)
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                if (w := _windows(chunk, width)) is not None:
                    _, runs, place, whole, _ = w
                    keys = runs[np.unique(place[whole])]
                    planes.add(keys, mix(keys))
        yield from planes.segments()

    return merged(few_tasks(docs.select("text")).mapInArrow(frugal(fill), PARTS), log2, 2)


def _batch(cols: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(c, np.int64)) for c in cols],
        ["a", "b", "doc_id", "th", "start", "stop", "kind"],
    )


def _spans(doc: np.ndarray, th: np.ndarray, start: np.ndarray, stop: np.ndarray) -> list[np.ndarray]:
    """Rows for covered words, merged where they follow each other in a document."""
    order = np.lexsort((start, th, doc))
    doc, th, start, stop = doc[order], th[order], start[order], stop[order]
    new = np.ones(len(doc), bool)
    new[1:] = (np.diff(doc) != 0) | (np.diff(th) != 0) | (start[1:] > stop[:-1])
    at = np.flatnonzero(new)
    last = np.concatenate([at[1:], [len(doc)]]).astype(np.int64) - 1
    spread = mix(doc[at].view(np.uint64) + start[at].view(np.uint64)).view(np.int64)
    return [spread, spread, doc[at], th[at], start[at], stop[last], np.full(len(at), SPAN)]


def _heads(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return new


def _later(a, b, doc, th, start) -> np.ndarray:
    """Rows sorted by all five: those after the first place of their (a, b)."""
    head = np.maximum.accumulate(np.where(_heads(a, b), np.arange(len(a)), 0))
    return (doc != doc[head]) | (th != th[head]) | (start != start[head])


class _Block:
    """Passages of a block of documents: of equal ones the first is asked for, the others are spans."""

    def __init__(self):
        self.held: list[tuple[np.ndarray, ...]] = []
        self.count = 0

    def add(self, *cols: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(cols)
        self.count += len(cols[0])
        if self.count >= BLOCK:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        a, b, doc, th, start, stop = (np.concatenate(c) for c in zip(*self.held))
        self.held, self.count = [], 0
        order = np.lexsort((start, th, doc, b, a))
        a, b, doc, th, start, stop = (x[order] for x in (a, b, doc, th, start, stop))
        later = _later(a, b, doc, th, start)
        asked = np.flatnonzero(_heads(a, b))
        for k in range(0, len(asked), 1 << 17):
            at = asked[k : k + (1 << 17)]
            yield _batch([a[at], b[at], doc[at], th[at], start[at], stop[at], np.full(len(at), ASK)])
        if later.any():
            yield _batch(_spans(doc[later], th[later], start[later], stop[later]))


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by passage and place: the first place of a passage, and the others as spans."""
    head = None
    for batch in batches:
        cols = [np.asarray(c) for c in batch.columns]
        done = cols[6] == SPAN
        if done.any():
            yield _batch([c[done] for c in cols])
        rows = [c[~done] for c in cols]
        if not len(rows[0]):
            continue
        if head is not None:  # the passage that the last batch ended in may go on
            rows = [np.concatenate([[h], c]) for h, c in zip(head, rows)]
        a, b, doc, th, start, stop, _ = rows
        later = _later(a, b, doc, th, start)
        if later.any():
            yield _batch(_spans(doc[later], th[later], start[later], stop[later]))
        new = _heads(a, b)
        new[0] = head is None
        if new.any():
            yield _batch([*(c[new] for c in rows[:6]), np.full(int(new.sum()), FIRST)])
        last = np.flatnonzero((a == a[-1]) & (b == b[-1]))[0]
        head = [c[last] for c in rows]


class _Reader:
    """Passages of every text, for windows that the sketch has seen twice."""

    def __init__(self, plane, log2: int, width: int, firsts: RepeatFilter | None = None):
        self.plane, self.log2, self.width, self.firsts = plane, log2, width, firsts

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches:
            ids = batch.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            ths = batch.column(1).to_numpy(zero_copy_only=False)
            for chunk in chunks(batch.column(2)):
                if (w := _windows(chunk, self.width)) is not None:
                    for cols in self.passages(chunk, ids, ths, *w):
                        yield from block.add(*cols)
        yield from block.flush()

    def passages(self, chunk, ids, ths, hashes, runs, place, whole, row):
        used = np.unique(place[whole])
        hit = np.zeros(len(runs), bool)
        hit[used] = test_plane(self.plane.value, runs[used], mix(runs[used]), self.log2, SKETCH_ROWS)
        repeated = whole & hit[place]
        # Segments: windows from one content-defined cut to the next, in one text.
        at = np.flatnonzero(whole)
        if not len(at):
            return
        opens = (mix(runs[at]) & np.uint64(SEGMENT - 1)) == 0
        opens |= np.concatenate([[True], (np.diff(at) != 1) | (np.diff(row[at]) != 0)])
        first = np.flatnonzero(opens)
        stop = np.concatenate([first[1:], [len(at)]])
        some = np.add.reduceat(repeated[at].astype(np.int64), first) > 0
        first, stop = first[some], stop[some]
        if not len(first):
            return
        begin, end = at[first], at[stop - 1] + self.width
        owner = chunk.first + row[begin]
        start = begin - chunk.first_word[row[begin]]
        doc, th = ids[owner], ths[owner]
        if self.firsts is None:
            a, b = (
                ranges(h, begin, end, base).view(np.int64)
                for h, base in ((hashes, _BASES[0]), (mix(hashes), _BASES[1]))
            )
            yield a, b, doc, th, start, start + (end - begin)
            return
        asked = self.firsts.holds(*_place_halves(doc, th, start))
        mine = np.zeros(len(whole) + 1, np.int64)
        np.add.at(mine, begin[asked], 1)
        np.add.at(mine, end[asked] - self.width + 1, -1)
        at = np.flatnonzero(repeated & (np.cumsum(mine)[:-1] > 0))
        if len(at):
            a, b = (
                rolling(h, self.width, base)[at].view(np.int64)
                for h, base in ((hashes, _BASES[0]), (mix(hashes), _BASES[1]))
            )
            owner = chunk.first + row[at]
            start = at - chunk.first_word[row[at]]
            yield a, b, ids[owner], ths[owner], start, start + self.width


def _place_halves(doc: np.ndarray, th: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = mix(mix(doc.view(np.uint64)) + th.view(np.uint64)) + start.astype(np.int64).view(np.uint64)
    return mix(key).view(np.int64), mix(key + np.uint64(1)).view(np.int64)


def _resolved(rows: DataFrame, reader: _Reader) -> DataFrame:
    asked = rows.mapInArrow(frugal(reader.rows), _ROWS)
    order = ["a", "b", "doc_id", "th", "start"]
    return asked.repartition("a", "b").sortWithinPartitions(*order).mapInArrow(frugal(_resolve), _ROWS)


def repeated_spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, th, spans array<struct<start, stop>>) of the documents that repeat an earlier window.

    A span is a range of word numbers that such windows cover. The place of a window is
    (doc_id, text hash, first word): rows with one doc_id and different texts come in the
    order of their hashes, and identical rows are one document.

    Windows are grouped in two steps. Content-defined segments, with the words that their
    last window reaches, are grouped first: every window of a later copy of a segment
    repeats one of the first copy, so copies cost a row per segment. The windows of first
    copies are then grouped one by one.
    """
    size = docs.agg(F.sum(F.length(F.col("text").cast("binary"))).alias("n")).first()["n"] or 0
    # About 6 bytes a word, and one minimiser in (width // 2 + 2) / 2 words.
    log2 = log2_cells(int(size / 6 / ((width // 2 + 2) / 2)))
    plane = docs.sparkSession.sparkContext.broadcast(_sketch(docs, log2, width))
    rows = docs.select(F.col("doc_id").cast("long"), text_hash(F.col("text")).alias("th"), "text")

    segments = checkpointed(_resolved(rows, _Reader(plane, log2, width)))
    firsts = segments.filter(F.col("kind") == FIRST)

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = _place_halves(*(np.asarray(c) for c in batch.columns))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["a", "b"])

    keys = firsts.select("doc_id", "th", "start").mapInArrow(frugal(halves), "a long, b long")
    filtered = RepeatFilter.build(keys, firsts.count(), seen=1)
    windows = _resolved(rows, _Reader(plane, log2, width, filtered))

    spans = segments.union(windows).filter(F.col("kind") == SPAN)
    # A document's spans are bounded by its own words.
    return spans.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        texts, spans = batch.column("text"), batch.column("spans")
        for text, cut in zip(texts, spans):
            words = (text.as_py() or "").encode().split()
            n = len(words)
            cut = cut.as_py()
            if cut:
                gone = np.zeros(n + 1, np.int64)
                for s in cut:
                    gone[s["start"]] += 1
                    gone[s["stop"]] -= 1
                keep = np.cumsum(gone)[:n] == 0
                words = [w for w, k in zip(words, keep.tolist()) if k]
            out.append((n, n - len(words), b" ".join(words)))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                *(pa.array([o[i] for o in out], t) for i, t in enumerate([pa.int64(), pa.int64()])),
                pa.array([o[2].decode() for o in out], pa.large_string()).cast(pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "kept_text"],
        )


def substring_dedup(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every row: its words that no repeated window covers.

    Every word covered by a window of `width` words that also starts earlier (in a document
    with a smaller doc_id, or before in its own) goes. Windows are judged on the input. kept_text
    has the other words, joined by one space. A null text has no words; a text of fewer
    than `width` words has no window; a null doc_id comes first. Only rows that a Bloom filter
    of the affected documents may hold are shuffled; the others pass straight through.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    spans = checkpointed(repeated_spans(docs, width))
    keyed = docs.withColumn("_th", text_hash(F.col("text"))).withColumn(
        "_id", F.coalesce("doc_id", F.lit(_NO_ID))
    )
    halves = [h.alias(c) for h, c in zip(key_halves("doc_id", "th"), "ab")]
    maybe = RepeatFilter.build(spans.select(*halves), spans.count(), seen=1)
    keyed = keyed.withColumn("_maybe", maybe.test(*key_halves("_id", "_th")))
    none = F.lit(None).cast(spans.schema["spans"].dataType)
    clean = keyed.filter("not _maybe").select("doc_id", "text", none.alias("spans"))
    right = spans.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "spans")
    cut = keyed.filter("_maybe").join(right, ["_id", "_th"], "left").select("doc_id", "text", "spans")
    return clean.unionByName(cut).mapInArrow(
        frugal(_finish), "doc_id long, n_words long, n_removed long, kept_text string"
    )


def op9_substring(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256."""
    return substring_dedup(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )
