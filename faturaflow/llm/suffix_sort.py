"""Repeated passages of bytes by a radix sort of suffixes, most significant digits first, to a fixed depth.

Every place of a text where `width` bytes follow is a suffix, of which only those bytes are ordered:
equal suffixes are the repeated windows. A pass orders by one more digit, and a suffix that
is alone with its digits leaves the sort. Two things keep passes small:

* The most significant digit of a window is its minimiser, the first of its `GRAM`-byte pieces with the
  smallest hash. Neighbouring windows share it, so a pass moves a unit of neighbouring windows
  as one row: the digit is what all windows of a cell of offsets have in common, and cells
  shrink from pass to pass until the digit is the whole window.
* Units whose bytes are equal throughout hold equal windows one by one. The earliest unit
  stays in the sort and stands for them, the others are removed there and then.

A unit that stays and shares its digit with a different one goes to the next pass. Digits are 64-bit
hashes, and units are equal if another 64-bit hash agrees as well. A digit that makes up more than a thousandth
of a sample of the rows is spread over tasks by its units and goes to the next pass without the test.
The order of windows is that of (doc_id, text hash, place).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faturaflow.llm.bitplanes import frugal
from faturaflow.llm.common import checkpointed, text_hash
from faturaflow.llm.textops import _TABLE, mix, ranges, rolling
from faturaflow.operators.joins import lookup_join

WIDTH = 100
#: Bytes of the first digit, and into how many cells a pass splits one.
GRAM, RADIX = 32, 4
#: Windows hashed together, units of a block that are reduced before the shuffle, rows cut up together.
SLAB, BLOCK, ROWS = 1 << 18, 1 << 18, 1 << 12
#: One of so many documents is looked at for frequent digits; this steers the shuffle only.
SAMPLE = 64
_NO_ID = -(1 << 63)
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
_LOW, _HIGH = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_KEYS = ["d", "u", "doc", "th", "place"]
_SCHEMA = "d long, u long, doc long, th long, place long, bytes binary"


def _place(q: np.ndarray, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """A unit: the windows that start lo to hi bytes before its minimiser at q."""
    return (q << 32) | (hi << 16) | lo


def _parts(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 32, (place >> 16) & 0xFFFF, place & 0xFFFF


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for `size` numbers each."""
    before = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(first - before, size)


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of texts or binaries; nulls are empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return at - at[0], data[at[0] : at[-1]]


def _binaries(data: np.ndarray, first: np.ndarray, stop: np.ndarray) -> pa.Array:
    size = stop - first
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    taken = data[_spread(first, size)]
    return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(taken)])


def _rows(d, u, doc, th, place, held: pa.Array | None = None) -> pa.RecordBatch:
    columns = [pa.array(np.ascontiguousarray(c).view(np.int64)) for c in (d, u, doc, th, place)]
    return pa.RecordBatch.from_arrays(
        [*columns, pa.nulls(len(d), pa.binary()) if held is None else held], [*_KEYS, "bytes"]
    )


def _spans(doc: np.ndarray, th: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
    """Removed bytes, merged where they meet; told apart by a negative place, and dealt out evenly."""
    order = np.lexsort((start, th, doc))
    doc, th, start, stop = doc[order], th[order], start[order], stop[order]
    own = np.ones(len(doc), bool)
    own[1:] = (doc[1:] != doc[:-1]) | (th[1:] != th[:-1])
    # Units of one document and length end in the order in which they start.
    reach = stop.copy()
    for head, end in zip(np.flatnonzero(own), np.append(np.flatnonzero(own)[1:], len(doc))):
        reach[head:end] = np.maximum.accumulate(stop[head:end])
    new = own.copy()
    new[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(doc)) - 1
    dealt = mix(mix(doc[at].view(np.uint64)) + start[at].view(np.uint64))
    return _rows(dealt, reach[last], doc[at], th[at], -start[at] - 1)


def _span_of(place: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    q, hi, lo = _parts(place)
    return q - hi, q - lo + width


def _heads(*keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.asarray(batch.column(i)) for i in range(5)]


def _later(head: np.ndarray, doc, th, place) -> np.ndarray:
    """Of sorted rows: those elsewhere than the first of their equals (identical rows are one document)."""
    first = np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))
    return (doc != doc[first]) | (th != th[first]) | (place != place[first])


class _Block:
    """Units of a task: of equal ones the first goes on, the others are spans."""

    def __init__(self, width: int):
        self.width, self.held, self.count = width, [], 0

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        self.held.append(batch)
        self.count += len(batch)
        if self.count >= BLOCK:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.count:
            return
        whole = pa.Table.from_batches(self.held).combine_chunks().to_batches()[0]
        self.held, self.count = [], 0
        order = np.lexsort(tuple(_columns(whole)[::-1]))
        d, u, doc, th, place = (c[order] for c in _columns(whole))
        head = _heads(d, u)
        later = _later(head, doc, th, place)
        firsts = whole.take(pa.array(order[head]))
        for k in range(0, len(firsts), 1 << 16):
            yield firsts.slice(k, 1 << 16)
        if later.any():
            yield _spans(doc[later], th[later], *_span_of(place[later], self.width))


def _units(batches: Iterator[pa.RecordBatch], width: int, gram: int) -> Iterator[pa.RecordBatch]:
    """First pass: (doc, th, text) to the units of windows that share a minimiser."""
    block = _Block(width)
    for batch in batches:
        ids = batch.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
        ths = batch.column(1).to_numpy(zero_copy_only=False)
        at, data = _buffers(batch.column(2))
        for begin in range(0, len(data) - width + 1, SLAB):
            piece = data[begin : begin + SLAB + width - 1]
            n = len(piece) - width + 1
            values = _TABLE[piece]
            grams = rolling(values, gram, _BASES[0])
            q = _minimisers(grams, n, width - gram + 1)
            row = np.searchsorted(at, np.arange(begin, begin + n, dtype=np.int64), "right") - 1
            whole = at[row + 1] - np.arange(begin, begin + n) >= width
            new = np.ones(n, bool)
            new[1:] = (q[1:] != q[:-1]) | ~whole[:-1]
            first = np.flatnonzero(new & whole)
            if not len(first):
                continue
            # A unit ends where the next one begins or where its text has no window any more.
            ends = np.flatnonzero(np.append(new[1:] | ~whole[1:], True))
            last = ends[np.searchsorted(ends, first)]
            q = q[first]
            hi, lo = q - first, q - last
            u = mix(ranges(values, first, last + width, _BASES[1]) + hi.view(np.uint64) * _HIGH + lo.view(np.uint64) * _LOW)
            own = row[first]
            yield from block.add(_rows(grams[q], u, ids[own], ths[own], _place(q + begin - at[own], hi, lo)))
    yield from block.flush()


def _minimisers(grams: np.ndarray, n: int, span: int) -> np.ndarray:
    """Place of the smallest of `span` hashes from each of n places on, the first of equal ones."""
    least, place, size = grams, np.arange(len(grams)), 1
    while size < span:
        step = min(size, span - size)
        other = least[step:]
        better = other < least[: len(other)]
        place = np.where(better, place[step:], place[: len(other)])
        least = np.where(better, other, least[: len(other)])
        size += step
    return place[:n]


def _children(doc, th, place, at, data, cell: int, width: int, gram: int) -> pa.RecordBatch:
    """Units cut at multiples of `cell` offsets: each with the digit that all windows of the cell share."""
    q, hi, lo = _parts(place)
    count = hi // cell - lo // cell + 1
    owner = np.repeat(np.arange(len(place)), count)
    number = _spread(lo // cell, count)
    low, high = np.maximum(lo[owner], number * cell), np.minimum(hi[owner], number * cell + cell - 1)
    least, most = number * cell, np.minimum(number * cell + cell - 1, width - gram)
    zero = at[:-1][owner] + hi[owner]
    values = _TABLE[data]
    d = mix(ranges(values, zero - least, zero - most + width, _BASES[0]) + number.view(np.uint64) * _LOW)
    first, stop = zero - high, zero - low + width
    u = mix(ranges(values, first, stop, _BASES[1]) + high.view(np.uint64) * _HIGH + low.view(np.uint64) * _LOW)
    return _rows(d, u, doc[owner], th[owner], _place(q[owner], high, low), _binaries(data, first, stop))


def _cut(batches: Iterator[pa.RecordBatch], cell: int, width: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Next pass, from units that carry their bytes."""
    block = _Block(width)
    for batch in batches:
        for k in range(0, len(batch), ROWS):
            part = batch.slice(k, ROWS)
            doc, th, place = _columns(part)[2:]
            yield from block.add(_children(doc, th, place, *_buffers(part.column(5)), cell, width, gram))
    yield from block.flush()


def _cut_texts(batches: Iterator[pa.RecordBatch], cell: int, width: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Second pass: rows are (doc, th, text, places)."""
    block = _Block(width)
    for batch in batches:
        doc, th = (np.asarray(batch.column(i)) for i in (0, 1))
        at, data = _buffers(batch.column(2))
        places = batch.column(3)
        owner = np.repeat(np.arange(len(batch)), places.value_lengths().to_numpy(zero_copy_only=False))
        place = places.flatten().to_numpy(zero_copy_only=False)
        for k in range(0, len(place), ROWS):
            some, own = place[k : k + ROWS], owner[k : k + ROWS]
            first, stop = _span_of(some, width)
            held = _binaries(data, first + at[own], stop + at[own])
            yield from block.add(_children(doc[own], th[own], some, *_buffers(held), cell, width, gram))
    yield from block.flush()


def _resolve(batches: Iterator[pa.RecordBatch], frequent: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows: of equal units the later ones are spans; the first goes on if its digit is not its alone."""
    carry, sent, shared = None, False, False  # first row of the last unit; is it through; has its digit another unit
    for batch in batches:
        place = np.asarray(batch.column(4))
        if (place < 0).any():
            yield batch.filter(pa.array(place < 0))
            batch = batch.filter(pa.array(place >= 0))
        if not len(batch):
            continue
        fresh = carry is None
        if not fresh:
            batch = pa.Table.from_batches([carry, batch]).combine_chunks().to_batches()[0]
        d, u, doc, th, place = _columns(batch)
        head = _heads(d, u)
        later = _later(head, doc, th, place)
        if later.any():
            yield _spans(doc[later], th[later], *_span_of(place[later], width))
        at = np.flatnonzero(head)
        of_digit = _heads(d[at])
        group = np.cumsum(of_digit) - 1
        several = (np.bincount(group) > 1) | np.isin(d[at][of_digit], frequent)
        several[0] |= not fresh and shared
        goes = several[group]
        emitted = goes.copy()
        emitted[0] &= fresh or not sent
        if emitted.any():
            yield batch.take(pa.array(at[emitted]))
        carry = batch.slice(int(at[-1]), 1)
        # Copied, so that it does not hold the whole batch.
        carry = carry.take(pa.array([0]))
        sent, shared = bool(goes[-1]), bool(goes[-1])


def _pass(rows: DataFrame, sample: DataFrame, width: int) -> DataFrame:
    """One pass over units; what goes on has a place of 0 or more, the rest are spans."""
    counts = checkpointed(sample.filter("place >= 0").groupBy("d").count())
    total = counts.agg(F.sum("count")).first()[0] or 0
    # Under 1,000 digits by construction.
    frequent = [r["d"] for r in counts.filter(F.col("count") > max(16, total // 1000)).select("d").collect()]
    listed = np.array(frequent, np.int64)
    route = F.col("d") if not frequent else F.when(F.col("d").isin(frequent), F.col("u")).otherwise(F.col("d"))
    sorted_rows = rows.repartition(route).sortWithinPartitions(*_KEYS)
    return checkpointed(
        sorted_rows.mapInArrow(frugal(lambda batches: _resolve(batches, listed, width)), _SCHEMA)
    )


def _sampled(df: DataFrame, one_of: int) -> DataFrame:
    return df.filter(F.pmod(F.xxhash64("doc", "th"), F.lit(one_of)) == 0)


def repeated_bytes(docs: DataFrame, width: int = WIDTH, gram: int | None = None) -> DataFrame:
    """(doc, th, start, stop): bytes of a document (its id, the hash of its text) that are covered by
    windows that also start earlier. Ranges may overlap and may come more than once."""
    gram = gram or min(GRAM, max(1, width // 3))
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"),
        text_hash(F.col("text")).alias("th"),
        "text",
    )

    def first(df: DataFrame) -> DataFrame:
        return df.mapInArrow(frugal(lambda batches: _units(batches, width, gram)), _SCHEMA)

    now = _pass(first(texts), first(_sampled(texts, SAMPLE)), width)
    spans = [now.filter("place < 0")]
    left = now.filter("place >= 0")
    # A document's places are bounded by its bytes.
    places = left.groupBy("doc", "th").agg(F.collect_set("place").alias("places"))
    cell, read = width - gram + 1, None
    while cell > 1 and not left.isEmpty():
        cell = max(1, cell // RADIX)

        def cut(df: DataFrame, cell=cell, step=_cut if read is not None else _cut_texts) -> DataFrame:
            return df.mapInArrow(frugal(lambda batches: step(batches, cell, width, gram)), _SCHEMA)

        if read is None:
            read = lookup_join(texts, places, ["doc", "th"], "inner").select("doc", "th", "text", "places")
        now = _pass(cut(read), cut(_sampled(read, SAMPLE)), width)
        spans.append(now.filter("place < 0"))
        left = read = now.filter("place >= 0")
    out = spans[0]
    for s in spans[1:]:
        out = out.union(s)
    return out.select("doc", "th", (-F.col("place") - 1).alias("start"), F.col("u").alias("stop"))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, data = _buffers(batch.column(1))
        sizes, spans, kept = np.diff(at), [], []
        for i, cut in enumerate(batch.column(2).to_pylist()):
            text = data[at[i] : at[i + 1]]
            own = []
            for s, e in sorted((c["start"], c["stop"]) for c in cut or ()):
                if own and s <= own[-1]["stop"]:
                    own[-1]["stop"] = max(e, own[-1]["stop"])
                else:
                    own.append({"start": s, "stop": e})
            edges = [0, *(x for r in own for x in (r["start"], r["stop"])), len(text)]
            kept.append(b"".join(text[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2])))
            spans.append(own)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes), pa.array(spans, kind), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "spans", "kept"],
        )


def suffix_dedup(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row.

    spans: the maximal runs of bytes (start, stop) covered by strings of `width` bytes that also start
    earlier, in a document with a smaller doc_id or before in the same one; overlaps count, and strings are
    judged on the input. kept: the other bytes, which need not be UTF-8. A null text is empty, a shorter
    one than `width` has no string. A null doc_id comes first. Rows with one doc_id and different
    texts come in the order of their texts' hashes; identical rows are one document, listed
    again. Other columns are ignored.
    """
    gone = repeated_bytes(docs, width).groupBy("doc", "th")
    gone = checkpointed(gone.agg(F.collect_set(F.struct("start", "stop")).alias("spans")))
    keyed = docs.select(F.col("doc_id").cast("long"), "text").withColumns(
        {"doc": F.coalesce("doc_id", F.lit(_NO_ID)), "th": text_hash(F.col("text"))}
    )
    both = lookup_join(keyed, gone, ["doc", "th"], "left").select("doc_id", "text", "spans")
    return both.mapInArrow(
        frugal(_finish), "doc_id long, n_bytes long, spans array<struct<start:bigint,stop:bigint>>, kept binary"
    )


def op11_suffix(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return suffix_dedup(docs).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
