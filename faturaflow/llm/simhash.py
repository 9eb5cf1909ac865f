"""SimHash near-duplicates through an inverted index on byte positions, with count filtering.

Two fingerprints of 64 bits that differ in at most d bits differ in at most d of their 8
bytes, so they share at least 8 - d positional bytes: the minimum of the count filter. Lists of
single bytes would hold a 256th of all fingerprints, and their pairs grow with the square of
the input. The postings are therefore keyed by every choice of 4 among the first d + 4 byte
positions, of which at least 4 agree in every link. Under a key the shared positional bytes of
each pair are tallied, pairs that reach the minimum are retained, and their bits are verified.

A list of more than LIST fingerprints is keyed once more, by every choice of 8 - d positions
that holds its own 4. Its pairs have reached the minimum then, and only d bytes are left
to differ, so such a list has at most 256**d fingerprints. Keys that hold much of the whole
input are seen in a sample and go there at once. Every list gives a spanning forest of its
links, never all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faturaflow.llm.bitplanes import frugal
from faturaflow.llm.common import checkpointed, drop_rows, hot_lookup, text_hash
from faturaflow.llm.components import components
from faturaflow.operators.joins import lookup_join

#: The contract: 3-word shingles, XXH64 seed, and bits that may differ.
SHINGLE, SEED, BITS = 3, 42, 2
#: Byte positions of a key, and fingerprints of a list whose pairs are tallied.
KEY_BYTES, LIST = 4, 1024
#: One fingerprint in SAMPLED is looked at for keys that hold over a HOT_SHARE-th of them, so these
#: are at most HOT_SHARE times the number of choices (15 for 2 bits), whatever the input.
SAMPLED, HOT_SHARE = 64, 5000


def _shingle_hashes(text: str, shingle: int, seed: int) -> np.ndarray:
    words = text.encode().lower().split()  # bytes: A-Z only, and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    stops = ends[shingle - 1 :].tolist() or [len(joined)]
    h = xxhash.xxh64_intdigest
    return np.fromiter(
        (h(joined[i:j], seed) for i, j in zip(starts, stops)), np.uint64, len(stops)
    )


def simhash(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit j is 1 if it is set in over half of the shingles' hashes; a text without words: 0."""
    h = _shingle_hashes(text, shingle, seed)
    if not len(h):
        return 0
    votes = np.zeros(64, np.int64)
    for at in range(0, len(h), 65_536):
        part = np.ascontiguousarray(h[at : at + 65_536])
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, _th, fp long) of every row; a null text is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = [simhash(x.as_py() or "", shingle, seed) for x in batch.column(2)]
            fp = np.array(fp, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fp)], ["doc_id", "_th", "fp"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), text_hash(F.col("text")).alias("_th"), "text")
    return rows.mapInArrow(frugal(run), "doc_id long, _th long, fp long")


def _unite(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the trees of rows i and j; `root` names each row's first row before and after."""
    while len(i):
        x, y = root[i], root[j]
        apart = x != y
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (up := root[root]).tobytes() != root.tobytes():
            root[:] = up


def _tallied(values: np.ndarray, left: np.ndarray, bits: int) -> np.ndarray:
    """Links of short lists as the first row of each row's tree; left: rows that follow in its list."""
    root = np.arange(len(values))
    for step in range(1, int(left.max(initial=0)) + 1):
        i = np.flatnonzero(left >= step)
        differ = values[i] ^ values[i + step]
        shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        retained = shared >= 8 - bits
        i, differ = i[retained], differ[retained]
        i = i[np.bitwise_count(differ) <= bits]
        _unite(root, i, i + step)
    return root


def _probed(values: np.ndarray, bits: int) -> np.ndarray:
    """The same for one long list of sorted, distinct values: looks up every value a link away."""
    root = np.arange(len(values))
    one = np.uint64(1)
    varying = [b for b in range(64) if len(np.unique(values >> np.uint64(b) & one)) > 1]
    for k in range(1, bits + 1):
        for choice in combinations(varying, k):
            other = values ^ np.uint64(sum(1 << b for b in choice))
            at = np.minimum(np.searchsorted(values, other), len(values) - 1)
            hit = np.flatnonzero(values[at] == other)
            _unite(root, hit, at[hit])
    return root


_LINKS = "a long, b long, choice int"


def _list_links(bits: int, defer: bool):
    """For mapInArrow over (choice, key, fp), sorted by the first two: links (a, b, null). With `defer`,
    lists longer than LIST come out as they are, a row (fp, null, choice) each."""

    def batch(a: np.ndarray, b: np.ndarray, choice: np.ndarray | None = None) -> pa.RecordBatch:
        n = len(a)
        cols = [pa.array(np.ascontiguousarray(a).view(np.int64))]
        if choice is None:
            cols += [pa.array(np.ascontiguousarray(b).view(np.int64)), pa.nulls(n, pa.int32())]
        else:
            cols += [pa.nulls(n, pa.int64()), pa.array(choice.astype(np.int32))]
        return pa.RecordBatch.from_arrays(cols, ["a", "b", "choice"])

    def lists(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        values = rows[2].view(np.uint64)
        new = np.flatnonzero((np.diff(rows[:2], axis=1) != 0).any(axis=0)) + 1
        first = np.concatenate([[0], new])
        size = np.diff(np.concatenate([first, [len(values)]]))
        long = np.repeat(size > LIST, size)
        if defer and long.any():
            yield batch(values[long], None, rows[0][long])
        short = ~long
        left = (np.repeat(first + size, size) - np.arange(len(values)) - 1)[short]
        some = values[short]
        root = _tallied(some, left, bits)
        moved = np.flatnonzero(root != np.arange(len(some)))
        yield batch(some[moved], some[root[moved]])
        if not defer:
            for k in np.flatnonzero(size > LIST):
                some = np.unique(values[first[k] : first[k] + size[k]])
                root = _probed(some, bits)
                moved = np.flatnonzero(root != np.arange(len(some)))
                yield batch(some[moved], some[root[moved]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, over = np.zeros((3, 0), np.int64), None
        for each in batches:
            rows = np.stack([np.asarray(c).astype(np.int64) for c in each.columns])
            if over is not None:  # a list that is deferred already goes on
                more = (rows[:2] == over).all(axis=0)
                if more.any():
                    yield batch(rows[2][more], None, rows[0][more])
                    rows = rows[:, ~more]
            rows = np.concatenate([rest, rows], axis=1)
            if not rows.shape[1]:
                continue
            last = np.flatnonzero((rows[:2] != rows[:2, -1:]).any(axis=0))
            cut = last[-1] + 1 if len(last) else 0  # the last list may go on
            if defer and rows.shape[1] - cut > LIST:
                over, cut = rows[:2, -1:].copy(), rows.shape[1]
            rest = rows[:, cut:]
            if cut:
                yield from lists(rows[:, :cut])
        if rest.shape[1]:
            yield from lists(rest)

    return frugal(run)


def _mask(positions) -> int:
    mask = sum(255 << (8 * p) for p in positions)
    return mask - (1 << 64) if mask >> 63 else mask


def _postings(rows: DataFrame, choices: list[tuple[int, ...]]) -> DataFrame:
    keys = [F.col("fp").bitwiseAND(F.lit(_mask(c)).cast("long")) for c in choices]
    return rows.select(F.posexplode(F.array(*keys)).alias("choice", "key"), "fp")


def _in_lists(postings: DataFrame) -> DataFrame:
    lists = postings.select("choice", "key", "fp").repartition("choice", "key")
    return lists.sortWithinPartitions("choice", "key")


def fingerprint_links(distinct: DataFrame, bits: int = BITS) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of `fp` at most `bits` bits apart."""
    differ = min(bits, 8)
    fixed = range(min(8, differ + KEY_BYTES))
    choices = list(combinations(fixed, len(fixed) - differ))
    wide = list(combinations(range(8), 8 - differ))
    postings = _postings(distinct, choices)

    sample = distinct.filter(F.pmod(F.xxhash64("fp"), F.lit(SAMPLED)) == 0)
    least = max(LIST // SAMPLED * 4, sample.count() // HOT_SHARE + 1)
    hot = _postings(sample, choices).groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n"))
    hot = checkpointed(hot.filter(F.col("n") >= least).select("choice", "key"))
    cold = postings.join(F.broadcast(hot), ["choice", "key"], "left_anti")
    found = checkpointed(_in_lists(cold).mapInArrow(_list_links(bits, True), _LINKS))

    # Of a long list: the choices of more positions that hold its own.
    within = [[k for k, w in enumerate(wide) if set(c) <= set(w)] for c in choices]
    table = F.array(*[F.array(*[F.lit(k) for k in ks]) for ks in within])
    crowded = postings.join(F.broadcast(hot), ["choice", "key"], "left_semi").select("choice", "fp")
    crowded = crowded.union(found.filter("choice is not null").select("choice", F.col("a").alias("fp")))
    masks = F.array(*[F.lit(_mask(w)).cast("long") for w in wide])
    again = crowded.select(F.explode(F.get(table, F.col("choice"))).alias("choice"), "fp")
    again = again.withColumn("key", F.col("fp").bitwiseAND(F.get(masks, F.col("choice"))))
    again = _in_lists(again).mapInArrow(_list_links(bits, False), _LINKS)
    return found.filter("choice is null").select("a", "b").union(again.select("a", "b"))


def _grouped(docs: DataFrame, shingle: int, bits: int, seed: int) -> DataFrame:
    """(doc_id, _th, fp, low) of every row; low is the first (no_id, doc_id, _th) of its component:
    the smallest doc_id, null ones last, and of equal ones the smallest text hash."""
    rows = checkpointed(fingerprints(docs, shingle, seed))
    total = rows.count()
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_th")
    distinct = checkpointed(
        rows.groupBy("fp").agg(F.min(place).alias("low"), F.count(F.lit(1)).alias("n"))
    )
    found = components(fingerprint_links(distinct.select("fp"), bits))
    of = lookup_join(distinct, found.withColumnRenamed("node", "fp"), ["fp"], "left")
    of = checkpointed(of.withColumn("root", F.coalesce("root", "fp")))
    low = of.groupBy("root").agg(F.min("low").alias("low"))
    ids = lookup_join(of.select("fp", "root", "n"), low, ["root"], "left")
    return hot_lookup(rows, ids.select("fp", "n", "low"), "fp", "n", total, "doc_id")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, seed: int = SEED
) -> DataFrame:
    """(doc_id, _th, fp, component_id) of every row.

    component_id is the smallest doc_id that links reach, itself included (null only if all
    of them are null). Texts are lower-cased in A-Z; shingles repeat as often as they
    occur; a text shorter than a shingle is one shingle, and one without words (or a null
    one) has fingerprint zero and links like any other. Repeated rows are one
    fingerprint. An empty table gives an empty result.
    """
    return _grouped(docs, shingle, bits, seed).select(
        "doc_id", "_th", "fp", F.col("low.doc_id").alias("component_id")
    )


def drop_near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, seed: int = SEED
) -> DataFrame:
    """`docs` with one document of each component: the one with the smallest doc_id.

    Null ids come last, and of documents with one id, or none, the smallest text hash stays.
    A row that repeats the kept one's doc_id and text is the same document and stays too."""
    kept = "doc_id <=> low.doc_id and _th = low._th"
    found = _grouped(docs, shingle, bits, seed).filter(f"not ({kept})").select("doc_id", "_th")
    return drop_rows(docs, checkpointed(found))


def op8_simhash(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 lower-case hex digits), component_id."""
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near_duplicates(docs).select("doc_id", digits.alias("fingerprint"), "component_id")
