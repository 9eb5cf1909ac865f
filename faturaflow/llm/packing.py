"""Packing of token sequences: bounded-space online best-fit.

Every task packs its share of the pieces on its own, each piece as it comes, in an order fixed
by a hash. A fixed number of bins is open. A bitset over free space says which bins there are, so
the best fit, the least free space that is enough, is one shift and one lowest bit away. When
there are too many open bins, the fullest one closes first.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, LongType, StructType

from faturaflow.llm.bitplanes import frugal
from faturaflow.llm.common import text_hash

#: The contract: tokens of a sequence, the id after each document, and the vocabulary.
LENGTH, END, VOCABULARY = 1024, 2, "byte_bpe_50k"
#: Open bins of a task, and documents whose pieces a task packs on average.
OPEN_BINS, PER_TASK = 4096, 50_000
#: A text with this string has a special token, which only the tokenizer file knows.
_SPECIAL = "<|endoftext|>"


class Encoder:
    """Token ids of texts as the tokenizer file gives them, without added special tokens.

    The same vocabulary as ranks gives the same ids for texts without the special token's
    string, at a quarter of the CPU time; the others go through the tokenizer file itself.
    """

    def __init__(self, tokenizer_file: str, ranks_file: str, pattern: str):
        self.files, self.pattern = (tokenizer_file, ranks_file), pattern

    def __call__(self):
        import tiktoken
        from tokenizers import Tokenizer

        with open(self.files[1], "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding(
            "ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={}
        )
        slow = []

        def encode(text: str) -> list[int]:
            if _SPECIAL not in text:
                return fast.encode_ordinary(text)
            if not slow:
                slow.append(Tokenizer.from_file(self.files[0]))
            return slow[0].encode(text, add_special_tokens=False).ids

        return encode


def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    import public_tokenizers as files

    return Encoder(files.path(f"{vocabulary}.json"), files.path(f"{vocabulary}.tiktoken"), files.PATTERN)


def pieces(
    docs: DataFrame, encode: Encoder, length: int = LENGTH, end: int = END
) -> DataFrame:
    """(doc_id, _th, piece, start, length, ids binary): each document's ids, then `end`, cut.

    ids are unsigned 32-bit numbers, low byte first. Only documents longer than `length` are
    cut; their first piece has the odd rest. A null text is empty: its piece is `end` alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, cols, held = encode(), [[] for _ in range(6)], 0

        def out() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            names = ["doc_id", "_th", "piece", "start", "length", "ids"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

        for batch in batches:
            for doc_id, th, text in zip(*batch.columns):
                ids = np.array([*one(text.as_py() or ""), end], "<u4")
                first = len(ids) % length or min(length, len(ids))
                places = [0, *range(first, len(ids), length)]
                for k, at in enumerate(places):
                    part = ids[at : first if k == 0 else at + length]
                    row = (doc_id.as_py(), th.as_py(), k, at, len(part), part.tobytes())
                    for col, value in zip(cols, row):
                        col.append(value)
                    held += len(part)
                if held > 1 << 20:
                    yield out()
                    cols, held = [[] for _ in range(6)], 0
        if cols[0]:
            yield out()

    rows = docs.select(F.col("doc_id").cast("long"), text_hash(F.col("text")).alias("_th"), "text")
    return rows.mapInArrow(
        frugal(run), "doc_id long, _th long, piece int, start long, length long, ids binary"
    )


class Bins:
    """Open bins by free space. `bits` has bit f set if a bin with f free places is open."""

    def __init__(self, length: int, most: int, first: int):
        self.length, self.most, self.next = length, most, first
        self.bits, self.open = 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(length + 1)]

    def _pop(self, free: int) -> int:
        found = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits ^= 1 << free
        self.open -= 1
        return found

    def put(self, size: int) -> tuple[int, int]:
        """(bin, place in it) of a piece of at most `length` tokens."""
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            into = self._pop(free)
        else:
            into, free = self.next, self.length
            self.next += 1
        at, left = self.length - free, free - size
        if left:
            self.by_free[left].append(into)
            self.bits |= 1 << left
            self.open += 1
            if self.open > self.most:
                self._pop((self.bits & -self.bits).bit_length() - 1)
        return into, at


def best_fit(
    rows: DataFrame, tasks: int, length: int = LENGTH, open_bins: int = OPEN_BINS
) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, _th, piece and length (1 to `length`).

    No sequence has more than `length` tokens, and its pieces follow each other without gaps.
    """
    new = [StructField(n, LongType()) for n in ("sequence_id", "offset")]
    schema = StructType([*rows.schema.fields, *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins(length, open_bins, TaskContext.get().partitionId() << 40)
        for batch in batches:
            sizes = batch.column("length").to_pylist()
            put = np.array([bins.put(n) for n in sizes], np.int64).reshape(-1, 2)
            cols = [*batch.columns, pa.array(put[:, 0].copy()), pa.array(put[:, 1].copy())]
            yield pa.RecordBatch.from_arrays(cols, [f.name for f in schema])

    by = F.xxhash64("doc_id", "_th", "piece")
    order = ["_by", "doc_id", "_th", "piece"]
    dealt = rows.withColumn("_by", by).repartition(tasks, "_by").sortWithinPartitions(*order)
    return dealt.drop("_by").mapInArrow(frugal(run), schema)


def pack(
    docs: DataFrame, encode: Encoder | None = None, length: int = LENGTH, end: int = END, **how
) -> DataFrame:
    """All pieces of `docs` with their ids, sequence_id and offset.

    Repeated rows are packed once each. An empty table gives an empty result.
    """
    tasks = max(1, -(-docs.count() // PER_TASK))
    return best_fit(pieces(docs, encode or encoder(), length, end), tasks, length, **how)


def op3_pack(docs: DataFrame) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    tasks = max(1, -(-docs.count() // PER_TASK))
    rows = pieces(docs, encoder()).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return best_fit(rows, tasks).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
