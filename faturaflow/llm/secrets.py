"""Secret scan: fixed patterns, and character Markov models of random strings and identifiers.

The patterns' own matches are the labelled samples of random strings. Samples of ordinary
identifiers are labelled by their shape: all other runs of the corpus, and what its lower-case words
become in CONSTANT_CASE, CamelCase and with numbers, as prose has few of these itself. Both
give counts of character pairs, over every document. A long run is a secret if its log-likelihood
ratio per character is high enough.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faturaflow.llm.bitplanes import frugal
from faturaflow.llm.textops import chunks

# Fixed values of the contract: kinds in listed order, patterns, least characters.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGN = 8
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Runs that the models judge: least characters, and least mean log-likelihood ratio (nats).
RUN, LEAST_RATIO = 20, 0.1
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
LONG_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % RUN)
KINDS = ("assign", "access", "hex", "markov")

_N, _PLAIN = len(ALPHABET) + 1, 62
_UPPER, _LOWER, _DIGIT = slice(1, 27), slice(27, 53), slice(53, 63)
#: Shapes of identifiers: how often a capital goes on in capitals rather than in small letters, a small letter
#: is followed by a capital (a word of about eight letters ends) or by a digit, and a digit by a letter.
CONSTANT, NEXT_WORD, NUMBER, WORD_AFTER = 0.5, 1 / 8, 1 / 25, 1 / 5
#: Share of words that the corpus says nothing of, and the classes of letters of the model without its first row.
OTHER_WORDS = 0.5
_CLASSES = (slice(0, 26), slice(26, 52), slice(52, 62), slice(62, _N - 1))
_CODE = np.zeros(256, np.int64)
_CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(1, _N)


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and not overlapping within a kind."""
    found = [
        (m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN
    ]
    found += [(m.start(), k, m.end()) for k, p in ((1, ACCESS), (2, HEX)) for m in p.finditer(text)]
    return [(s, KINDS[k], e) for s, k, e in sorted(found)]


def _inner(offsets: np.ndarray) -> np.ndarray:
    """Byte places at which a row begins right after the bytes of another one."""
    at = offsets[1:-1]
    return at[(at > 0) & (at < offsets[-1])]


def _pairs(codes: np.ndarray, begins: np.ndarray | None = None) -> np.ndarray:
    """Counts of neighbouring characters of the alphabet; none reaches over a place in `begins`."""
    a, b = codes[:-1], codes[1:]
    both = (a > 0) & (b > 0)
    if begins is not None:
        both[begins - 1] = False
    return np.bincount(a[both] * _N + b[both], minlength=_N * _N)


def _rows_at(chunk, places: np.ndarray) -> np.ndarray:
    """Rows of the chunk in which the byte places lie."""
    return np.unique(np.searchsorted(chunk.offsets, places, "right") - 1)


def _suspects(chunk, codes: np.ndarray) -> list[int]:
    """Rows that may have any match: long runs, or a keyword of the patterns.

    A run ends with its row, whatever the next row starts with."""
    some = codes > 0
    before, after = (np.concatenate(x) for x in (([False], some[:-1]), (some[1:], [False])))
    at = _inner(chunk.offsets)
    before[at], after[at - 1] = False, False
    starts, ends = np.flatnonzero(some & ~before), np.flatnonzero(some & ~after) + 1
    places = [starts[ends - starts >= min(RUN, 16)]]
    raw = chunk.data.tobytes()
    low = raw.lower()
    for word in WORDS:
        at = low.find(word)
        while at >= 0:
            places.append(np.array([at]))
            # one match in a row is enough: go on in the next row
            row = int(np.searchsorted(chunk.offsets, at, "right"))
            at = low.find(word, int(chunk.offsets[min(row, len(chunk.offsets) - 1)])) if row < len(chunk.offsets) else -1
    return _rows_at(chunk, np.concatenate(places)).tolist()


def pair_counts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Pair counts of (random strings, ordinary identifiers) over all documents.

    What reaches the driver is a square of the alphabet per model, whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, random = np.zeros(_N * _N, np.int64), np.zeros(_N * _N, np.int64)
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                codes = _CODE[chunk.data]
                total += _pairs(codes, _inner(chunk.offsets))
                for k in _suspects(chunk, codes):
                    text = chunk.text(k)
                    for start, _, end in base_spans(text):
                        # the value, after any `keyword = "`
                        value = re.split(r"[:=\x20\"']+", text[start:end].rstrip("="))[-1]
                        if len(value) > 1:
                            random += _pairs(_CODE[np.frombuffer(value.encode(), np.uint8)])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(random[at]), pa.array(total[at])], ["pair", "random", "total"]
        )

    parts = docs.select("text").mapInArrow(frugal(run), "pair long, random long, total long")
    sums = parts.groupBy("pair").agg(F.sum("random"), F.sum("total")).collect()
    random, total = np.zeros(_N * _N), np.zeros(_N * _N)
    for pair, r, t in sums:
        random[pair], total[pair] = r, t
    return random, np.maximum(total - random, 0)


def shaped(ordinary: np.ndarray) -> np.ndarray:
    """Pair counts of ordinary identifiers of every shape, from those of the corpus: as many pairs
    again are made from its lower-case pairs. Digits follow each other evenly, as in numbers and dates."""
    table = ordinary.reshape(_N, _N).astype(float)
    low = table[_LOWER, _LOWER] + 1e-9
    rows = low.sum(axis=1, keepdims=True)
    step, weight = low / rows, rows  # P(next | this) within words, and how often each letter comes
    first = rows / rows.sum()
    made = np.zeros_like(table)
    made[_LOWER, _LOWER] = weight * step * (1 - NEXT_WORD - NUMBER)
    made[_LOWER, _UPPER] = weight * first.T * NEXT_WORD
    made[_LOWER, _DIGIT] = weight * NUMBER / 10
    made[_UPPER, _UPPER] = weight * step * CONSTANT * (1 - NUMBER)
    made[_UPPER, _LOWER] = weight * step * (1 - CONSTANT) * (1 - NUMBER)
    made[_UPPER, _DIGIT] = weight * NUMBER / 10
    made[_DIGIT, _DIGIT] = weight.mean() * (1 - WORD_AFTER) / 10
    made[_DIGIT, _LOWER] = made[_DIGIT, _UPPER] = weight.mean() * first.T * WORD_AFTER / 2
    return (table + made).ravel()


def log_ratios(random: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    """log P(next | this) of random strings over that of identifiers, for each pair.

    Random strings are smoothed with the uniform distribution, so that characters which no
    sample has still count as random; identifiers with their own frequencies of characters.
    Without samples of random strings every ratio is 0.
    """
    out = np.zeros((_N, _N))
    if not random.any():
        return out
    ordinary = shaped(ordinary)

    def model(counts: np.ndarray, base: np.ndarray, weight: float) -> np.ndarray:
        table = counts.reshape(_N, _N)[1:, 1:]
        return (table + weight * base) / (table.sum(axis=1, keepdims=True) + weight)

    uniform = np.full(_N - 1, 1 / (_N - 1))
    usual = ordinary.reshape(_N, _N)[1:, 1:].sum(axis=0) + 0.5
    drawn = 0.5 * model(random, uniform, 1.0) + 0.5 * uniform
    known = model(ordinary, usual / usual.sum(), 1000.0)
    # Words that the corpus does not have are ordinary too: letters of a class stand in for each other.
    any_word = np.zeros_like(known)
    for one in _CLASSES:
        for other in _CLASSES:
            any_word[one, other] = known[one, other].mean()
    out[1:, 1:] = np.log(drawn) - np.log((1 - OTHER_WORDS) * known + OTHER_WORDS * any_word)
    return out


def mean_ratio(value: str, ratios: np.ndarray) -> float:
    """Mean over pairs of letters and digits: separators join identifiers as well as random bytes."""
    codes = _CODE[np.frombuffer(value.encode(), np.uint8)]
    a, b = codes[:-1], codes[1:]
    plain = (a <= _PLAIN) & (b <= _PLAIN)
    return float(ratios[a[plain], b[plain]].mean()) if plain.any() else 0.0


def all_spans(text: str, ratios: np.ndarray, least: float = LEAST_RATIO) -> tuple[list, list]:
    """(base spans, all spans). A long run that no base span touches is judged by the models."""
    base = base_spans(text)
    more = []
    # By start; `reach` has the last end so far, so a run touches a span if the spans that start before its end reach into it.
    starts, reach = [s for s, _, _ in base], list(accumulate((e for _, _, e in base), max))
    for m in LONG_RUN.finditer(text):
        before = bisect_left(starts, m.end())
        touched = before and reach[before - 1] > m.start()
        if not touched and mean_ratio(m[0], ratios) >= least:
            more.append((m.start(), "markov", m.end()))
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted(base + more, key=lambda x: (x[0], order[x[1]]))


def _joined(spans: list) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, k, e in spans)


def find_secrets(docs: DataFrame, least: float = LEAST_RATIO) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_spans, spans) of every row.

    Spans are kind:start:end in code points, end exclusive, by start and then by kind, joined
    by commas. A null text is empty and has none. Repeated rows are scanned each. In a corpus
    without labelled samples the models are uniform and say the same of every run: no secret.
    """
    ratios = log_ratios(*pair_counts(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            counts = np.zeros((3, n), np.int64)
            joined = [[""] * n, [""] * n]
            for chunk in chunks(batch.column(1)):
                for k in _suspects(chunk, _CODE[chunk.data]):
                    base, spans = all_spans(chunk.text(k), ratios, least)
                    for _, kind, _ in base:
                        counts[KINDS.index(kind), chunk.first + k] += 1
                    joined[0][chunk.first + k] = _joined(base)
                    joined[1][chunk.first + k] = _joined(spans)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c) for c in counts), *(pa.array(j, pa.string()) for j in joined)],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "spans"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        frugal(run), "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, spans string"
    )


def op6_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    return find_secrets(docs).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )
