from __future__ import annotations

import hashlib
import random

import pytest
import xxhash

from faturaflow.llm import suffix_sort

LEAST = -(1 << 63)


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def brute(rows, width):
    """rows: (doc_id, text). Identical rows are one document; others with one id come by hash."""
    key = lambda r: (LEAST if r[0] is None else r[0], signed(xxhash.xxh64_intdigest((r[1] or "").encode(), 42)))
    seen, out = set(), {}
    for k, text in sorted({(key(r), r[1] or "") for r in rows}):
        data = text.encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            if (w := data[i : i + width]) in seen:
                gone[i : i + width] = b"\1" * width
            seen.add(w)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        n_spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[k] = (len(data), sum(gone), n_spans, hashlib.sha256(kept).hexdigest())
    return sorted([(r[0], *out[key(r)]) for r in rows], key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_op11_against_brute_force(docs, rows_in, no_docs):
    want = brute([r[:2] for r in rows_in], 100)
    assert got(suffix_sort.op11_suffix(docs)) == want
    assert sum(r[2] for r in want) > 1000
    assert suffix_sort.op11_suffix(no_docs).count() == 0


def mixed(rng):
    """Shared pieces of all lengths about the width, periodic stretches, other alphabets."""
    pieces = ["".join(rng.choices("abcdé 你", k=rng.randint(5, 140))) for _ in range(12)] + ["x" * 150, "ab" * 70]
    rows = []
    for k in range(120):
        text = "".join(
            rng.choice(pieces)[rng.randint(0, 9) :] if rng.random() < 0.5 else "".join(rng.choices("abcdé 你", k=rng.randint(0, 60)))
            for _ in range(rng.randint(0, 6))
        )
        rows.append((rng.choice([k, k, None, 5]), text))
    return rows


@pytest.mark.parametrize("width, slab, block, sample", [(100, 1 << 18, 1 << 18, 64), (40, 64, 50, 1), (9, 500, 1 << 18, 1), (1, 7, 30, 1)])
def test_any_width_and_any_cut(spark, monkeypatch, width, slab, block, sample):
    for name, value in (("SLAB", slab), ("BLOCK", block), ("SAMPLE", sample), ("ROWS", 37)):
        monkeypatch.setattr(suffix_sort, name, value)
    rows = mixed(random.Random(width))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = suffix_sort.suffix_dedup(docs, width)
    from pyspark.sql import functions as F

    digest = out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long"), F.size("spans"), F.sha2("kept", 256))
    assert got(digest) == brute(rows, width)


def test_frequent_passages_are_spread(spark, monkeypatch):
    """One line in every document, between others: its digits are frequent."""
    monkeypatch.setattr(suffix_sort, "SAMPLE", 1)
    rng = random.Random(2)
    word = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    line = word(110)
    rows = [(k, word(70) + line + word(70)) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(suffix_sort.op11_suffix(docs)) == brute(rows, 100)
