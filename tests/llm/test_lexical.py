from __future__ import annotations

import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest

from faturaflow.llm import lexical

TERM = re.compile(r"(?:[0-9A-Za-z]|[^\x00-\x7f])+")


def split(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, top=10):
    """docs: (doc_id, text); every row a document."""
    tfs = [Counter(split(t)) for _, t in docs]
    n_docs, length = sum(map(bool, tfs)), sum(sum(c.values()) for c in tfs)
    df = Counter(t for c in tfs for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for (doc_id, _), tf in zip(docs, tfs):
            m = 10 + 90 * sum(tf.values()) * n_docs // max(1, length)
            score = sum(
                floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m))
                for t in set(split(text)) & set(tf)
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        found = sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:top]
        out += [(item_id, k + 1, d, -s) for k, (s, _, d) in enumerate(found)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items_in():
    rng = random.Random(3)
    stems = "ab cd ef gh ij kl mn op qr st uv wx yz".split()
    out = [(k, " ".join("".join(rng.choices(stems, k=rng.randint(1, 3))) for _ in range(30))) for k in range(12)]
    out += [(20, None), (21, ""), (22, " .,- "), (23, "Ab AB ab word WORD0"), (24, "É é 你好 x"), (25, "nowhere")]
    return [*out, (26, "same text here"), (27, "no id")]


@pytest.mark.parametrize("shard, step", [(1 << 20, 32), (64, 1), (300, 4)])
def test_op12_against_brute_force(spark, docs, rows_in, items_in, monkeypatch, shard, step):
    monkeypatch.setattr(lexical, "SHARD", shard)
    monkeypatch.setattr(lexical, "STEP", step)
    monkeypatch.setattr(lexical, "ITEMS", 7)
    items = spark.createDataFrame([(*r, 1, "x") for r in items_in], "item_id long, text string, doc_id int, score string")
    got = sorted((tuple(r) for r in lexical.op12_search(docs, items.repartition(2)).collect()), key=repr)
    assert got == brute([r[:2] for r in rows_in], items_in)
    assert any(r[2] is None for r in got)


def test_op12_of_empty_tables(spark, docs, no_docs, items_in):
    items = spark.createDataFrame(items_in, "item_id long, text string")
    assert lexical.op12_search(no_docs, items).count() == 0
    assert lexical.op12_search(docs, items.limit(0)).count() == 0
    assert lexical.ranked_search(docs, items, top=1).groupBy("item_id").count().filter("count > 1").isEmpty()


def test_search_stops_early_and_misses_no_tie():
    rng = np.random.default_rng(4)
    docs, n_terms = 4000, 6
    for least in (0, 1):
        impact = (10_000 / (1 + np.arange(docs))).astype(int)
        parts = []
        for t in range(n_terms):
            listed = np.concatenate([np.arange(20), 20 + rng.permutation(docs - 20)])
            parts.append((listed, np.full(docs, t), np.maximum(impact, 3 if least else 1)))
        row, term, value = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((term, row))
        row, term, value = row[order], term[order], value[order]
        shard = lexical.Shard(docs, row, term, value, n_terms)
        total = np.bincount(row, value, docs).astype(int)
        item = np.arange(n_terms)
        found, score, read = shard.search(item, 0)
        tenth = np.sort(total)[-10]
        assert sorted(found) == np.flatnonzero(total >= tenth).tolist()
        assert (total[found] == score).all() and read < docs * n_terms / 10
        # Stopping strictly below a score found elsewhere keeps the documents that tie with it.
        ties, _, _ = shard.search(item, int(np.sort(total)[-5]))
        assert sorted(ties) == np.flatnonzero(total >= np.sort(total)[-5]).tolist()
        assert not shard.seen.any() and not shard.met.any() and not shard.asked.any()


def test_equal_scores_are_all_seen():
    """All documents tie: every list has to be read to its end."""
    docs = 500
    shard = lexical.Shard(docs, np.arange(docs), np.zeros(docs, int), np.full(docs, 7), 1)
    found, _, read = shard.search(np.array([0]), 0)
    assert len(found) == docs and read == docs


def test_terms():
    assert lexical.terms("Ab_c É1,\x7fz") == ["ab", "c", "É1", "z"]
    assert lexical.terms(None) == []
