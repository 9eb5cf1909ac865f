from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from faturaflow.llm import bitplanes, components, exact_dedup, simhash, substring, textops
from faturaflow.llm.common import drop_rows

W = b" \t\n\r\x0b\x0c"


@pytest.mark.parametrize("most", [29, 8])
def test_exact_dedup_against_brute_force(docs, rows_in, monkeypatch, most):
    """Also with hashes cut into ranges."""
    monkeypatch.setattr(bitplanes, "MOST_LOG2", most)
    monkeypatch.setattr(bitplanes, "LEAST_LOG2", 8)
    assert (bitplanes.RepeatFilter.ranges(len(rows_in)) > 1) == (most == 8)
    groups = defaultdict(list)
    for doc_id, text, *_ in rows_in:
        bare = (text or "").encode().translate(None, W)
        groups[hashlib.sha256(bare).hexdigest()].append((doc_id, len(text or "")))
    out = exact_dedup.op7_exact_dedup(docs).collect()
    assert len(out) == len(rows_in)
    seen = defaultdict(list)
    for r in out:
        seen[r.text_sha256].append(r)
    assert set(seen) == set(groups)
    for h, members in groups.items():
        best = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))
        assert {(r.keep_id, r.group_size) for r in seen[h]} == {(best[0], len(members))}
        assert [r.doc_id for r in seen[h] if r.kept] == [best[0]]


def test_exact_dedup_keeps_columns(docs, no_docs):
    out = exact_dedup.exact_dedup(docs)
    assert {"lang", "source", "size", "_th"} <= set(out.columns)
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns and {r.kept for r in left.collect()} == {"x"}
    assert exact_dedup.op7_exact_dedup(no_docs).count() == 0


def test_single_rows_pass_at_any_size(spark, monkeypatch):
    """The share of rows without a copy that a filter lets through is the same beyond its bound."""
    monkeypatch.setattr(bitplanes, "LEAST_LOG2", 8)
    shares = []
    for most, n in ((29, 2000), (12, 2000), (12, 500)):
        monkeypatch.setattr(bitplanes, "MOST_LOG2", most)
        rows = spark.range(n).selectExpr("id AS doc_id", "sha2(cast(id AS string), 256) AS text_sha256")
        shares.append(exact_dedup._flagged(rows, n).filter("_maybe").count() / n)
    assert max(shares) < 0.02


def test_the_same_tied_row_stays_in_any_order(spark):
    rows = [(1, "a b", f"s{k}") for k in range(9)] + [(None, "c d", f"s{k}") for k in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = [sorted(map(tuple, exact_dedup.drop_copies(df.repartition(k, "source")).collect()), key=repr) for k in (1, 4, 7)]
    assert left[0] == left[1] == left[2] and len(left[0]) == 2


def brute_simhash(text):
    w = [x.decode() for x in (text or "").encode().lower().split()]
    if not w:
        return 0
    s = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(pairs):
    """pairs: (doc_id, fingerprint); component id by fingerprint."""
    fps = sorted({f for _, f in pairs})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if bin(a ^ b).count("1") <= 2:
                root[find(a)] = find(b)
    low = defaultdict(list)
    for d, f in pairs:
        low[find(f)].append(d)
    least = {r: min((d for d in v if d is not None), default=None) for r, v in low.items()}
    return {f: least[find(f)] for f in fps}


def test_simhash_against_brute_force(docs, rows_in, no_docs):
    pairs = [(r[0], brute_simhash(r[1])) for r in rows_in]
    of = brute_components(pairs)
    want = sorted(((d, f"{f:016x}", of[f]) for d, f in pairs), key=repr)
    assert sorted(map(tuple, simhash.op8_simhash(docs).collect()), key=repr) == want
    assert simhash.op8_simhash(no_docs).count() == 0


@pytest.mark.parametrize("longest, sampled", [(1024, 64), (3, 64), (3, 1)])
def test_links_of_random_and_clustered_fingerprints(spark, monkeypatch, longest, sampled):
    """Also with lists that are keyed once more, found in their task or by the sample, over many batches."""
    monkeypatch.setattr(simhash, "LIST", longest)
    monkeypatch.setattr(simhash, "SAMPLED", sampled)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        links_of_random_and_clustered_fingerprints(spark)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_only_pairs_that_reach_the_minimum_are_verified(monkeypatch):
    """Six of eight bytes shared, in any number of bits, pass the tally; five do not."""
    seen = []
    count = np.bitwise_count
    monkeypatch.setattr(simhash.np, "bitwise_count", lambda x: seen.extend(x.tolist()) or count(x))
    values = np.array([0, 0x0300, 0x0F00FF, 0x010101], np.uint64)
    root = simhash._tallied(values, np.array([3, 2, 1, 0]), 2)
    assert root.tolist() == [0, 0, 2, 3]
    assert sorted(seen) == sorted([0x0300, 0x0F00FF])


def links_of_random_and_clustered_fingerprints(spark):
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(200)}
    for _ in range(40):  # chains of one or two changed bits, and a crowd around one value
        x = rng.getrandbits(64)
        for _ in range(10):
            x ^= 1 << rng.randrange(64)
            x ^= 1 << rng.randrange(64) if rng.random() < 0.5 else 0
            fps.add(x)
    hub = rng.getrandbits(64)
    fps |= {hub ^ (1 << i) ^ (1 << j) for i in range(16) for j in range(16)}
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    distinct = spark.createDataFrame([(s,) for s in signed], "fp long").repartition(4)
    found = components.components(simhash.fingerprint_links(distinct)).collect()
    root = {r.node: r.root for r in found}
    got, want = defaultdict(set), defaultdict(set)
    of = brute_components([(s, f) for s, f in zip(signed, fps)])
    for s, f in zip(signed, fps):
        got[root.get(s, s)].add(s)
        want[of[f]].add(s)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5, 5)]
    out = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = defaultdict(set)
    for r in out:
        groups[r.root].add(r.node)
    assert sorted(map(len, groups.values())) == [301, 400]


def test_drop_near_duplicates_keeps_the_smallest(docs, rows_in):
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    pairs = [(r[0], brute_simhash(r[1])) for r in rows_in]
    of = brute_components(pairs)
    want = sorted((d for d, f in pairs if d is None or d == of[f]), key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == want


def test_drop_near_duplicates_leaves_one_document_of_a_group(spark):
    def spaced(text):
        return [text, f"{text} ", f" {text}", text.replace(" ", "  ")]

    def first(texts):
        return min(texts, key=lambda t: int(np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).view(np.int64)))

    no_id, one_id, mixed = map(spaced, ("nobody knows my number", "five of the same id", "some have one"))
    rows = [(None, t) for t in no_id] + [(5, t) for t in one_id] + [(5, "alone with a shared id")]
    rows += [(None, mixed[0]), (9, mixed[1]), (8, mixed[2]), (8, mixed[3])]
    want = [(None, first(no_id)), (5, first(one_id)), (5, "alone with a shared id"), (8, first(mixed[2:]))]
    for parts in (1, 5):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        left = sorted(map(tuple, simhash.drop_near_duplicates(df).collect()), key=repr)
        assert left == sorted(want, key=repr)


def test_drop_rows_is_exact(spark, docs):
    keyed = docs.limit(0).selectExpr("doc_id", "xxhash64(coalesce(text, '')) AS _th")
    assert drop_rows(docs, keyed).count() == docs.count()
    gone = docs.filter("doc_id = 7").selectExpr("doc_id", "xxhash64(text) AS _th").limit(1)
    text = docs.filter("doc_id = 7").first().text
    left = drop_rows(docs, spark.createDataFrame(gone.collect(), gone.schema))
    assert docs.count() - left.count() in (1, 2) and text is not None


def brute_substring(rows, width=20):
    places = sorted(
        {(d is not None, d or 0, xxhash.xxh64_intdigest((t or "").encode(), 42), t or "") for d, t in rows},
        key=lambda p: (p[0], p[1], int(np.uint64(p[2]).view(np.int64))),
    )
    seen, out = set(), {}
    for has, d, _, t in places:
        w = t.encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            key = tuple(w[i : i + width])
            if key in seen:
                gone[i : i + width] = [True] * width
            seen.add(key)
        kept = [x for x, g in zip(w, gone) if not g]
        out[d if has else None, t] = (len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def test_substring_against_brute_force(docs, rows_in, no_docs, monkeypatch):
    pairs = [(r[0], r[1]) for r in rows_in]
    want = brute_substring(pairs)
    want = sorted(((d, *want[d, t or ""]) for d, t in pairs), key=repr)
    assert sorted(map(tuple, substring.op9_substring(docs).collect()), key=repr) == want
    assert sum(w[2] for w in want) > 1000
    assert substring.op9_substring(no_docs).count() == 0


def test_substring_over_blocks_and_chunks(spark, monkeypatch):
    """Many blocks in a task, and many Arrow batches for the grouping."""
    monkeypatch.setattr(substring, "BLOCK", 50)
    monkeypatch.setattr(textops, "CHUNK_BYTES", 2000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rng = random.Random(5)
        pool = ["".join(rng.choices("abc", k=3)) for _ in range(30)]
        shared = [" ".join(rng.choices(pool, k=rng.randint(25, 200))) for _ in range(8)]
        texts = [" ".join([rng.choice(shared), *rng.choices(pool, k=30), rng.choice(shared)]) for _ in range(60)]
        texts.append("x " * 500)
        pairs = list(enumerate(texts))
        df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(3)
        want = brute_substring(pairs)
        got = {r.doc_id: tuple(r)[1:] for r in substring.op9_substring(df).collect()}
        assert got == {d: want[d, t] for d, t in pairs}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_planes_merge_and_never_undercount():
    rng = np.random.default_rng(1)
    keys = rng.integers(-(1 << 62), 1 << 62, (2, 3000))
    parts = [bitplanes.Planes(16, 2) for _ in range(3)]
    for k in range(3):
        parts[k].add(keys[0, k * 800 : k * 800 + 1000], keys[1, k * 800 : k * 800 + 1000])
    rows = sorted((b for p in parts for b in p.segments()), key=lambda b: b.column(0)[0].as_py())
    (whole,) = bitplanes._merge(iter(rows))
    twos = np.frombuffer(__import__("zlib").decompress(whole.column(2)[0].as_py()), np.uint8)
    seen = bitplanes.test_plane(twos, keys[0], keys[1], 16, 2)
    assert seen[800:1000].all() and seen[1600:1800].all() and seen.mean() < 0.4


def test_rolling_hashes_are_exact_functions_of_their_window():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 1 << 63, 70_000, dtype=np.uint64)
    values[60_000:60_100] = values[100:200]
    for base in substring._BASES:
        h = textops.rolling(values, 20, base)
        assert (h[60_000:60_081] == h[100:181]).all()
        assert len(np.unique(h)) == len(h) - 81
