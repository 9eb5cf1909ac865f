from __future__ import annotations

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from faturaflow.llm import mixing, packing, quality, secrets, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# quality


def brute_surface(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    win = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    count = Counter(win)
    covered = {j for i, x in enumerate(win) if count[x] > 1 for j in range(i, i + 8)}
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
        len(w) < 20 or 100 * len(covered) > 30 * len(w),
    )


def test_quality_surface(spark, docs, rows_in):
    labels = spark.createDataFrame([(r[0], 1) for r in rows_in if r[0]], "doc_id long, quality int")
    out = quality.op2_quality(docs, labels).collect()
    got = sorted((tuple(r)[:7] for r in out), key=repr)
    want = sorted(((r[0], *brute_surface(r[1])) for r in rows_in), key=repr)
    assert got == want
    assert all(not r.kept for r in out if r.base_failed)


def test_quality_buckets_grow_with_the_corpus():
    sizes = [0, 1 << 28, 3 * 10**8, 30 * 10**9, 10**14]
    assert [quality.bucket_count(n).bit_length() - 1 for n in sizes] == [14, 14, 15, 17, 21]


@pytest.mark.parametrize("unit", [1 << 28, 1])
def test_quality_score(spark, no_docs, monkeypatch, unit):
    import xxhash
    from math import log

    monkeypatch.setattr(quality, "BUCKETS_FOR", unit)  # of one byte: more buckets

    texts = {1: "the cat sat on the mat " * 4, 2: "the cat sat on The mat", 3: "### $$$ %%% the", 4: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    buckets = quality.bucket_count(sum(len(t or "") for t in texts.values()))
    assert (buckets > quality.BUCKETS) == (unit == 1)
    labels = spark.createDataFrame([(1, 1), (3, 0), (2, None)], "doc_id long, quality int")
    out = {r.doc_id: r for r in quality.op2_quality(docs, labels).collect()}

    def grams(t):
        w = [x.lower().encode() for x in WORD.findall(t or "")]
        h = [xxhash.xxh64_intdigest(x, 42) for x in w]
        two = [xxhash.xxh64_intdigest(b, np.uint64(a).item()) for a, b in zip(h, w[1:])]
        return [int(np.uint64(x).view(np.int64)) % buckets for x in h + two]

    raw = Counter(g for t in texts.values() for g in grams(t))
    target = Counter(grams(texts[1]))
    n, m = sum(raw.values()) + buckets, sum(target.values()) + buckets
    for d, t in texts.items():
        g = grams(t)
        want = sum(log((target[x] + 1) / m) - log((raw[x] + 1) / n) for x in g) / len(g) if g else 0
        assert out[d].score == pytest.approx(want, abs=1e-6)
    assert quality.op2_quality(no_docs, labels).count() == 0
    none = quality.op2_quality(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.0}


def test_quality_can_be_filtered(spark):
    """A filter on a result does not repeat the chain that computed it."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    good = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("quality = 1").select("doc_id")
    size = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString())
    whole = quality.quality(docs, good)
    assert size(whole.filter("kept and n_words > 30")) < 1.2 * size(whole)
    want = sum(r.kept for r in whole.select("kept").collect())
    assert whole.filter("kept").count() == want > 0
    repeated = quality.surface(docs).filter("n_repeat_words > 3")
    assert repeated.count() == whole.filter("n_repeat_words > 3").count() > 0


def test_quality_is_native(docs, spark):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    plan = quality.op2_quality(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# mixing


def brute_mix(rows):
    """rows: (doc_id, source, size). Target by source, by water filling."""
    size = defaultdict(int)
    for _, s, n in rows:
        size[s] += n
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, free, target = 1.5 * sum(size.values()), set(order), {}
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] >= 2 * size[s]}
        if not over:
            return size, target | share
        for s in over:
            target[s] = 2.0 * size[s]
        left -= sum(target[s] for s in over)
        free -= over
    return size, target


def test_mix(docs, rows_in, no_docs):
    rows = [(r[0], r[3], len(WORD.findall(r[1] or ""))) for r in rows_in]
    size, target = brute_mix(rows)
    out = mixing.op10_mix(docs).collect()
    assert out and sorted(map(repr, out)) == sorted(map(repr, mixing.op10_mix(docs.repartition(5)).collect()))
    taken, per = defaultdict(int), defaultdict(list)
    by_id = defaultdict(set)
    for d, s, n in rows:
        by_id[d].add((s, n))
    for r in out:
        assert 0 <= r.taken <= 2 * r["size"]
        (source,) = {s for s, n in by_id[r.doc_id] if n == r["size"]}
        assert r.source_size == size[source] and r.target == pytest.approx(target[source])
        taken[source] += r.taken
        per[source].append(r)
    for s in size:
        assert abs(taken[s] - int(target[s] + 1e-9)) <= 2, s
    assert mixing.op10_mix(no_docs).count() == 0


def test_mixed_documents(docs):
    words = lambda t: len(WORD.findall(t or ""))
    taken = sum(r.taken for r in mixing.mix(docs).select("taken").collect())
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert {r["size"] for r in out.select("size").collect()} == {"x"}
    assert sum(words(r.text) for r in out.select("text").collect()) == taken


def test_mix_is_native(docs):
    plan = mixing.op10_mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# packing


def check_packing(out, length):
    seqs = defaultdict(list)
    for r in out:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return seqs


def test_pack_round_trip(docs, rows_in, no_docs):
    import public_tokenizers as files
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(files.path("byte_bpe_50k.json"))
    want = Counter()
    for doc_id, text, *_ in rows_in:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        n = len(ids)
        first = n if n <= 1024 else n % 1024 or 1024
        cuts = [0, *range(first, n, 1024), n]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc_id, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))] += 1
    out = packing.op3_pack(docs).collect()
    assert Counter(tuple(r)[:5] for r in out) == want
    seqs = check_packing(out, 1024)
    assert len(seqs) <= 1.05 * sum(r.length for r in out) / 1024 + 2
    assert packing.op3_pack(no_docs).count() == 0


def test_special_token_string(spark):
    docs = spark.createDataFrame([(1, "a<|endoftext|>b")], "doc_id long, text string")
    row = packing.pieces(docs, packing.encoder()).first()
    assert np.frombuffer(row.ids, "<u4").tolist() == [64, 50256, 65, 2]


def test_open_bins_are_bounded_and_the_fullest_closes():
    bins = packing.Bins(100, 2, 0)
    assert bins.put(60) == (0, 0) and bins.put(70) == (1, 0)
    assert bins.put(80) == (2, 0)  # three open: bin 2 has the least free space and closes
    assert bins.open == 2 and bins.put(20) == (1, 70)  # best fit: 30 free, not 40
    assert bins.put(10) == (1, 90) and bins.put(40) == (0, 60) and bins.open == 0
    rng = np.random.default_rng(1)
    bins = packing.Bins(1024, 64, 0)
    for n in rng.integers(1, 1025, 3000):
        into, at = bins.put(int(n))
        assert 0 <= at <= 1024 - n
        assert bins.open == sum(map(len, bins.by_free)) <= 64


def test_pieces_are_packed_in_the_order_of_their_hash(spark):
    """One task: the sequences are those of one pass over the pieces by hash, with bins that close."""
    rng = np.random.default_rng(4)
    rows = [(i, i * 7, 0, int(n)) for i, n in enumerate(rng.integers(1, 1025, 2000))]
    df = spark.createDataFrame(rows, "doc_id long, _th long, piece int, length long").repartition(5)
    by = df.selectExpr("xxhash64(doc_id, _th, piece) AS h", "doc_id", "length").collect()
    bins, want, closed = packing.Bins(1024, 32, 0), {}, 0
    for r in sorted(by):
        want[r.doc_id] = bins.put(r.length)
        closed += bins.open == 32
    got = {r.doc_id: (r.sequence_id, r.offset) for r in packing.best_fit(df, 1, open_bins=32).collect()}
    assert got == want and closed > 1000


# secrets


def brute_secrets(text):
    text = text or ""
    found = []
    for order, (kind, pattern, ok) in enumerate(
        (
            ("assign", secrets.ASSIGN, lambda m: len(m[2]) >= 8),
            ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
            ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32),
        )
    ):
        found += [(m.start(), order, m.end(), kind) for m in pattern.finditer(text) if ok(m)]
    joined = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))
    return (*(sum(f[1] == k for f in found) for k in range(3)), hashlib.sha256(joined.encode()).hexdigest())


HEX = "0123456789abcdef" * 2
CASES = [
    "é token = \"ffc3105535f423f352535e4ac53b5fefe076ac6d\" ü", 'API_KEY:abcdefgh apikey="1234567"',
    "AKIAABCDEFGHIJKL AKIASHORT AKIAAKIAAKIAAKIA", HEX, HEX[:31], f"x{HEX}g{HEX}", "secret=token: abcdefghijk",
    "PASSWD  =  'aaaaaaaa' Password:bbbbbbbbbb", "toKen=abcdefghijk", "token=secret=abcdefghijk", None, "",
    "q7Zp0XvR2mKfT9wLbN4sJ1hYcD8e and xK3vPq9ZtR5wBn7LmC2dFg6HjS8yA4uE", "plain-words-joined-by-hyphens-only",
]


def test_secrets(spark, docs, rows_in, no_docs):
    rng = np.random.default_rng(3)
    keys = ["".join(rng.choice(list(secrets.ALPHABET[:62]), 32)) for _ in range(200)]
    prose = "the cat sat on plain-words-joined-by-hyphens-only near some_identifier_names of a file "
    train = [(1000 + i, f"token={k} {prose * 3}") for i, k in enumerate(keys)]
    rows = [*enumerate(CASES, 5000), *train, *((r[0], r[1]) for r in rows_in)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = secrets.op6_secrets(df).collect()
    want = sorted(((d, *brute_secrets(t)) for d, t in rows), key=repr)
    assert sorted((tuple(r)[:5] for r in out), key=repr) == want
    spans = {r.doc_id: r.spans for r in out if r.doc_id is not None}
    assert spans[5012] == "markov:0:28,markov:33:65"
    assert spans[5013] == "" and spans[5003] == "hex:0:32" and spans[5005] == "hex:1:33,hex:34:66"
    assert secrets.op6_secrets(no_docs).count() == 0


def test_secrets_right_after_a_text_that_ends_in_a_letter(spark):
    import pyarrow as pa

    end, noise = "plain words at the end", "q7Zp0XvR2mKfT9wLbN4sJ1hYcD8e"
    rows = [end, f"{HEX} is a hash", end, "AKIAABCDEFGHIJKL key", end, f"{noise} tail", "", "x", HEX, None, end]
    for texts in (rows, [x for x in rows if x != end], [None, "", noise]):
        for chunk in secrets.chunks(pa.array(texts, pa.string())):
            want = [k for k, x in enumerate(texts) if x and re.search("[A-Za-z0-9]{16}", x)]
            assert secrets._suspects(chunk, secrets._CODE[chunk.data]) == want
    rng = np.random.default_rng(3)
    keys = ["".join(rng.choice(list(secrets.ALPHABET[:62]), 32)) for _ in range(200)]
    train = [f"token={k} " + "the cat sat near some_identifier_names of a file " * 3 for k in keys]
    rows = list(enumerate(rows + train))
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = {r.doc_id: r for r in secrets.op6_secrets(df).collect()}
    assert [tuple(out[d])[:5] for d, _ in rows] == [(d, *brute_secrets(t)) for d, t in rows]
    assert [out[k].spans for k in (1, 3, 5, 8)] == ["hex:0:32", "access:0:16", "markov:0:28", "hex:0:32"]


def test_secret_models_count_no_pair_over_two_texts(spark, docs):
    texts = ["ab", "", "cd", None, "", "token=abcdefgh1", "2x", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = Counter(p for t in texts if t for p in zip(t, t[1:]))
    code = {c: i for i, c in enumerate(secrets.ALPHABET, 1)}
    for parts in (1, 8):
        random, ordinary = secrets.pair_counts(df.repartition(parts))
        got = (random + ordinary).reshape(secrets._N, secrets._N)
        assert got.sum() == sum(want.values())
        assert all(got[code[a], code[b]] == n for (a, b), n in want.items())
    one, many = (secrets.pair_counts(docs.repartition(n)) for n in (1, 7))
    assert (one[0] == many[0]).all() and (one[1] == many[1]).all()


ORDINARY = (
    "MAX_BUFFER_SIZE_DEFAULT_VALUE XMLHttpRequestUploadHTTP2Proxy getElementsByClassNameAndTag "
    "DEFAULT_CONNECTION_TIMEOUT_MS AbstractSingletonProxyFactoryBean order_20240315_0000123456 "
    "20240101123000000000001 AAAAAAAAAAAAAAAAAAAAAAAA 2024-01-01T00-00-00-000000 backup_20240315_123000_full_db "
    "test_user_can_login_with_valid_password com-example-project-module-service EXPERIMENTAL_FEATURE_FLAG_ENABLED"
).split()


def test_secret_models_on_samples_they_have_not_seen(spark):
    """Learned from the documents of one half of the ids; random strings and identifiers that none of them holds."""
    import random

    rng = random.Random(9)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id % 2 = 0")
    ratios = secrets.log_ratios(*secrets.pair_counts(docs))
    assert max(secrets.mean_ratio(x, ratios) for x in ORDINARY) < secrets.LEAST_RATIO
    drawn = ["".join(rng.choices(secrets.ALPHABET[:62], k=rng.randint(20, 48))) for _ in range(2000)]
    assert sum(secrets.mean_ratio(x, ratios) < secrets.LEAST_RATIO for x in drawn) < 100


def test_a_long_text_of_keys_takes_seconds():
    import time

    text = " ".join(f"{i:040x} q7Zp0XvR2mKfT9wLbN4sJ1hYcD8e{i}" for i in range(40_000))
    ratios = np.full((secrets._N, secrets._N), 1.0)
    start = time.perf_counter()
    base, spans = secrets.all_spans(text, ratios)
    assert len(base) == 40_000 and len(spans) == 80_000 and time.perf_counter() - start < 20


# toxicity


def test_toxicity_learns_words_of_labelled_rows(spark, no_docs):
    rng = random.Random(1)
    stems = "ab cd ef gh ij kl mn op qr st uv wx yz ou ei".split()
    word = lambda: "".join(rng.choices(stems, k=rng.randint(2, 4)))
    bad = ["Zorgak", "blimpok", "Krustyx", "vexnorp"]
    rows, labels = [], []
    for i in range(1500):
        w = [word() for _ in range(rng.randint(20, 80))]
        toxic = i % 10 == 0
        if toxic:
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((i, " ".join(w) if i else None))
        if i < 1300:
            labels.append((i, int(toxic)))
    rows += [(2000, ""), (None, "no id"), (2000, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    out = toxicity.op5_toxicity(docs, marks).collect()
    assert len(out) == len(rows)
    for r in out:
        text_id = "" if r.doc_id is None else str(r.doc_id)
        assert r.held_out == (zlib.crc32(text_id.encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    wrong = [r.doc_id for r in out if r.doc_id and r.doc_id < 1500 and r.predicted != (r.doc_id % 10 == 0)]
    assert len(wrong) <= 5, wrong
    assert toxicity.op5_toxicity(no_docs, marks).count() == 0
    assert {r.predicted for r in toxicity.op5_toxicity(docs, marks.limit(0)).collect()} == {0}


def test_toxicity_of_repeated_ids_does_not_hang_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 1100)
    rng = random.Random(9)
    stems = "ab cd ef gh ij kl mn op qr st uv wx yz ou ei".split()
    bad = ["Zorgak", "blimpok", "Krustyx", "vexnorp"]
    rows, toxic = [], []
    for i in range(400):
        for _ in range(4):  # four texts under one id: more rows than the sample takes
            w = ["".join(rng.choices(stems, k=rng.randint(2, 4))) for _ in range(30)]
            rows.append((i, " ".join(w + (rng.choices(bad, k=4) if i % 5 == 0 else []))))
        toxic.append((i, int(i % 5 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(toxic, "doc_id long, toxic int")
    runs = [
        sorted((r.doc_id, r.text, round(r.score, 9)) for r in toxicity.score_documents(docs.repartition(k), labels.repartition(k)).collect())
        for k in (1, 5)
    ]
    assert runs[0] == runs[1] and len(runs[0]) == len(rows)
    assert len({s for *_, s in runs[0]}) > 1


def test_label_model_weighs_correlated_voters_down():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.15
    fires = lambda p, q: rng.random(4000) < np.where(y, p, q)
    one = fires(0.5, 0.01)
    votes = np.column_stack([one, one, one, fires(0.5, 0.01), fires(0.5, 0.01)])
    post, model = toxicity.label_model(votes, 0.15)
    assert model["weight"][:3].max() < 0.6 < model["weight"][3]
    assert post[votes[:, 3] & votes[:, 4]].min() > 0.9 and post[~votes.any(axis=1)].max() < 0.1
    assert post.mean() == pytest.approx(0.15, abs=0.05)
