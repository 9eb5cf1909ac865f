"""Ranked lexical search with the Best Position Algorithm over impact lists.

Documents lie in shards of bounded size within Spark's partitions. A shard has one list per
query term: its documents by falling impact of the term. A search reads the lists side by
side. Each document met is scored at once by direct accesses to its places in the other
lists, which mark those places as seen too. A list's best position is the last one up to
which every place has been seen, by either kind of access; no document unseen so far can
score more than the impacts at the best positions add up to. The search of a shard stops once this
bound is strictly below the tenth score, so a document that ties with it is never missed.
A task hands the scores that it has found on to its next shard; tasks send ten rows an item.

Term statistics are counted over all documents in a first pass. Items are searched in blocks,
each of which is held whole by every task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from faturaflow.llm.bitplanes import frugal
from faturaflow.llm.textops import chunks

TOP = 10
#: Items searched together: the size of what is broadcast.
ITEMS = 1000
#: Postings of query terms in a shard, and places read from every list in the first round of a search.
SHARD, STEP = 1 << 20, 32

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM = re.compile(TERM)
_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Bytes of terms (all of those of other alphabets), and the bytes with A-Z lower-cased.
_LETTERS = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_LOWER = np.array([_UPPER.get(b, b) for b in range(256)], np.uint8)


def terms(text: str | None) -> list[str]:
    """Maximal stretches of ASCII letters, digits and all other characters beyond ASCII; only A-Z lower-cased."""
    return [t.translate(_UPPER) for t in _TERM.findall(text or "")]


def _lowered(texts: pa.Array):
    for chunk in chunks(texts, _LETTERS):
        chunk.data = _LOWER[chunk.data]
        yield chunk


class Queries:
    """Items as slots of distinct terms; terms are known by the 64-bit hashes of their bytes."""

    def __init__(self, texts: list[str | None]):
        found = [sorted(set(terms(t))) for t in texts]
        names = sorted({t for ts in found for t in ts})
        hashes = np.zeros(0, np.uint64)
        if names:
            hashes = np.concatenate([c.word_hashes() for c in _lowered(pa.array(names, pa.string()))])
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        number = {names[j]: i for i, j in enumerate(order.tolist())}
        self.items = [np.array([number[t] for t in ts], np.int64) for ts in found]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Term number of each hash, -1 for words that no item asks for."""
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        return np.where(self.hashes[at] == hashes, at, -1) if len(self.hashes) else np.full(len(hashes), -1)


def _counted(chunk, queries: Queries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, tf) of the query terms in a chunk's rows, sorted by row and term."""
    number = queries.numbers(chunk.word_hashes())
    row = np.repeat(np.arange(len(chunk.first_word) - 1), np.diff(chunk.first_word))
    asked = number >= 0
    width = max(1, len(queries.hashes))
    key, tf = np.unique(row[asked] * width + number[asked], return_counts=True)
    return key // width, key % width, tf


def _statistics(docs: DataFrame, queries: Queries) -> tuple[int, int, np.ndarray]:
    """N, L and the document frequency of every query term: one row per task and term is shuffled."""
    sent = docs.sparkSession.sparkContext.broadcast(queries)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        df, n, length = np.zeros(len(own.hashes), np.int64), 0, 0
        for batch in batches:
            for chunk in _lowered(batch.column(0)):
                n += int((np.diff(chunk.first_word) > 0).sum())
                length += len(chunk.starts)
                df += np.bincount(_counted(chunk, own)[1], minlength=len(df))
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-2, -1], held])), pa.array(np.concatenate([[n, length], df[held]]))],
            ["term", "n"],
        )

    rows = docs.select("text").mapInArrow(frugal(count), "term long, n long")
    df, total = np.zeros(len(queries.hashes), np.int64), {-2: 0, -1: 0}
    for term, n in rows.groupBy("term").agg(F.sum("n")).collect():
        if term < 0:
            total[term] = n
        else:
            df[term] = n
    return total[-2], total[-1], df


class Shard:
    """Impact lists of some documents, and the same postings by document."""

    def __init__(self, docs: int, row: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        """Postings come sorted by row; impacts are above 0."""
        self.docs, self.term, self.impact = docs, term, impact
        self.of_doc = np.searchsorted(row, np.arange(docs + 1))
        listed = np.lexsort((row, -impact, term))
        self.doc_at, self.impact_at = row[listed], impact[listed]
        self.lists = np.searchsorted(term[listed], np.arange(n_terms + 1))
        self.place = np.empty(len(row), np.int64)
        self.place[listed] = np.arange(len(row))
        self.met = np.zeros(docs, bool)
        self.seen = np.zeros(len(row), bool)
        self.asked = np.zeros(n_terms, bool)

    def search(self, item: np.ndarray, floor_score: int, top: int = TOP) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, places read in order): every document that may be among the `top` best of this
        shard and scores at least `floor_score`, the `top`-th score found elsewhere (0: none)."""
        begin, end = self.lists[item], self.lists[item + 1]
        item, begin, end = item[end > begin], begin[end > begin], end[end > begin]
        best, at, step = begin.copy(), begin.copy(), STEP
        docs, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        kth, touched = floor_score, []
        self.asked[item] = True
        while (at < end).any():
            stop = np.minimum(at + step, end)
            read = _spread(at, stop - at)
            new = np.unique(self.doc_at[read])
            new = new[~self.met[new]]
            self.met[new] = True
            # Direct accesses: every posting of a new document under the item's terms.
            first, size = self.of_doc[new], self.of_doc[new + 1] - self.of_doc[new]
            own, owner = _spread(first, size), np.repeat(np.arange(len(new)), size)
            wanted = self.asked[self.term[own]]
            own, owner = own[wanted], owner[wanted]
            score = np.zeros(len(new), np.int64)
            np.add.at(score, owner, self.impact[own])
            self.seen[self.place[own]] = True
            touched.append(self.place[own])
            docs.append(new)
            scores.append(score)
            at = stop
            found = np.concatenate(scores)
            if len(found) >= top:
                kth = max(kth, int(np.partition(found, len(found) - top)[len(found) - top]))
            for i in range(len(item)):
                unseen = np.flatnonzero(~self.seen[best[i] : end[i]][: 4 * step])
                best[i] += unseen[0] if len(unseen) else min(4 * step, end[i] - best[i])
            # Impact at the best position; a list seen whole holds no unseen document.
            bound = np.where(best >= end, 0, self.impact_at[np.maximum(best - 1, begin)]).sum()
            if bound < kth:
                break
            step *= 2
        self.asked[item] = False
        for places in touched:
            self.seen[places] = False
        docs, scores = np.concatenate(docs), np.concatenate(scores)
        self.met[docs] = False
        kept = scores >= max(kth, 1)
        return docs[kept], scores[kept], int((at - begin).sum())


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for `size` numbers each."""
    total = int(size.sum())
    before = np.cumsum(size) - size
    return np.arange(total) + np.repeat(first - before, size)


class _Search:
    """The best of all items over the shards of one task."""

    def __init__(self, queries: Queries, weight: np.ndarray, n_docs: int, length: int, top: int):
        self.queries, self.weight, self.n_docs, self.length, self.top = queries, weight, n_docs, length, top

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64),) * 3 for _ in self.queries.items]
        parts, ids, rows, held = [], [], 0, 0
        for batch in batches:
            id_of = batch.column(0)
            for chunk in _lowered(batch.column(1)):
                row, term, tf = _counted(chunk, self.queries)
                n = np.diff(chunk.first_word)
                m = 10 + (90 * n * self.n_docs) // max(1, self.length)
                impact = self.weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
                some = impact > 0
                parts.append((row[some] + rows, term[some], impact[some]))
                ids.append(id_of.slice(chunk.first, len(n)))
                rows, held = rows + len(n), held + int(some.sum())
                if held >= SHARD:
                    self.shard(parts, ids, rows, best)
                    parts, ids, rows, held = [], [], 0, 0
        if rows:
            self.shard(parts, ids, rows, best)
        out = [(np.full(len(s), k), s, i, missing) for k, (s, i, missing) in enumerate(best) if len(s)]
        if out:
            item, score, doc_id, missing = (np.concatenate(c) for c in zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(item), pa.array(doc_id, mask=missing.astype(bool)), pa.array(score)],
                ["item", "doc_id", "score"],
            )

    def shard(self, parts: list, ids: list, rows: int, best: list) -> None:
        id_of = pa.concat_arrays(ids)
        missing = np.asarray(id_of.is_null())
        id_of = id_of.fill_null(0).to_numpy(zero_copy_only=False)
        shard = Shard(rows, *(np.concatenate(c) for c in zip(*parts)), len(self.weight))
        for k, item in enumerate(self.queries.items):
            scores, docs, none = best[k]
            floor_score = int(scores[-1]) if len(scores) == self.top else 0
            new, score, _ = shard.search(item, floor_score, self.top)
            if not len(new):
                continue
            scores = np.concatenate([scores, score])
            docs = np.concatenate([docs, id_of[new]])
            none = np.concatenate([none, missing[new]])
            order = np.lexsort((docs, none, -scores))[: self.top]
            best[k] = scores[order], docs[order], none[order]


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` highest-scoring documents of each item.

    `docs` has doc_id and text, `items` item_id and text. Scores are those of op12's contract, above 0;
    equal ones come by doc_id, null ids last. Every row is a document of its own,
    repeated rows too. Null and empty texts have no terms: such documents are never found and not counted, such
    items find nothing. No documents or no items: no rows. Rows of `items` with one item_id are
    searched apart and ranked together. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    item_type = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {item_type}, doc_id long, score long")
    # One partition of the items is in the driver at a time, and a block of them in every task.
    asked = items.select("item_id", "text").toLocalIterator()
    while rows := list(islice(asked, ITEMS)):
        out = out.unionByName(_search_block(docs, rows, item_type, top))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    ranked = out.withColumn("rank", F.row_number().over(W.partitionBy("item_id").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def _search_block(docs: DataFrame, rows: list, item_type: str, top: int) -> DataFrame:
    spark = docs.sparkSession
    queries = Queries([r["text"] for r in rows])
    n_docs, length, df = _statistics(docs, queries)
    weight = np.array([floor(1000 * log((2 * n_docs + 2) / (2 * f + 1))) for f in df.tolist()], np.int64)
    sent = spark.sparkContext.broadcast(_Search(queries, weight, n_docs, length, top))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return sent.value.run(batches)

    found = docs.mapInArrow(frugal(run), "item long, doc_id long, score long")
    names = spark.createDataFrame([(k, r["item_id"]) for k, r in enumerate(rows)], f"item long, item_id {item_type}")
    return found.join(F.broadcast(names), "item").select("item_id", "doc_id", "score")


def op12_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked_search(docs, items)


_LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = f"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER_SQL}, '{TERM}')) AS term FROM documents
), tfs AS (
    SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL
), lengths AS (
    SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY doc_id
), totals AS (
    SELECT count(*) AS total, sum(n)::BIGINT AS length FROM lengths
), dfs AS (
    SELECT term, count(*) AS df FROM tfs GROUP BY term
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER_SQL}, '{TERM}')) AS term FROM benchmark
), scores AS (
    SELECT item_id, doc_id,
           sum(floor(1000 * ln((2 * total + 2)::DOUBLE / (2 * df + 1)))::BIGINT
               * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * total) // length))))::BIGINT AS score
    FROM asked JOIN tfs USING (term) JOIN dfs USING (term) JOIN lengths USING (doc_id), totals
    GROUP BY item_id, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
) WHERE rank <= 10
"""
