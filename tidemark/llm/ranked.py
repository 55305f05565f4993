"""Ranked lexical search by hashed max-sketches.

Every document is folded into a sketch: its terms are hashed to coordinates, and a coordinate keeps the largest impact of
the document's terms there. For a batch of documents one product of sketches and query weights bounds all scores from
above: a term's impact is at most that of its coordinate. Documents are then scored exactly in the order of falling bounds
until the bound is below the score of the last place, which only rises from batch to batch. A task so keeps, per query,
its best documents; these few are put in order over all tasks.

Texts are read twice: for the counts of terms that scores need, and for the search. They aren't shuffled.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import shipped, slices, stored

shipped(__name__)

#: Terms: ASCII letters and digits, and everything beyond ASCII.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Coordinates of a sketch, documents and characters in a batch, and remembered coordinates of terms in a Python worker.
WIDTH = 8192
BATCH = 256
BATCH_CHARS = 2_000_000
KEPT_TERMS = 500_000
#: Characters of query texts that go through the documents in one pass; a short text counts as ITEM_CHARS.
PASS_CHARS = 200_000
ITEM_CHARS = 200


def terms(text: str | None) -> list[str]:
    """The terms in order; only A-Z are lower-cased, as ``bytes.lower`` does."""
    return TERM.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")) if text else []


def impact(tf, norm):
    """How much ``tf`` occurrences count in a document of length norm ``norm``; grows with ``tf``."""
    return 1_000_000_000 * tf // (1000 * tf + 12 * norm)


@dataclass
class Corpus:
    """Documents with terms, all their terms, and documents by term for the terms of queries."""

    docs: int
    terms: int
    having: dict[str, int]

    def norm(self, length: int) -> int:
        return 75 + 25 * length * self.docs // self.terms

    def weight(self, term: str) -> int:
        return math.floor(1000 * math.log((2 * self.docs + 2) / (2 * self.having.get(term, 0) + 1)))


class Sketches:
    """Coordinates of terms, and sketches of batches of documents."""

    def __init__(self, width: int):
        self.width = width
        self.places: dict[str, int] = {}

    def place(self, term: str) -> int:
        at = self.places.get(term)
        if at is None:
            if len(self.places) >= KEPT_TERMS:
                self.places.clear()
            at = self.places[term] = crc32(term.encode("utf-8", "surrogatepass")) % self.width
        return at

    def folded(self, counts: list[Counter], norms: list[int]) -> np.ndarray:
        """A row per document: the largest impact at each coordinate."""
        sizes = [len(c) for c in counts]
        at = np.fromiter((self.place(t) for c in counts for t in c), np.int64, sum(sizes))
        tf = np.fromiter((n for c in counts for n in c.values()), np.int64, sum(sizes))
        doc = np.repeat(np.arange(len(counts)), sizes)
        out = np.zeros(len(counts) * self.width)
        np.maximum.at(out, doc * self.width + at, impact(tf, np.repeat(np.array(norms, np.int64), sizes)).astype(float))
        return out.reshape(len(counts), self.width)


class Search:
    """The best documents of one task for each query."""

    def __init__(self, queries: list[Counter], corpus: Corpus, k: int, width: int):
        self.corpus, self.k, self.sketches = corpus, k, Sketches(width)
        self.queries = [[(t, n * corpus.weight(t)) for t, n in q.items() if corpus.having.get(t)] for q in queries]
        self.weights = np.zeros((width, len(queries)))
        for i, q in enumerate(self.queries):
            for t, w in q:
                self.weights[self.sketches.place(t), i] += w
        self.best: list[list[tuple]] = [[] for _ in queries]
        self.rescored = 0

    def score(self, query: int, counts: Counter, norm: int) -> int:
        get = counts.get
        return sum(w * impact(tf, norm) for t, w in self.queries[query] if (tf := get(t)))

    def add(self, keys: list[int | None], lists: list[list[str]]) -> None:
        """Take a batch of documents given by their keys and terms."""
        known = [(key, ts) for key, ts in zip(keys, lists) if ts]
        if not known:
            return
        counts = [Counter(ts) for _, ts in known]
        norms = [self.corpus.norm(len(ts)) for _, ts in known]
        # A little more than the product, so that rounding of large sums never puts a bound below a score.
        bounds = self.sketches.folded(counts, norms) @ self.weights * (1 + 1e-9)
        floors = np.array([b[0][0] if len(b) == self.k else 1 for b in self.best], float)
        for i in np.flatnonzero((bounds >= floors).any(axis=0)):
            column, best = bounds[:, i], self.best[i]
            near = np.flatnonzero(column >= floors[i])
            for d in near[np.argsort(-column[near], kind="stable")]:
                if len(best) == self.k and column[d] < best[0][0]:
                    break
                score = self.score(i, counts[d], norms[d])
                self.rescored += 1
                if score <= 0:
                    continue
                key = known[d][0]
                # Of equal scores the lower key is better, no key worst.
                entry = (score, -math.inf if key is None else -key, self.rescored, key)
                if len(best) < self.k:
                    heapq.heappush(best, entry)
                elif entry[:2] > best[0][:2]:
                    heapq.heapreplace(best, entry)


def counted(docs: DataFrame, text: str, wanted: set[str]) -> Corpus:
    """Counts over all documents; ``wanted`` are the terms to count documents of."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = total = 0
        having: Counter = Counter()
        for part in slices(batches):
            for t in part.column(0).to_pylist():
                found = terms(t)
                n += bool(found)
                total += len(found)
                having.update(sent.value.intersection(found))
        rows = [(None, n, total), *((t, c, 0) for t, c in having.items())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64()))],
                                         names=["term", "n", "total"])

    parts = docs.select(text).mapInArrow(count, "term STRING, n BIGINT, total BIGINT")
    sums = {r.term: r for r in parts.groupBy("term").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()}
    whole = sums.pop(None, None)
    return Corpus(whole.n if whole else 0, whole.total if whole else 0, {t: r.n for t, r in sums.items()})


def best_documents(docs: DataFrame, texts: list[tuple], k: int, key: str, text: str, width: int) -> DataFrame:
    """The best documents of each task for numbered query texts: ``query``, ``key``, ``score``."""
    queries = [(number, Counter(terms(t))) for number, t in texts]
    wanted = set().union(*(q for _, q in queries)) if queries else set()
    corpus = counted(docs, text, wanted)
    sent = docs.sparkSession.sparkContext.broadcast((queries, corpus))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, world = sent.value
        if not world.terms:
            return
        found = Search([q for _, q in mine], world, k, width)
        for part in slices(batches, BATCH):
            keys, values = part.column(0).to_pylist(), part.column(1).to_pylist()
            group = np.cumsum([len(t or "") for t in values]) // BATCH_CHARS
            for g in np.unique(group):
                at = np.flatnonzero(group == g)
                found.add([keys[i] for i in at], [terms(values[i]) for i in at])
        for (number, _), best in zip(mine, found.best):
            if best:
                scores, _, _, keys = zip(*best)
                columns = [pa.array([number] * len(best), pa.int64()), pa.array(keys, pa.int64()), pa.array(scores, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["query", "key", "score"])

    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(search, "query BIGINT, key BIGINT, score BIGINT")


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", text: str = "text", item: str = "item_id",
           query: str = "text", width: int = WIDTH) -> DataFrame:
    """The ``k`` highest-scoring documents of each item, with rank (from 1) and score; equal scores by ascending key.

    ``key`` is a whole number. Documents without a key come last among equal scores, repeated keys are documents of their
    own; a null text has no terms and is no document. Items without terms, or without any document above 0, give no
    rows; equal items (number and text) count once, items of one number with several texts are ranked each. Other columns
    of both tables are not read. Items are numbered in a written table and go through the documents in passes of
    ``PASS_CHARS`` characters of query text.
    """
    number = "query"
    asked = items.select(F.col(item).alias("item"), F.col(query).alias("text")).filter("text IS NOT NULL").distinct()
    order = Window.orderBy("start", "part")
    size = F.greatest(F.length("text"), F.lit(ITEM_CHARS))
    rows = asked.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    rows = stored(rows)
    # Blocks of about PASS_CHARS by the sums of smaller blocks: only one row per task is put in order.
    per = rows.groupBy("part").agg(F.sum(size).alias("size"), F.min("at").alias("start"))
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.sum(size).over(Window.partitionBy("part").orderBy("at"))
    blocks = rows.join(per.withColumn("before", before).select("part", "before"), "part")
    rows = stored(blocks.select("item", "text", F.col("at").alias(number), F.floor((F.col("before") + inside) / PASS_CHARS).alias("block")))
    found = None
    for block in sorted(r.block for r in rows.select("block").distinct().collect()):
        texts = [(r[number], r.text) for r in rows.filter(F.col("block") == block).select(number, "text").collect()]
        part = best_documents(docs, texts, k, key, text, width)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "query BIGINT, key BIGINT, score BIGINT")
    place = Window.partitionBy(number).orderBy(F.desc("score"), F.asc_nulls_last("key"))
    best = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    named = best.join(rows.select("item", number), number)
    return named.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")
