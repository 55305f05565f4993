"""Ranked search against scoring every document for every item."""

import math
import random
import re
from collections import Counter

from compare import differences, duck
from conftest import DATA
from fixtures import odd_docs, odd_texts

from tidemark.llm import queries, ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k):
    """(item, rank, key, score) for all items, ties by key, missing keys last."""
    held = [(key, Counter(words(t))) for key, t in docs if words(t)]
    n, length = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for key, c in held:
            m = 100 - 25 + (25 * c.total() * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
                    for t in words(text) if c[t])
            if s > 0:
                scored.append((-s, key is None, key or 0, key))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_odd_documents_and_items(spark):
    docs = odd_docs(spark)
    data = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(1, "two WORDS"), (2, None), (3, ""), (4, "... !"), (5, "nowherefound"), (6, odd_texts()[11] * 3), (7, "ÄÖ ÜÉ äö 漢字"),
             (8, "two words two"), (8, "one"), (9, "one"), (9, "one"), (None, "row without a key")]
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    distinct = list(dict.fromkeys(items))
    for width in (2, 64, ranked.WIDTH):
        for k in (1, 3, 20):
            table = ranked.ranked(docs, asked, k, width=width)
            assert table.columns == ["item_id", "rank", "doc_id", "score"]
            # Rows without a key or with a repeated one tie only with each other's equals.
            assert got(table) == plain(data, distinct, k)


def test_many_ties_and_several_passes(spark, monkeypatch):
    monkeypatch.setattr(ranked, "PASS_CHARS", 500)
    rng = random.Random(2)
    data = [(i, " ".join(rng.choices("a b c d e f g h".split(), k=rng.randint(0, 6)))) for i in range(400)]
    items = [(i, " ".join(rng.choices("a b c d z".split(), k=4))) for i in range(12)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").repartition(5)
    asked = spark.createDataFrame(items, "item_id bigint, text string").repartition(3)
    assert got(ranked.ranked(docs, asked, 7, width=4)) == plain(data, items, 7)


def test_other_column_names_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "x y", "z"), (2, "y", "z")], "score int, body string, query string")
    asked = spark.createDataFrame([("q", "y", 1)], "rank string, block string, part int")
    table = ranked.ranked(docs, asked, 5, "score", "body", "rank", "block")
    assert table.count() == 2
    assert ranked.ranked(docs.limit(0), asked, 5, "score", "body", "rank", "block").count() == 0
    assert ranked.ranked(docs, asked.limit(0), 5, "score", "body", "rank", "block").count() == 0


def test_bounds_hold_and_spare_most_scores():
    rng = random.Random(5)
    lists = [[f"w{min(int(rng.expovariate(0.01)), 900)}" for _ in range(rng.randint(1, 80))] for _ in range(3000)]
    asked = [Counter(rng.sample(lists[i], min(10, len(lists[i])))) for i in range(0, 3000, 100)]
    corpus = ranked.Corpus(len(lists), sum(map(len, lists)), Counter(t for ts in lists for t in set(ts)))
    search = ranked.Search(asked, corpus, 5, 1024)
    counts = [Counter(ts) for ts in lists]
    norms = [corpus.norm(len(ts)) for ts in lists]
    bounds = search.sketches.folded(counts, norms) @ search.weights * (1 + 1e-9)
    for d in range(0, 3000, 7):
        for q in range(len(asked)):
            assert bounds[d, q] >= search.score(q, counts[d], norms[d])
    for i in range(0, 3000, 256):
        search.add(list(range(i, i + 256)), lists[i : i + 256])
    assert search.rescored < len(lists) * len(asked) / 4


def test_query_matches_sql(spark):
    df = queries.QUERIES["op12_sketch_search"](spark, DATA)
    assert differences(df, duck(DATA), queries.CHECKS["op12_sketch_search"]) == []
