"""Benchmark passages against plain approximate search, and planted ones."""

import random

import numpy as np
import pytest
from fixtures import DATA, odd_docs, rows, texts

from tidemark.llm import decontaminate as dc

ITEMS = [t for (t,) in rows(f"SELECT text FROM '{DATA}/benchmark.parquet' ORDER BY item_id LIMIT 12")]


def plain_best(item, text):
    """Fewest edits that make the item a passage of the text."""
    last = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        row = [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j - 1] + (a != b), last[j] + 1, row[j - 1] + 1))
        last = row
    return min(last)


def edited(text, edits, seed):
    random.seed(seed)
    out = list(text)
    for _ in range(edits):
        at = random.randrange(len(out))
        kind = random.randrange(3)
        if kind == 0:
            out[at] = "~"
        elif kind == 1:
            out.insert(at, "~")
        else:
            del out[at]
    return "".join(out)


def plain(text):
    return "".join(map(chr, dc.characters(text)))


@pytest.mark.parametrize("edits", [0, 1, 5, 12, 20, 30])
def test_same_passages_as_plain_search(edits):
    block = dc.block_of(list(enumerate(ITEMS)), dc.Q, dc.EDIT_RATE)
    around = texts(8)
    for n, item in enumerate(ITEMS[:6]):
        text = around[n % 8][:150] + " " + edited(item, edits, n) + around[(n + 1) % 8][:150]
        best = plain_best(plain(item), plain(text))
        hits = [h for h in dc.matches(text, block) if h[0] == n]
        if best <= dc.budget(len(item), dc.Q, dc.EDIT_RATE):
            assert len(hits) == 1 and hits[0][3] == best
            start, end = hits[0][1:3]
            assert plain_best(plain(item), plain(text[start:end])) == best
        else:
            assert not hits


def test_alignment_on_random_short_strings():
    random.seed(4)
    for _ in range(200):
        item = "".join(random.choices("ab", k=random.randint(1, 12)))
        text = "".join(random.choices("abc", k=random.randint(1, 25)))
        want = plain_best(item, text)
        width = len(item) + len(text) + 2
        got = dc.aligned(dc.characters(item), dc.characters(text), -len(item), width, 50)
        assert got[0] == want
        assert plain_best(item, text[got[1] : got[2]]) == want


def table(spark):
    items = [(i, t, "extra", 1) for i, t in enumerate(ITEMS)] + [(100, None, "", 1), (101, "", "", 1), (102, "short", "", 1), (0, ITEMS[0], "", 2)]
    return spark.createDataFrame(items, "item_id bigint, text string, lang string, doc_id int")


@pytest.mark.parametrize("block_chars", [4_000_000, 500])
def test_planted_passages_are_found_and_others_left(spark, block_chars):
    odd = odd_docs(spark)
    planted = [(1000 + i, f"Before it. {edited(t, i % 8, i)} And after.", *[None] * 6) for i, t in enumerate(ITEMS)]
    twice = [(2000, f"{ITEMS[1]} and {ITEMS[2]} and {ITEMS[1].upper()}", *[None] * 6)] * 2
    docs = odd.union(spark.createDataFrame(planted + twice, odd.schema))
    block = dc.block_of(list(enumerate(ITEMS)), dc.Q, dc.EDIT_RATE)
    dirty = [r.text for r in odd.collect() if dc.matches(r.text, block)]
    got = dc.contaminated(docs, table(spark), block_chars=block_chars).collect()
    have = sorted((r.doc_id, r.item_id) for r in got if r.doc_id and r.doc_id >= 1000)
    assert have == sorted([(1000 + i, i) for i in range(len(ITEMS))] + [(2000, 1), (2000, 2), (2000, 1)] * 2)
    kept = dc.clean(docs, table(spark), block_chars=block_chars)
    assert kept.columns == docs.columns
    assert kept.count() == odd.count() - len(dirty)


def test_empty_tables(spark):
    docs = odd_docs(spark)
    assert dc.contaminated(docs.limit(0), table(spark)).count() == 0
    assert dc.contaminated(docs, table(spark).limit(0)).count() == 0
    assert dc.clean(docs, table(spark).limit(0)).count() == docs.count()


def test_grams_do_not_depend_on_where_a_piece_is_cut(monkeypatch):
    block = dc.block_of(list(enumerate(ITEMS)), dc.Q, dc.EDIT_RATE)
    codes = dc.characters(" x ".join(ITEMS))
    whole = [np.sort(a) for a in dc.shared(codes, block, dc.Q)]
    monkeypatch.setattr(dc, "PIECE", 100)
    assert all((a == np.sort(b)).all() for a, b in zip(whole, dc.shared(codes, block, dc.Q)))
