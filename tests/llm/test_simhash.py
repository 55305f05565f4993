"""SimHash components against all pairs."""

import numpy as np
import pytest
import xxhash
from fixtures import odd_docs

from tidemark.llm import components, simhash


def plain_print(text):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest index per component of the links among distinct values."""
    values = sorted(set(prints))
    group = {v: v for v in values}

    def root(v):
        while group[v] != v:
            v = group[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 3:
                group[root(a)] = root(b)
    return {v: root(v) for v in values}


def near_values(n, seed=1):
    random = np.random.default_rng(seed)
    base = random.integers(0, 1 << 63, n // 3, dtype=np.uint64)
    out = list(base)
    for flips in (1, 2, 3, 4, 5):
        for v in base[: n // 9]:
            for b in random.choice(64, flips, replace=False):
                v = v ^ np.uint64(1 << int(b))
            out.append(v)
    return np.unique(np.array(out, np.uint64))


@pytest.mark.parametrize("node_rows", [1 << 18, 5])
def test_links_connect_what_all_pairs_connect(spark, node_rows):
    values = near_values(600)
    dense = np.unique(values[0] ^ (np.arange(64, dtype=np.uint64) << np.uint64(20)))
    values = np.unique(np.r_[values, dense])
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp bigint")
    links = simhash.links(df, node_rows).collect()
    for a, b in links:
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= 64
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = plain_components([int(v) for v in values])
    groups = lambda of: sorted(sorted(k for k in of if of[k] == g) for g in set(of.values()))
    signed = {int(np.uint64(k).view(np.int64)): g for k, g in want.items()}
    mine = {int(v): got.get(int(v), int(v)) for v in values.view(np.int64)}
    assert groups(mine) == groups(signed)
    assert len(links) <= 4 * len(values) * (1 if node_rows > 5 else 64)


def test_fingerprints_of_odd_texts(spark):
    docs = odd_docs(spark)
    got = simhash.near_copies(docs).collect()
    have = sorted((str(r.doc_id), r.fingerprint) for r in got)
    rows = docs.select("doc_id", "text").collect()
    assert have == sorted((str(r.doc_id), f"{plain_print(r.text):016x}") for r in rows)
    groups = plain_components([plain_print(r.text) for r in rows])
    smallest = {}
    for r in rows:
        if r.doc_id is not None:
            g = groups[plain_print(r.text)]
            smallest[g] = min(smallest.get(g, r.doc_id), r.doc_id)
    want = sorted((str(r.doc_id), str(smallest.get(groups[plain_print(r.text)]))) for r in rows)
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == want


def test_one_of_each_component_stays(spark):
    docs = odd_docs(spark)
    kept = simhash.one_per_component(docs)
    assert kept.columns == docs.columns
    groups = {r.component_id for r in simhash.near_copies(docs).collect()}
    rows = kept.collect()
    assert len(rows) == len(groups)
    named = {r.doc_id for r in rows if r.doc_id is not None}
    assert named == {g for g in groups if g is not None}
    assert simhash.one_per_component(docs.limit(0)).count() == 0
    assert simhash.near_copies(docs.limit(0)).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 300)] + [(5, 5), (None, 3)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 300)}}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_columns_named_like_those_used_inside_stay(spark):
    data = [(i, "the same words in a line that is long enough for a copy", "a", "b", i) for i in (1, 2)]
    docs = spark.createDataFrame(data, ["doc_id", "text", "_kept_id", "_kept_tie", "_mark"])
    got = simhash.one_per_component(docs)
    assert got.columns == docs.columns
    assert {tuple(r)[2:4] for r in got.collect()} == {("a", "b")}
