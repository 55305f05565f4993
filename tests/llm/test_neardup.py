"""Candidates of crowded buckets: few texts are compared, and texts are cut once."""

import random


from tidemark.llm import lines, neardup, paragraphs


def variants(number, edits):
    """Texts of 40 words, each with some words of its own choice from a small list in the same places."""
    random.seed(5)
    words = [f"word{i}" for i in range(40)]
    return [" ".join(f"other{random.randrange(4)}" if i % (40 // edits) == 3 else w for i, w in enumerate(words)) for _ in range(number)]


def brute(texts):
    """Components by comparing all pairs."""
    units = sorted(set(texts))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (u.split() for u in units)]
    group = list(range(len(units)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    pairs = 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= 0.8 * len(a | b):
                pairs += 1
                group[root(i)] = root(j)
    return units, [root(i) for i in range(len(units))], pairs


def test_few_texts_of_a_crowded_bucket_are_compared(spark, monkeypatch):
    units, roots, similar = brute(variants(300, 4))
    compared = []
    plain = neardup._similar

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(neardup, "_similar", counted)
    rows = [(b, h, h % 1000, 36) for h in range(len(units)) for b in range(3)]
    rows = spark.createDataFrame(rows, "key bigint, h1 bigint, h2 int, size int")
    texts = spark.createDataFrame([(h, h % 1000, bytearray(u.encode())) for h, u in enumerate(units)], "h1 bigint, h2 int, unit binary")
    units_of = lambda named: texts.join(named, ["h1", "h2"]).select("node", "unit")
    found = {r.h1: r.component for r in neardup.linked(rows, units_of, paragraphs.shingles, 0.8).collect()}
    want = {}
    for h, root in enumerate(roots):
        want.setdefault(root, set()).add(h)
    got = {}
    for h, component in found.items():
        got.setdefault(component, set()).add(h)
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)
    assert sum(compared) <= similar + 4 * len(units)


def test_texts_are_cut_once_and_their_units_looked_up_once(spark, monkeypatch):
    calls = []
    plain = paragraphs.lines_of
    monkeypatch.setattr(paragraphs, "lines_of", lambda *a: calls.append(1) or plain(*a))
    rows = [(i, t) for i, t in enumerate(variants(12, 1) + variants(12, 4))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert paragraphs.repeated(docs).count() > 0
    assert len(calls) == 1


def test_few_long_texts_of_a_bucket_are_compared(spark, monkeypatch):
    """Texts of 1500 windows that share less than half of them, and three near copies of the first."""
    random.seed(6)
    letters = lambda n: "".join(random.choices("abcdefghij klmnop", k=n))
    shared = letters(900)
    units = [shared + letters(600) for _ in range(30)]
    units += [units[0][:at] + "#" + units[0][at + 1 :] for at in (100, 500, 1200)]
    compared = []
    plain = neardup._similar

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(neardup, "_similar", counted)
    rows = [(b, h, h % 1000, 1) for h in range(len(units)) for b in range(2)]
    rows = spark.createDataFrame(rows, "key bigint, h1 bigint, h2 int, size int")
    texts = spark.createDataFrame([(h, h % 1000, bytearray(u.encode())) for h, u in enumerate(units)], "h1 bigint, h2 int, unit binary")
    units_of = lambda named: texts.join(named, ["h1", "h2"]).select("node", "unit")
    found = neardup.linked(rows, units_of, lines.shingles, 0.8, once=True).collect()
    assert {r.h1 for r in found} == {0, 30, 31, 32} and len({r.component for r in found}) == 1
    assert sum(compared) <= 6
