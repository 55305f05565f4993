"""Repeated paragraphs against comparing all pairs."""

import random

import pytest
from fixtures import DATA, odd_docs, texts

from tidemark.llm import neardup, paragraphs, queries


def plain(rows):
    """Place of each paragraph with a partner, by component, as (key, text, start); short stretches left out."""
    end = {(d, t or "", a): (b, len(ws)) for d, t in rows for a, b, ws in paragraphs.paragraphs(t)}
    found = [((d, t or "", a), [w.decode() for w in ws]) for d, t in rows for a, _, ws in paragraphs.paragraphs(t)]
    found = list({p: ws for p, ws in found}.items())
    sets = [{tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} for _, ws in found]
    group = list(range(len(found)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(found)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                group[root(i)] = root(j)
    out = {}
    for i, (p, _) in enumerate(found):
        out.setdefault(root(i), set()).add(p)
    texts_ = {}
    for g in out.values():
        for p in g if len(g) > 1 else ():
            texts_.setdefault(p[:2], []).append(p)
    long = set()
    for places in texts_.values():
        stretch, far = [], None
        for p in [*sorted(places, key=lambda p: p[2]), None]:
            if p is None or (far is not None and p[2] - far > paragraphs.GAP):
                if sum(end[x][1] for x in stretch) >= paragraphs.MIN_STRETCH:
                    long |= set(stretch)
                stretch = []
            if p is not None:
                stretch.append(p)
                far = max(far or 0, end[p][0])
    out = {k: g & long for k, g in out.items()}
    return sorted(sorted(map(str, g)) for g in out.values() if len(g) > 1)


def check(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    got = paragraphs.repeated(docs).collect()
    by_tie = {(r.doc_id, r.tie): r.text for r in docs.selectExpr("doc_id", "xxhash64(text) AS tie", "text").collect()}
    groups = {}
    for r in got:
        groups.setdefault(r.component, []).append(r)
    have = sorted(sorted(str((r.doc_id, by_tie[r.doc_id, r.tie], r.start)) for r in g) for g in groups.values())
    assert have == plain(rows)
    for g in groups.values():
        kept = [r for r in g if r.kept]
        assert len(kept) == 1
        assert (kept[0].doc_id is None, kept[0].doc_id or 0) == min((r.doc_id is None, r.doc_id or 0) for r in g)
    return got


def sentence(n, seed):
    random.seed(seed)
    return " ".join(random.choice(["lo", "mi", "ra", "tu", "ve"]) * random.randint(1, 3) + str(random.randint(0, 99)) for _ in range(n)) + "."


def test_same_components_as_all_pairs(spark):
    long = [sentence(60, i) for i in range(12)]
    near = [t.replace(" ", " x ", 1) for t in long[:6]] + [" ".join(t.split()[3:]) for t in long[:3]]
    pasted = [f"{sentence(9, 100 + i)} {long[i % 3]} {sentence(9, 200 + i)}" for i in range(12)]
    chain = [" ".join(long[11].split()[i * 3 :]) for i in range(5)]
    every = long + near + pasted + chain + [None, "", "too short."] + texts(15)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(every)], "doc_id bigint, text string")
    assert check(spark, docs)


def test_odd_texts(spark):
    docs = odd_docs(spark).withColumnsRenamed({"node": "key", "label": "component"}).filter("length(text) < 60000 OR text IS NULL")
    check(spark, docs)
    assert paragraphs.repeated(docs.limit(0)).count() == 0


def test_many_near_copies_of_one_paragraph(spark):
    base = sentence(80, 7).split()
    random.seed(1)
    every = []
    for i in range(150):
        words = list(base)
        words[random.randrange(len(words))] = f"w{i}"
        every.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(every)), "doc_id bigint, text string")
    got = paragraphs.repeated(docs).collect()
    assert len(got) == 150 and len({r.component for r in got}) == 1 and sum(r.kept for r in got) == 1


def test_bands_reach_the_recall():
    bands = neardup.tuned(0.8, paragraphs.RECALL, paragraphs.ROWS)
    assert neardup.recall(0.8, bands, paragraphs.ROWS) >= paragraphs.RECALL > neardup.recall(0.8, bands - 1, paragraphs.ROWS)


@pytest.mark.parametrize("text", ["One. Two three!", "a\nb", "He said \"no.\" Then left.", "end", ""])
def test_paragraphs_cover_the_text(text, monkeypatch):
    monkeypatch.setattr(paragraphs, "MIN_WORDS", 1)
    found = list(paragraphs.paragraphs(text))
    assert [w for _, _, ws in found for w in ws] == text.lower().encode().split()


SHORT_LINES = {
    "verse": lambda seed: "\n".join(sentence(6, 1000 * seed + i)[:-1] for i in range(40)),
    "list": lambda seed: "\n".join("- " + sentence(2, 1000 * seed + i) for i in range(60)),
    "chinese": lambda seed: "。".join("".join(random.Random(1000 * seed + i).choices("天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏", k=12)) for i in range(30)),
}


@pytest.mark.parametrize("kind", SHORT_LINES)
def test_copies_of_texts_of_short_lines(spark, kind):
    """Whole copies share all units; of copies pasted behind other lines of the same block most words are found."""
    made = SHORT_LINES[kind]
    base, glue = [made(i) for i in range(4)], "。" if kind == "chinese" else "\n"
    pasted = glue.join([*made(7).split(glue)[:3], base[1], *made(8).split(glue)[:3]])
    docs = spark.createDataFrame(list(enumerate([*base, base[0], pasted])), "doc_id bigint, text string")
    got = check(spark, docs)
    found = {i: sum(r.words for r in got if r.doc_id == i) for i in range(6)}
    every = {i: len(paragraphs.words_of(t)) for i, t in enumerate([*base, base[0], pasted])}
    assert found[0] == found[4] >= 0.9 * every[0] and found[2] == found[3] == 0
    assert found[1] >= 0.7 * every[1] and found[5] >= 0.7 * every[1]


def test_an_empty_line_ends_a_paragraph():
    text = "one two three four\nfive six seven eight\n\nnine ten"
    assert [(a, b, len(w)) for a, b, w in paragraphs.paragraphs(text)] == [(0, 40, 8)]
    assert list(paragraphs.paragraphs("one two\n\nthree four five\n \nsix seven eight")) == []


def test_query(spark):
    got = queries.QUERIES["op2_repeated_paragraphs"](spark, DATA).collect()
    assert got and all(r.end > r.start for r in got)
