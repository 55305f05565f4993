"""Candidates against a plain search, features of single ones, and accuracy on findings held out."""

import random

import pytest
import regex
from fixtures import DATA, odd_docs, texts
from pyspark.sql import functions as F

from tidemark.llm import queries, secrets

SCHEMA = "doc_id bigint, text string"


def key(seed, n=40, letters="0123456789abcdef"):
    return "".join(random.Random(seed).choices(letters, k=n - 1)) + "7"


def planted():
    """Texts with a secret or a look-alike, and which it is."""
    around = [t[:300] for t in texts(30)]
    out = []
    for i in range(120):
        before, after = around[i % 30], around[(i * 7 + 1) % 30]
        kind = i % 4
        thing = [
            f'token = "{key(i)}"', f"password={key(i, 18)}", f"AKIA{key(i, 16, 'ABCDEFGHIJKLMNOP0123456789')}", f"the{key(i, 24, 'abcXYZ01234_-')} key",
        ][kind]
        out.append((f"{before} {thing} {after}", True))
        word = max(regex.findall("[a-z]{7,}", before) or ["wherefore"], key=len)
        sham = [f"{key(i, 16, '0123456789')}", f"{word}{word}{i % 9}1", f"http://x.org/{word}/{word}-{word}-12", f"example {word}_{word}_{i}3"][kind]
        out.append((f"{before} {sham} {after}", False))
    return out


def test_findings_equal_a_plain_search(spark):
    docs = odd_docs(spark).union(spark.createDataFrame([(500, f'a "{key(1)}" b {key(2)}/{key(3)} c={key(2)}==', *[None] * 6), (501, key(4), *[None] * 6)], odd_docs(spark).schema))
    want = sorted((str(r.doc_id), m.start(), m.group()) for r in docs.select("doc_id", "text").collect() for m in regex.finditer(secrets.CANDIDATE, r.text or ""))
    got = secrets.findings(docs).collect()
    assert sorted((str(r.id), r.start, r.candidate) for r in got) == want
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        if r.id in (500, 501):
            assert text[r.id][: r.start].endswith(r.before) and text[r.id][r.start + len(r.candidate) :].startswith(r.after)


def test_forest_on_findings_held_out(spark):
    cases = planted()
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], SCHEMA)
    rows = secrets.described(secrets.findings(docs), secrets.dictionary(docs))
    truth = F.col("id") % 2 == 0
    teach = F.col("id") % 6 < 4
    judged = secrets.judged(rows, teach & truth, teach & ~truth).filter(~teach)
    right = judged.select(F.avg((F.col("is_secret") == truth).cast("double")), F.count("*")).first()
    assert right[1] > 60 and right[0] > 0.9


def test_same_forest_each_time_and_no_python(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(planted())], SCHEMA)
    once = sorted(map(tuple, secrets.scanned(docs.repartition(3)).collect()))
    df = secrets.scanned(docs.repartition(7))
    assert once == sorted(map(tuple, df.collect())) and once
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, f"plain words {key(9)} here"), (2, None), (2, "")], SCHEMA)
    got = secrets.scanned(docs).collect()
    assert [(r.doc_id, r.is_secret, r.labelled) for r in got] == [(1, True, None)]
    assert secrets.scanned(docs.limit(0)).count() == 0
    assert secrets.scanned(odd_docs(spark)).count() >= 0


@pytest.mark.parametrize(("before", "after", "feature"), [("x api_key: ", "", "key_word"), ("a='", "'", "quoted"), ("http://a/", "/b", "in_path"), ("this is an example ", "", "sham_word"), ("k = ", "", "assigned")])
def test_features(spark, before, after, feature):
    docs = spark.createDataFrame([(1, before + key(3) + after)], SCHEMA)
    (row,) = secrets.described(secrets.findings(docs), secrets.dictionary(docs)).collect()
    assert row[feature] == 1 and row.n_chars == len(row.candidate) and row.digit_share > 0.3


def test_sham_words_are_whole_and_at_the_value(spark):
    real = ['the latest contest: token = "%s"', 'me@example.com token = "%s" a protest', 'test it with token = "%s" for example']
    sham = ['token = "your-api-key-%s"', 'token = "test_%s"', "an example %s"]
    docs = spark.createDataFrame([(i, t % key(i)) for i, t in enumerate(real + sham)], SCHEMA)
    rows = secrets.described(secrets.findings(docs), secrets.dictionary(docs))
    got = {r.id: (r.sham_word, r.sure) for r in rows.select("id", "sham_word", secrets.sure_secret().alias("sure")).collect()}
    assert got == {i: (0.0, True) if i < 3 else (1.0, False) for i in range(6)}


def test_assigned_values_of_any_length_and_letters(spark):
    cases = {
        "password=hunter2": "hunter2", 'secret = "correct horse; battery"': "correct horse; battery", "pwd: 'p@$$w0rd!'": "p@$$w0rd!",
        "PASSWORD=abcdefgh": "abcdefgh", "db_passwd=x": "x", "?token=a.b!c&user=1": "a.b!c", "api_key: `Zürich#1`": "Zürich#1",
    }
    docs = spark.createDataFrame(list(enumerate(cases)), SCHEMA)
    rows = secrets.described(secrets.findings(docs), secrets.dictionary(docs)).select("id", "start", "candidate", secrets.sure_secret().alias("sure"))
    got = {r.id: (r.start, r.candidate, r.sure) for r in rows.collect()}
    assert got == {i: (text.index(value), value, True) for i, (text, value) in enumerate(cases.items())}


def test_query(spark):
    got = queries.QUERIES["op6_secret_findings"](spark, DATA)
    assert got.columns == ["doc_id", "start", "end", "probability", "is_secret", "labelled"]
    got.collect()
