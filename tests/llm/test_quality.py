"""Quality figures against a plain version, and single lines."""

import re

import pytest
from compare import differences, duck
from conftest import DATA
from fixtures import odd_docs

from tidemark.llm import quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {w for w in windows if windows.count(w) > 1}
    covered = {i + j for i, w in enumerate(windows) if w in repeated for j in range(3)}
    lines, seen, dups = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def test_figures_equal_plain_ones(spark):
    docs = odd_docs(spark).filter("length(text) < 60000 OR text IS NULL")
    docs = docs.union(spark.createDataFrame([(900, "a b c a b c\nx\n x\nx\n\n\nd # e | f", *[None] * 6)], docs.schema))
    for row in quality.judged(docs).collect():
        got = row.quality
        assert tuple(got)[:6] == plain(row.text)
        assert got.kept == (not got.base_failed and got.n_failed_words <= 0.5 * got.n_words)


@pytest.mark.parametrize(
    ("line", "rule"),
    [
        ("", None), ("  \t", None), ("A full sentence ends here.", None), ("He said \"yes!\"", None),
        ("Home | News | Sport | Contact", "navigation"), ("Home > News > Sport", "navigation"), ("A | b.", "navigation"),
        ("We use cookies to make this site better.", "boilerplate"), ("© 2020 All Rights Reserved.", "boilerplate"),
        ("READ!! THIS!! NOW!! OR!! NEVER!! AGAIN.", "marks"), ("Short heading", "punctuation"),
        ("a line that was cut off in the middle of a long", None), ("One mark!! in a longer sentence is fine.", None),
    ],
)
def test_line_rules(line, rule):
    assert quality.line_rule(line) == rule


def test_cleaned_text_and_columns(spark):
    good = " ".join(f"word{i}" for i in range(60)) + "."
    rows = [(1, f"Home | News\n{good}\n\nEnd.", "en", None, 5, None, 1, None), (2, "Menu\n" * 70, "en", None, 5, None, 1, None),
            (3, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, odd_docs(spark).schema)
    kept = quality.cleaned(docs)
    assert kept.columns == docs.columns
    assert [(r.doc_id, r.text, r.n_chars) for r in kept.collect()] == [(1, f"{good}\n\nEnd.", len(good) + 6)]
    assert quality.cleaned(docs.limit(0)).count() == 0


def test_each_text_is_judged_once_and_clashing_columns_stay(spark):
    good = " ".join(f"word{i}" for i in range(60)) + "."
    docs = spark.createDataFrame([(good, "q", 1), (good + "\nMenu", None, None)], "text string, _quality string, quality int")
    kept = quality.cleaned(docs)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(good, "q", 1), (good, None, None)], key=str)


def test_query_matches_sql(spark):
    df = queries.QUERIES["op5_line_first_quality"](spark, DATA)
    assert differences(df, duck(DATA), queries.CHECKS["op5_line_first_quality"]) == []
