"""Small tables with the odd cases every operator must take: nulls, empty and long texts, ties, repeats, other columns."""

from __future__ import annotations

import duckdb

DATA = "/root/testdata/sf0.001"
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, _tie int, label string"


def rows(sql: str) -> list[tuple]:
    return duckdb.connect().execute(sql).fetchall()


def texts(limit: int = 40) -> list[str]:
    return [t for (t,) in rows(f"SELECT text FROM '{DATA}/documents.parquet' ORDER BY doc_id LIMIT {limit}")]


def odd_texts() -> list[str | None]:
    long_word = "x" * 30_000
    some = texts(6)
    return [
        None, "", " \n\t ", "one", "Two Words", "Two Words", "a\x0bb\x0cc\rd e f g", "ÄÖ ÜÉ ñ ½ ٣ 漢字 🙂🙂 e\u0301",
        long_word + " end.", " ".join(some * 40), *some, some[0], some[1].replace(" the ", " that ", 1),
        "<|endoftext|> it's we'LL   <|endoftext|><|endoftext|>x", "\u00a0\u2003 \x1c\x1d y\u0085z  ",
    ]


def odd_docs(spark):
    """doc_id repeats and is null once; all other columns hold nulls; names clash with those used inside."""
    data = []
    for i, text in enumerate(odd_texts()):
        data.append((i, text, None if i % 3 else "en", f"src{i % 2}", None if text is None else len(text), "n", i, None))
    data.append((None, "a row without a key, with some words in it", None, None, None, None, None, None))
    data.append((5, "Two Words", "en", "src1", 9, "n", 5, None))
    data.append((5, "another text under the same key", "en", "src1", 9, "n", 5, None))
    return spark.createDataFrame(data, COLUMNS)
