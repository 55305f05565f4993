"""Line-first cleaning: rules judge each line, failing lines go, and documents that lose too much text go with them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shipped, slices

shipped(__name__)

MIN_WORDS = 50
#: A document goes when more than this share of its words stood in removed lines.
MOST_LOST = 0.5
SYMBOLS = "#*$%&|<>"
#: What a sentence may end in, closing quotes and brackets left aside.
ENDS = ".!?…。！？:;"
CLOSING = "\"'”’»)]"
#: A line without such an end goes if it has fewer words than this; a longer one is text that was cut off.
SHORT_LINE = 8
SEPARATORS = "|»›·•→>"
BOILERPLATE = (
    "all rights reserved", "privacy policy", "terms of use", "terms of service", "terms and conditions",
    "cookie policy", "we use cookies", "accept cookies", "enable javascript", "javascript is disabled",
    "lorem ipsum", "sign up for", "subscribe to our", "newsletter", "click here", "read more", "share this",
    "follow us on", "skip to content", "skip to main content", "powered by", "page not found", "add to cart",
)
REPEATED_MARKS = regex.compile(r"[!?*#$%&|<>=_~^-]{2,}")
BOILERPLATE_PHRASE = regex.compile("|".join(map(regex.escape, BOILERPLATE)), regex.IGNORECASE)
SPACES = " \t\n\v\f\r"


def line_rule(line: str) -> str | None:
    """The rule that a line fails, or None; a line without words fails none.

    navigation: separators between its words, one for each two words or more. boilerplate: short and with a stock
    phrase. marks: runs of marks at a fourth of its words or more. punctuation: short and no sentence's end.
    """
    words = line.encode("utf-8", "surrogatepass").split()
    n = len(words)
    if not n:
        return None
    separators = sum(w in _SEPARATOR_WORDS for w in words)
    if separators and 3 * separators >= n:
        return "navigation"
    if n < 4 * SHORT_LINE and BOILERPLATE_PHRASE.search(line):
        return "boilerplate"
    if n > 1 and 4 * len(REPEATED_MARKS.findall(line)) >= n:
        return "marks"
    if n < SHORT_LINE and line.rstrip(SPACES + CLOSING)[-1:] not in ENDS:
        return "punctuation"
    return None


_SEPARATOR_WORDS = frozenset(c.encode() for c in SEPARATORS)


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window of three words found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    number = known.setdefault
    ids = np.fromiter((number(w, len(known)) for w in words), np.int64, n)
    size = len(known)
    _, pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)
    _, of, count = np.unique(pairs[:-1] * size + ids[2:], return_inverse=True, return_counts=True)
    again = count[of] > 1
    covered = np.zeros(n, bool)
    for at in range(3):
        covered[at : n - 2 + at] |= again
    return int(covered.sum())


def measures(text: str | None) -> tuple:
    """The figures of one text, the text left after removing lines, and what each rule removed."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n_words = len(words)
    lines = text.split("\n")
    with_words = [line for line in lines if line.strip(SPACES)]
    failed = [(line, rule) for line in lines if (rule := line_rule(line))]
    lost = sum(len(line.encode("utf-8", "surrogatepass").split()) for line, _ in failed)
    repeats = repeated_words(words)
    base_failed = n_words < MIN_WORDS or 100 * repeats > 50 * n_words
    clean = "\n".join(line for line in lines if not line_rule(line)) if failed else text
    return (
        n_words, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
        len(with_words) - len(set(with_words)), repeats, base_failed, not base_failed and lost <= MOST_LOST * n_words,
        len(failed), lost, clean,
    )


FIGURES = (
    ("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"), ("n_dup_lines", "bigint"),
    ("n_repeat_words", "bigint"), ("base_failed", "boolean"), ("kept", "boolean"), ("n_failed_lines", "bigint"),
    ("n_failed_words", "bigint"), ("clean_text", "string"),
)


def figures(text: Column) -> Column:
    """A struct of :data:`FIGURES` for each text."""
    names = [name for name, _ in FIGURES]

    @F.pandas_udf(", ".join(f"{n} {t}" for n, t in FIGURES))
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            yield pd.DataFrame([measures(t) for t in texts], columns=names)

    return of(text)


def judged(docs: DataFrame, text: str = "text", into: str = "quality") -> DataFrame:
    """``docs`` with a struct of the figures, the verdict ``kept`` and the cleaned text, one row per row.

    A null text counts as empty: no words, not kept. Repeated rows get equal figures. A column of the struct's name is
    replaced; all others stay.
    """
    return docs.withColumn(into, figures(F.col(text)))


def cleaned(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The rows that are kept, their text without the failed lines; ``length``, if there, is counted anew.

    Each text is judged once, in small slices. All other columns stay, whatever their names.
    """
    at = docs.columns.index(text)
    counted = docs.columns.index(length) if length in docs.columns else None

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [measures(t) for t in part.column(at).to_pylist()]
            rows = part.filter(pa.array([f[6] for f in found], pa.bool_()))
            columns, texts = list(rows.columns), [f[9] for f in found if f[6]]
            columns[at] = pa.array(texts, part.schema.field(at).type)
            if counted is not None:
                columns[counted] = pa.array(map(len, texts), part.schema.field(counted).type)
            yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return docs.mapInArrow(clean, docs.schema)
