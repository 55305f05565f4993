"""Substring dedup: passages that repeat across or within documents, found by MinHash banding of paragraphs.

A paragraph is a sentence of a line, or a run of short ones, so that a passage that was pasted into the middle of a
line is found as well. Word shingles give its MinHash signature; paragraphs that collide in a band are compared by exact
Jaccard similarity, and similar ones form components, of which the first place in the corpus stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate, chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import neardup
from tidemark.llm.common import looked_up, shipped, slices, stored

shipped(__name__)

SHINGLE = 5
THRESHOLD = 0.8
#: Shorter paragraphs repeat by chance and are left alone.
MIN_WORDS = 8
#: So are repeated stretches, paragraphs with at most GAP characters between them, of fewer words than this.
MIN_STRETCH = 14
GAP = 80
ROWS = 2
RECALL = 0.99
#: A sentence ends with its line or at a mark, closing quotes or brackets, then white space, which full-width marks need not have.
CUT = re.compile(r"\n|[.!?…][\"'”’»)\]]*[ \t\v\f\r]+|[。！？][\"'”’»)\]」』）]*[ \t\v\f\r]*")
#: Characters of scripts without spaces count as words: Thai to Myanmar, Khmer, kana, Han.
SPACELESS = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff])")
#: Short lines are put together up to this many words.
MOST_CARRIED = 32
SEEDS = (11, 12)
FIELDS = "id {id}, tie bigint, start bigint, stop bigint, h1 bigint, h2 int, words int, size int, keys array<bigint>"


def words_of(text: str) -> list[bytes]:
    if not text.isascii():
        text = SPACELESS.sub(r" \1 ", text)
    return text.encode("utf-8", "surrogatepass").lower().split()


def paragraphs(text: str | None) -> Iterator[tuple[int, int, list[bytes]]]:
    """Start, end and lower-case words of each paragraph with enough words.

    A sentence with enough words is one, and so are the short ones between two of these or up to the line's end. Lines
    that have too few words are put together, up to an empty line at most. Where to stop is told by the last line's words,
    so that copies of a passage are cut alike whatever stands before them. A word that fills a text alone gives none.
    """
    text = text or ""
    at = start = begin = 0
    run: list[bytes] = []  # short sentences of this line, from start
    carried: list[bytes] = []  # short lines before it, from begin
    for cut in [*CUT.finditer(text), None]:
        end = cut.end() if cut else len(text)
        words = words_of(text[at:end])
        line_ends = cut is None or text[cut.start()] == "\n"
        long = len(words) >= MIN_WORDS
        if not long:
            run += words
        if long or line_ends:
            stop = at if long else end
            if len(run) >= MIN_WORDS:
                if len(carried) >= MIN_WORDS:
                    yield begin, start, carried
                yield start, stop, run
                carried = []
            elif run or long or cut is None:
                begin = begin if carried else start
                carried = carried + run
                full = len(carried) >= MOST_CARRIED or crc32(b" ".join(run)) & 1
                if len(carried) >= MIN_WORDS and (full or long or cut is None):
                    yield begin, stop, carried
                    carried = []
            else:  # an empty line
                if len(carried) >= MIN_WORDS:
                    yield begin, start, carried
                carried = []
            if long:
                yield at, end, words
                carried = []
            run, start = [], end
        at = end


def name_of(line: bytes) -> tuple[int, int]:
    """Two hashes of a paragraph's words, of 64 and 32 bits, as signed numbers."""
    one, two = xxhash.xxh64_intdigest(line, SEEDS[0]), xxhash.xxh32_intdigest(line, SEEDS[1])
    return one - (one >> 63 << 64), two - (two >> 31 << 32)


def shingle_hashes(words: list[bytes], line: bytes) -> list[int]:
    """64-bit hashes of the word shingles."""
    if len(words) <= SHINGLE:
        return [xxhash.xxh64_intdigest(line)]
    ends = list(accumulate([len(w) + 1 for w in words]))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    return [digest(line[i : j - 1]) for i, j in zip(starts, ends[SHINGLE - 1 :])]


def constants(bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of the hash functions, one row per band."""
    random = np.random.default_rng(20)
    shape = (bands, ROWS)
    return random.integers(0, 1 << 63, shape, dtype=np.uint64) * 2 + 1, random.integers(0, 1 << 63, shape, dtype=np.uint64)


def band_keys(sets: list[list[int]], bands: int) -> np.ndarray:
    """One number per set and band, equal where all of the band's minima are equal."""
    every = np.fromiter(chain.from_iterable(sets), np.uint64)
    first = np.cumsum([0, *map(len, sets[:-1])])
    multiply, add = constants(bands)
    out = np.empty((len(sets), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(sets), band, np.uint64)
        for row in range(ROWS):
            mixed = every * multiply[band, row] + add[band, row]
            mixed ^= mixed >> np.uint64(32)
            mixed *= np.uint64(0xD6E8FEB86659FD93)
            key = (key ^ np.minimum.reduceat(mixed, first)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        out[:, band] = key
    return out.view(np.int64)


def places(docs: DataFrame, key: str, text: str, bands: int) -> DataFrame:
    """Every paragraph of every row: its place, two hashes that name its words, ``size`` of the shingle set, and the list ``keys`` of bands.

    The last two are given once for a paragraph that a few rows repeat, and null at its other places.
    """
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found, seen, sets = [], set(), []
            for i, text in enumerate(batch.column(2).to_pylist()):
                for at, end, words in paragraphs(text):
                    line = b" ".join(words)
                    name = name_of(line)
                    found.append((i, at, end, *name, len(words), name not in seen))
                    if name not in seen:
                        seen.add(name)
                        sets.append(shingle_hashes(words, line))
            if not found:
                continue
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            row, *rest = (pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds))
            signed = np.array([f[6] for f in found])
            flat = pa.array(band_keys(sets, bands).ravel())
            ends = np.concatenate([[0], np.cumsum(signed * bands)]).astype(np.int32)
            keys = pa.ListArray.from_arrays(pa.array(ends), flat, mask=pa.array(~signed))
            sizes = iter([len(set(s)) for s in sets])
            size = pa.array([next(sizes) if f[6] else None for f in found], pa.int32())
            columns = [batch.column(0).take(row), batch.column(1).take(row), *rest, size, keys]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "tie", "start", "stop", "h1", "h2", "words", "size", "keys"])

    return rows.mapInArrow(placed, FIELDS.format(id=rows.schema["id"].dataType.simpleString()))


def _distinct_lines(texts: list[str | None]) -> dict[tuple[int, int], tuple[bytes, list[bytes]]]:
    """Joined words and words by the name of each distinct paragraph."""
    lines = {}
    for text in texts:
        for _, _, words in paragraphs(text):
            line = b" ".join(words)
            lines[name_of(line)] = (line, words)
    return lines


def _named(lines: dict) -> list[pa.Array]:
    return [pa.array([n[0] for n in lines], pa.int64()), pa.array([n[1] for n in lines], pa.int32())]


def lines_of(docs: DataFrame, text: str, named: DataFrame) -> DataFrame:
    """``node`` and the joined words ``unit`` of the paragraphs in ``named`` (``node``, ``h1``, ``h2``)."""

    def lined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lines = _distinct_lines(batch.column(0).to_pylist())
            if lines:
                each = pa.array([line for line, _ in lines.values()], pa.binary())
                yield pa.RecordBatch.from_arrays([*_named(lines), each], names=["h1", "h2", "unit"])

    lines = docs.select(text).mapInArrow(lined, "h1 bigint, h2 int, unit binary")
    return looked_up(lines, named, ["h1", "h2"]).select("node", "unit").dropDuplicates(["node"])


def shingles(unit: str) -> Column:
    """The set of hashes of 64 bits of all word shingles."""
    starts = lambda words: F.sequence(F.lit(1), F.greatest(F.size(words) - SHINGLE + 1, F.lit(1)))
    sets = lambda words: F.transform(starts(words), lambda i: F.xxhash64(F.slice(words, i, F.lit(SHINGLE))))
    # As an array of one, so that the words are split once.
    return F.array_distinct(F.transform(F.array(F.split(F.decode(unit, "UTF-8"), " ")), sets)[0])


def _long_stretches(placed: DataFrame) -> DataFrame:
    """Places in stretches of enough words. A document's places are counted in their order."""
    mine = Window.partitionBy("id", "tie")
    before = F.max("stop").over(mine.orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("start") - before <= GAP, 0).otherwise(1)
    numbered = placed.withColumn("_begins", begins)
    numbered = numbered.withColumn("_stretch", F.sum("_begins").over(mine.orderBy("start").rowsBetween(Window.unboundedPreceding, 0)))
    long = F.sum("words").over(Window.partitionBy("id", "tie", "_stretch"))
    return numbered.withColumn("_long", long).filter(F.col("_long") >= MIN_STRETCH).drop("_begins", "_stretch", "_long")


def repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Paragraphs with a copy or near copy elsewhere: their place, component, and whether they are the one that stays.

    Repeated stretches of a text with fewer than ``MIN_STRETCH`` words, such as a common line alone, are left alone.

    One row per place: ``key``, ``start`` and ``end`` (characters of the text), ``words``, ``component`` and ``kept``.
    Of a component the place with the smallest key stays (a null key is the largest), of several the one of the smallest
    hash of its text, then the first in the text. Rows with equal key and text are one document here and keep the same
    paragraphs. Null, empty and short texts have no rows. Other columns are not read.
    """
    bands = neardup.tuned(threshold, RECALL, ROWS)
    docs = docs.filter(F.col(text).isNotNull())
    # Texts are cut and hashed once.
    found = stored(places(docs, key, text, bands))
    rows = found.filter("keys IS NOT NULL").select("h1", "h2", "size", F.explode("keys").alias("key"))
    near = neardup.linked(rows, lambda named: lines_of(docs, text, named), shingles, threshold)
    marked = neardup.members(found.drop("size", "keys"), near, key, "start", _long_stretches)
    return marked.select(key, "tie", "start", F.col("stop").alias("end"), "words", "component", "kept")
