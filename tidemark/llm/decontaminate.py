"""Benchmark passages in documents, by the q-gram lemma.

A passage that is a benchmark item with at most k edits shares at least L - q + 1 - kq of the item's L - q + 1
character q-grams with it, and they lie on diagonals (place in the text minus place in the item) no further than k
apart. So shared q-grams are counted in bands of 2k + 2 diagonals, each overlapping the next by half; bands
with enough of them are aligned with the item inside the band, and stay if that takes at most k edits.

The benchmark is taken in blocks of bounded size; every block is sent to all tasks, which read each text once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, free_name, shipped, slices

shipped(__name__)

Q = 8
#: Edits per character of an item.
EDIT_RATE = 0.1
#: Characters of benchmark items per block, about; a longer item is a block of its own.
BLOCK_CHARS = 4_000_000
MULTIPLIER = 0x9E3779B97F4A7C15
FILTER_BITS = 22
#: Grams looked up at a time.
PIECE = 1 << 20


def characters(text: str | None) -> np.ndarray:
    """Code points, A-Z in lower case and white space as a space; one for each character."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    out = codes.copy()
    out[(codes >= 65) & (codes <= 90)] += 32
    out[((codes >= 9) & (codes <= 13)) | (codes == 0xA0)] = 32
    return out


def grams(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit number for the q characters from each place on."""
    n = len(codes) - q + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(q):
        total *= np.uint64(1099511628211)
        total += codes[i : i + n]
    return total * np.uint64(MULTIPLIER)


def budget(length: int, q: int, rate: float) -> int:
    """Edits allowed in an item: its share, but never so many that no q-gram need be left."""
    return max(0, min(int(length * rate), (length - q) // q))


@dataclass
class Block:
    """The items of one block and where each of their q-grams stands."""

    ids: list
    codes: list[np.ndarray]
    edits: np.ndarray
    need: np.ndarray
    gram: np.ndarray  # sorted, distinct
    first: np.ndarray  # places of gram i are item[first[i] : first[i + 1]], at[...]
    item: np.ndarray
    at: np.ndarray
    hit: np.ndarray


def block_of(items: list[tuple], q: int, rate: float) -> Block:
    codes = [characters(text) for _, text in items]
    whole = [grams(c, q) for c in codes]
    lengths = np.array([len(c) for c in codes], np.int64)
    edits = np.array([budget(n, q, rate) for n in lengths.tolist()], np.int64)
    every = np.concatenate([*whole, np.zeros(0, np.uint64)])
    item = np.repeat(np.arange(len(items)), [len(w) for w in whole])
    at = np.concatenate([*(np.arange(len(w)) for w in whole), np.zeros(0, np.int64)]).astype(np.int64)
    order = np.argsort(every, kind="stable")
    gram, first = np.unique(every[order], return_index=True)
    hit = np.zeros(1 << FILTER_BITS, bool)
    hit[gram >> np.uint64(64 - FILTER_BITS)] = True
    return Block([i for i, _ in items], codes, edits, lengths - q + 1 - edits * q, gram, np.r_[first, len(every)], item[order], at[order], hit)


def shared(text: np.ndarray, block: Block, q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in the text and item, and the item, of all shared q-grams."""
    out = []
    for start in range(0, len(text), PIECE):
        own = grams(text[start : start + PIECE + q - 1], q)
        maybe = np.flatnonzero(block.hit[own >> np.uint64(64 - FILTER_BITS)])
        if not len(maybe) or not len(block.gram):
            continue
        found = np.minimum(np.searchsorted(block.gram, own[maybe]), len(block.gram) - 1)
        same = block.gram[found] == own[maybe]
        maybe, found = maybe[same], found[same]
        count = block.first[found + 1] - block.first[found]
        place = np.repeat(block.first[found], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        out.append((np.repeat(maybe + start, count), block.at[place], block.item[place]))
    empty = np.zeros(0, np.int64)
    return tuple(np.concatenate([empty, *(o[i] for o in out)]) for i in range(3))


def regions(text: np.ndarray, block: Block, q: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """Item, lowest diagonal of a band, distinct q-grams of the item shared there and their diagonals.

    Only bands that meet the bound come. A band is 2k + 2 wide and the next begins k + 1 further on, so that any k + 1
    adjacent diagonals are inside one.
    """
    here, there, item = shared(text, block, q)
    if not len(here):
        return
    enough = np.bincount(item, minlength=len(block.ids))[item] >= block.need[item]
    there, item, diagonal = there[enough], item[enough], (here - there)[enough]
    if not len(item):
        return
    low = diagonal // (block.edits[item] + 1)
    first = int(low.min()) - 1
    count_bands = int(low.max()) - first + 1
    band = item * count_bands + low - first
    both = np.concatenate([band, band - 1])
    bands, count = np.unique(both, return_counts=True)
    some = count >= block.need[bands // count_bands]
    if not some.any():
        return
    order = np.argsort(both, kind="stable")
    ends = np.cumsum(count)
    for b, start, end in zip(bands[some].tolist(), (ends - count)[some].tolist(), ends[some].tolist()):
        mine = order[start:end] % len(band)
        i = b // count_bands
        n = len(np.unique(there[mine]))
        if n >= block.need[i]:
            yield i, (b % count_bands + first) * int(block.edits[i] + 1), n, diagonal[mine]


def aligned(item: np.ndarray, text: np.ndarray, low: int, width: int, most: int) -> tuple[int, int, int] | None:
    """Fewest edits that make the item a passage of the text within ``width`` diagonals from ``low`` on; its bounds.

    The start and end in the text are free. Row i holds the costs of the item's first i characters ending on each
    diagonal; along with them goes where the passage began. Of equal costs the leftmost end counts. None above ``most``.
    """
    far = most + 1
    places = low + np.arange(width)
    inside = (places >= 0) & (places <= len(text))
    cost = np.where(inside, 0, far)
    start = np.where(inside, places, 0)
    steps = np.arange(width)
    for i in range(1, len(item) + 1):
        places = low + i + steps
        inside = (places >= 1) & (places <= len(text))
        differs = np.ones(width, np.int64)
        differs[inside] = text[places[inside] - 1] != item[i - 1]
        replaced = np.where(inside, cost + differs, far)
        dropped = np.r_[cost[1:] + 1, far]
        dropped[(places < 0) | (places > len(text))] = far
        take = dropped < replaced
        cost = np.where(take, dropped, replaced)
        start = np.where(take, np.r_[start[1:], 0], start)
        # Characters only in the text: along the row, each one more.
        lead = np.minimum.accumulate((cost - steps) * width + steps)
        from_ = lead % width
        added = lead // width + steps
        more = (added < cost) & inside
        cost = np.where(more, added, cost)
        start = np.where(more, start[from_], start)
        cost = np.minimum(cost, far)
        if cost.min() > most:
            return None
    best = int(cost.argmin())
    return int(cost[best]), int(start[best]), int(low + len(item) + best)


def exact(item: np.ndarray, text: np.ndarray, diagonals: np.ndarray) -> int | None:
    """Where the text has the item as it is, on the diagonal with most shared q-grams, if there."""
    values, count = np.unique(diagonals, return_counts=True)
    at = int(values[count.argmax()])
    return at if at >= 0 and np.array_equal(text[at : at + len(item)], item) else None


def matches(text: str | None, block: Block, q: int = Q) -> list[tuple]:
    """item id, start, end, edits and shared q-grams of each passage; of passages that overlap, the best."""
    codes = characters(text)
    found: dict[int, list[tuple]] = {}
    for i, low, n, diagonals in regions(codes, block, q):
        item, edits = block.codes[i], int(block.edits[i])
        hits = found.setdefault(i, [])
        at = exact(item, codes, diagonals)
        if at is not None:
            hits.append((0, at, at + len(item), n))
        elif not any(h[0] == 0 and low <= h[1] < low + 2 * edits + 2 for h in hits):
            # Bands overlap; one that holds a passage without edits needs no second look.
            if hit := aligned(item, codes, low, 2 * edits + 2, edits):
                hits.append((*hit, n))
    out = []
    for i, hits in found.items():
        taken: list[tuple] = []
        for cost, start, end, n in sorted(hits):
            if all(end <= t[1] or start >= t[2] for t in taken):
                taken.append((cost, start, end, n))
        out += [(block.ids[i], start, end, cost, n) for cost, start, end, n in taken]
    return out


def blocks(items: DataFrame, key: str, text: str, chars: int) -> Iterator[list[tuple]]:
    """The distinct items in blocks of bounded size, dealt by hash. Items without text are in none."""
    rows = items.select(F.col(key).alias("id"), F.col(text).alias("text")).filter("length(text) > 0").distinct()
    total = rows.agg(F.sum(F.length("text").cast("bigint"))).first()[0] or 0
    count = -(-total // chars)
    if count > 1:
        rows = checkpointed(rows)
    for b in range(count):
        part = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == b)
        if own := [tuple(r) for r in part.collect()]:
            yield own


def contaminated(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    q: int = Q, edit_rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Passages of ``docs`` that are an item with few edits: ``key``, ``item``, ``start``, ``end``, ``edits``, ``shared``.

    ``edit_rate`` is per character of the item; places count characters of the text. One row per passage, so a text
    may have several, of one item too. Null and empty texts have none; items shorter than ``q`` characters have none
    either. Case (A-Z) and the kind of white space do not matter. Equal items under one key count once, equal documents
    as often as they are there. Other columns are not read.
    """
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kinds = (rows.schema["id"].dataType.simpleString(), items.schema[item].dataType.simpleString())
    schema = f"id {kinds[0]}, item {kinds[1]}, start bigint, stop bigint, edits bigint, shared bigint"
    found = docs.sparkSession.createDataFrame([], schema)
    for part in blocks(items, item, item_text, block_chars):
        given = docs.sparkSession.sparkContext.broadcast(part)
        found = found.union(rows.mapInArrow(_finder(given, q, edit_rate), schema))
    return found.toDF(key, item, "start", "end", "edits", "shared")


def _finder(given, q: int, rate: float):
    def finds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = block_of(given.value, q, rate)
        item_type = None
        for batch in slices(batches):
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            row, hits = [], []
            for i, text in enumerate(texts):
                for hit in matches(text, block, q):
                    row.append(i)
                    hits.append(hit)
            if hits:
                item_type = item_type or pa.array(block.ids).type
                columns = [pa.array([h[0] for h in hits], item_type), *(pa.array([h[i] for h in hits], pa.int64()) for i in range(1, 5))]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), *columns], names=["id", "item", "start", "stop", "edits", "shared"])

    return finds


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", **parameters) -> DataFrame:
    """The rows of ``docs`` without any passage of an item, all columns as they are."""
    mark = free_name(docs, "_passages")
    kept = docs
    for part in blocks(items, item, item_text, parameters.get("block_chars", BLOCK_CHARS)):
        given = docs.sparkSession.sparkContext.broadcast(part)
        q, rate = parameters.get("q", Q), parameters.get("edit_rate", EDIT_RATE)
        kept = kept.withColumn(mark, _counter(given, q, rate)(F.col(text))).filter(F.col(mark) == 0).drop(mark)
    return kept


def _counter(given, q: int, rate: float):
    @F.pandas_udf("int")
    def counts(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        block = block_of(given.value, q, rate)
        for texts in parts:
            yield pd.Series([len(matches(t, block, q)) for t in texts], dtype="int32")

    return counts
