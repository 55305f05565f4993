"""Near copies by SimHash, found by a self-join of binary tries.

A document's fingerprint has a bit where more than half of its word shingles' hashes have it. Fingerprints that
differ in at most three bits are linked. The bits are cut into four blocks: two linked fingerprints agree in one of
them, so four copies of each distinct fingerprint, one with each block in front, are dealt out by that block. Within
a block the rest is a binary trie, joined with itself: pairs of nodes go down together, count the bits in which
they differ, and end where that exceeds the budget. A block that holds very many fingerprints is cut again in the
same way, by the bits behind it.

Only the links of a spanning forest leave a task, so a large group of near copies gives no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, free_name, shipped
from tidemark.llm.components import components

shipped(__name__)

SEED = 42
SHINGLE = 3
BUDGET = 3
BLOCKS = BUDGET + 1
#: Fingerprints under one block above which the block is cut again.
NODE_ROWS = 1 << 18
#: Fingerprints of whole blocks that a task joins at a time, and node pairs it opens at a time.
TASK_ROWS = 1 << 19
OPEN_PAIRS = 1 << 20
#: Node pairs with at most so many leaf pairs are compared leaf by leaf.
LEAF_PAIRS = 32


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of one text; null or no words: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    k = min(shingle, len(words))
    cuts = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[i:j], SEED) for i, j in cuts), np.uint64, len(words) - k + 1)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(votes * 2 > len(hashes))
    return int(bits.view(">i8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    return of(text)


def _turned(bits: Column, width: int, by: int) -> Column:
    """The lowest ``width`` bits turned left by ``by``, the others as they are."""
    if by == 0:
        return bits
    mask = (1 << width) - 1
    low = bits if width == 64 else bits.bitwiseAND(F.lit(mask))
    turned = F.shiftleft(low, by).bitwiseOR(F.shiftrightunsigned(low, width - by))
    if width == 64:
        return turned
    return bits.bitwiseAND(F.lit(~mask)).bitwiseOR(turned.bitwiseAND(F.lit(mask)))


def _cut(rows: DataFrame, fixed: int) -> tuple[DataFrame, int]:
    """Copies of each row with another block of the bits behind the first ``fixed`` in front; the bits then fixed."""
    width = 64 - fixed
    block = width // BLOCKS
    copies = [
        F.struct((F.col("walk") * (BLOCKS + 1) + i + 1).alias("walk"), _turned(F.col("bits"), width, i * block).alias("bits"))
        for i in range(BLOCKS)
    ]
    cut = rows.select("fp", F.explode(F.array(*copies)).alias("x")).select("fp", "x.walk", "x.bits")
    return cut.withColumn("node", F.shiftrightunsigned("bits", 64 - fixed - block)), fixed + block


def links(fingerprints: DataFrame, node_rows: int = NODE_ROWS) -> DataFrame:
    """``a`` and ``b``: links that connect every two of the distinct ``fp`` that differ in at most ``BUDGET`` bits."""
    rows, fixed = _cut(fingerprints.select("fp", F.lit(0).cast("bigint").alias("walk"), F.col("fp").alias("bits")), 0)
    found = None
    while True:
        rest = None
        if fixed < 40:
            large = checkpointed(
                rows.groupBy("walk", "node").count().filter(F.col("count") > node_rows).select("walk", "node")
            )
            if not large.isEmpty():
                rest = rows.join(large, ["walk", "node"], "left_semi")
                rows = rows.join(large, ["walk", "node"], "left_anti")
        joined = (
            rows.repartition("walk", "node").sortWithinPartitions("walk", "node").select("walk", "node", "bits", "fp")
            .mapInArrow(_joiner(fixed), "a bigint, b bigint")
        )
        found = joined if found is None else found.union(joined)
        if rest is None:
            return found
        rows, fixed = _cut(rest.select("fp", "walk", "bits"), fixed)


def _joiner(fixed: int):
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for walk, bits, fps in _whole_nodes(batches):
            for w in np.unique(walk):
                mine = walk == w
                a, b = trie_join(bits[mine].view(np.uint64), fps[mine], fixed)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return joined


def _whole_nodes(batches: Iterator[pa.RecordBatch]):
    """Columns of so many rows that each node's are together."""
    held: list[np.ndarray] = []
    count = 0
    for batch in batches:
        if batch.num_rows:
            held.append(np.stack([c.to_numpy() for c in batch.columns]))
            count += batch.num_rows
        if count >= TASK_ROWS:
            rows = np.concatenate(held, axis=1)
            last = np.flatnonzero((rows[:2] != rows[:2, -1:]).any(axis=0))
            end = int(last[-1]) + 1 if len(last) else 0
            if end:
                yield rows[0, :end], rows[2, :end], rows[3, :end]
            held, count = [rows[:, end:]], rows.shape[1] - end
    if count:
        rows = np.concatenate(held, axis=1)
        yield rows[0], rows[2], rows[3]


def trie_join(bits: np.ndarray, names: np.ndarray, fixed: int, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """Links among distinct ``bits`` that agree in the first ``fixed``, as pairs of ``names``.

    The sorted bits are the trie: a node is a run of them, and its two children meet where the next bit turns to one.
    """
    order = np.argsort(bits)
    bits, names = bits[order], names[order]
    label = np.arange(len(bits))
    tops = bits >> np.uint64(64 - fixed)
    starts = np.flatnonzero(np.r_[True, tops[1:] != tops[:-1]])
    ends = np.r_[starts[1:], len(bits)]
    some = ends - starts > 1
    open_pairs = [(fixed, np.stack([starts[some], ends[some], starts[some], ends[some], np.zeros(some.sum(), np.int64)]))]
    while open_pairs:
        depth, pairs = open_pairs.pop()
        if pairs.shape[1] > OPEN_PAIRS:
            half = pairs.shape[1] // 2
            open_pairs += [(depth, pairs[:, :half]), (depth, pairs[:, half:])]
            continue
        small = ((pairs[1] - pairs[0]) * (pairs[3] - pairs[2]) <= LEAF_PAIRS) | (depth == 64)
        _link_leaves(bits, label, pairs[:, small], budget)
        pairs = pairs[:, ~small]
        if pairs.shape[1]:
            below = _children(bits, pairs, depth, budget)
            if below.shape[1]:
                open_pairs.append((depth + 1, below))
    hung = label != np.arange(len(bits))
    return names[hung], names[label[hung]]


def _children(bits: np.ndarray, pairs: np.ndarray, depth: int, budget: int) -> np.ndarray:
    def middle(low, high):
        below = np.uint64(64 - depth)
        prefix = (bits[low] >> below) << below if depth else np.zeros(len(low), np.uint64)
        turn = np.searchsorted(bits, prefix | np.uint64(1 << (63 - depth)))
        return np.clip(turn, low, high)

    l1, h1, l2, h2, differ = pairs
    same = l1 == l2
    m1, m2 = middle(l1, h1), middle(l2, h2)
    down = np.concatenate(
        [
            np.stack([l1, m1, l2, m2, differ]),
            np.stack([m1, h1, m2, h2, differ]),
            np.stack([l1, m1, m2, h2, differ + 1]),
            np.stack([m1, h1, l2, m2, differ + 1])[:, ~same],
        ],
        axis=1,
    )
    full = (down[0] < down[1]) & (down[2] < down[3]) & (down[4] <= budget)
    alone = (down[0] == down[2]) & (down[1] - down[0] == 1)
    return down[:, full & ~alone]


def _link_leaves(bits: np.ndarray, label: np.ndarray, pairs: np.ndarray, budget: int) -> None:
    """Compare every leaf of one node with every leaf of the other, and hang linked ones on one label."""
    step = 1 << 16
    for at in range(0, pairs.shape[1], step):
        l1, h1, l2, h2, _ = pairs[:, at : at + step]
        count = (h1 - l1) * (h2 - l2)
        which = np.repeat(np.arange(len(count)), count)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        wide = (h2 - l2)[which]
        i, j = l1[which] + offset // wide, l2[which] + offset % wide
        near = (i != j) & (np.bitwise_count(bits[i] ^ bits[j]) <= budget)
        unite(label, i[near], j[near])


def unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give linked items one label, the smallest index among them."""
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", node_rows: int = NODE_ROWS) -> DataFrame:
    """``key``, ``fingerprint`` (hex) and ``component_id``, the smallest key reachable over links, one row per row.

    Null and wordless texts have fingerprint zero, linked like any other. Rows with equal keys and texts stay rows of
    their own. A row without a key takes part in its component, whose name is null where no row has a key. Other columns
    are not read.
    """
    rows = checkpointed(docs.select(F.col(key).alias("id"), fingerprint(F.col(text)).alias("fp")))
    distinct = rows.groupBy("fp").agg(F.min("id").alias("first_id"))
    found = components(links(distinct.select("fp"), node_rows))
    named = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.withColumn("component", F.coalesce("component", "fp"))
    names = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_print = named.select("fp", "component").join(names, "component").select("fp", "component_id")
    return rows.join(by_print, "fp").select(
        F.col("id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_per_component(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, one of each component, all columns as they are.

    The row with the smallest key stays (a null key is the largest), of several with that key the one with the smallest
    hash of its values, and of equal rows one.
    """
    tie, mark, kept_id, kept_tie = (free_name(docs, c) for c in ("_tie", "_mark", "_kept_id", "_kept_tie"))
    rest = [F.col(c) for c in docs.columns if c != key]
    tied = docs.withColumn(tie, F.xxhash64(*rest) if rest else F.lit(0).cast("bigint"))
    rows = checkpointed(tied.select(F.col(key).alias("id"), F.col(tie).alias("tie"), fingerprint(F.col(text)).alias("fp")))
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "tie")
    counted = rows.groupBy("fp", "id", "tie").agg(F.count("*").alias("rows"))
    first = counted.groupBy("fp").agg(F.min_by(F.struct("id", "tie", "rows"), order).alias("first"))
    found = components(links(first.select("fp")))
    named = first.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        F.coalesce("component", "fp").alias("component"), "first.*"
    )
    kept = checkpointed(
        named.groupBy("component").agg(F.min_by(F.struct("id", "tie", "rows"), order).alias(mark)).select(f"{mark}.*")
        .toDF(kept_id, kept_tie, mark)
    )

    def those(part: DataFrame) -> DataFrame:
        return tied.join(part, F.col(key).eqNullSafe(F.col(kept_id)) & (F.col(tie) == F.col(kept_tie)))

    once = those(kept.filter(F.col(mark) == 1)).select(docs.columns)
    repeated = those(kept.filter(F.col(mark) > 1)).dropDuplicates([key, tie]).select(docs.columns)
    return once.unionByName(repeated)
