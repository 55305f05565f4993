"""Byte-level BPE encoding and decoding.

A text is cut into words by the tokenizer's pattern, a word into bytes, and bytes are merged: always the mergeable
pair of lowest rank, of several the leftmost. A segment tree, sixteen children to a node, holds the rank and place of
every adjacent pair; its root is the next merge, and a merge changes at most three leaves and the nodes above them. A
word of n bytes so takes n log n steps, however long it is. Words seen before come from a table of bounded size.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shipped, slices

shipped(__name__)

#: How the tokenizer cuts a text into words. White space is that of Unicode.
CUT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
NEVER = 1 << 62
PLACE = (1 << 40) - 1
#: Words in the newer and in the older half of a Python worker's table, and the longest word kept.
KEPT_WORDS = 250_000
KEPT_LENGTH = 64


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte: itself where printable in Latin-1, else one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Coder:
    """Encoder and decoder of one tokenizer file's content."""

    def __init__(self, content: str):
        model = json.loads(content)
        of = byte_characters()
        vocabulary = model["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        names = {**vocabulary, **self.special}
        self.token = [b""] * (max(names.values()) + 1)
        for name, number in names.items():
            known = all(c in of for c in name)
            self.token[number] = bytes(of[c] for c in name) if known else name.encode()
        self.start = [0] * 256
        for c, b in of.items():
            self.start[b] = vocabulary[c]
        self.merges: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocabulary[a] << 20 | vocabulary[b]] = rank << 40
            self.merged.append(vocabulary[a + b])
        self.cut = regex.compile(CUT)
        marks = sorted(self.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def word(self, data: bytes) -> list[int]:
        """Merge one word's bytes."""
        start, merged, get = self.start, self.merged, self.merges.get
        ids = [start[b] for b in data]
        n = len(ids)
        # A leaf is the rank and place of the pair that begins there; NEVER or more: no merge.
        leaves = [get(a << 20 | b, NEVER) + i for i, (a, b) in enumerate(zip(ids, ids[1:]))]
        if not leaves:
            return ids
        levels = [leaves]
        while len(low := levels[-1]) > 1:
            levels.append([min(low[k : k + 16]) for k in range(0, len(low), 16)])
        top = levels[-1]
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while (best := top[0]) < NEVER:
            i = best & PLACE
            j = after[i]
            ids[i] = merged[best >> 40]
            ids[j] = -1
            k = after[i] = after[j]
            changed = [i]
            if k < n:
                before[k] = i
                leaves[i] = get(ids[i] << 20 | ids[k], NEVER) + i
                leaves[j] = NEVER
                changed.append(j)
            else:
                leaves[i] = NEVER
                if j < n - 1:
                    leaves[j] = NEVER
                    changed.append(j)
            h = before[i]
            if h >= 0:
                leaves[h] = get(ids[h] << 20 | ids[i], NEVER) + h
                changed.append(h)
            if len(levels) == 2:
                top[0] = min(leaves)
                continue
            for at in changed:
                for low, high in zip(levels, levels[1:]):
                    at >>= 4
                    least = min(low[at * 16 : at * 16 + 16])
                    if high[at] == least:
                        break
                    high[at] = least
        return [x for x in ids if x >= 0]

    def unseen(self, word: str) -> bytes:
        """The ids of a word that is not in the newer half of the table."""
        ids = self.older.get(word)
        if ids is None:
            ids = array("i", self.word(word.encode("utf-8", "surrogatepass"))).tobytes()
        if len(word) <= KEPT_LENGTH:
            if len(self.kept) >= KEPT_WORDS:
                self.older = dict(self.kept)
                self.kept.clear()
            self.kept[word] = ids
        return ids

    def plain(self, text: str) -> bytes:
        """The ids, four bytes each, of a text without special tokens."""
        words = self.cut.findall(text)
        parts = list(map(self.kept.get, words))
        at = -1
        for _ in range(parts.count(None)):
            at = parts.index(None, at + 1)
            parts[at] = self.kept.get(words[at]) or self.unseen(words[at])
        return b"".join(parts)

    def encode(self, text: str | None) -> np.ndarray:
        parts = self.marks.split(text or "") if self.marks else [text or ""]
        ids = [array("i", [self.special[p]]).tobytes() if i % 2 else self.plain(p) for i, p in enumerate(parts)]
        return np.frombuffer(b"".join(ids), np.int32)

    def decode(self, ids) -> str:
        token = self.token
        return b"".join([token[i] for i in ids]).decode("utf-8", "replace")


_coders: dict[str, Coder] = {}


def coder(content: str) -> Coder:
    """The coder of a tokenizer file's content, built once per Python process."""
    name = hashlib.sha256(content.encode()).hexdigest()
    if name not in _coders:
        _coders[name] = Coder(content)
    return _coders[name]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def tokenized(docs: DataFrame, path: str | None = None, text: str = "text", ids: str = "ids", decoded: str = "decoded"):
    """``docs`` with the token ids of ``text`` and the text they decode to, one row per row.

    ``path`` is a tokenizer file; the driver reads it and sends it to the tasks. A null or empty text has no tokens and
    decodes to the empty text; bytes that are no UTF-8 decode to U+FFFD. Columns named like the two new ones are replaced.
    """
    with open(path or default_path(), encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.drop(ids, decoded)
    at = rows.columns.index(text)
    names = [*rows.columns, ids, decoded]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = coder(content.value)
        for part in slices(batches):
            lists = [mine.encode(t) for t in part.column(at).to_pylist()]
            ends = np.cumsum([0, *map(len, lists)], dtype=np.int32)
            numbers = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists)))
            texts = pa.array([mine.decode(x.tolist()) for x in lists], pa.string())
            yield pa.RecordBatch.from_arrays([*part.columns, numbers, texts], names=names)

    schema = rows.select("*", F.lit(None).cast("array<int>").alias(ids), F.lit(None).cast("string").alias(decoded)).schema
    return rows.mapInArrow(coded, schema)
