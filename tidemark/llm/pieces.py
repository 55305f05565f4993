"""Encoding and decoding with a merge-type piece model.

Such a model joins neighbouring characters into pieces, always the pair whose joined piece scores highest, of equal ones
the leftmost. A row of pieces is what these merges give if and only if that holds for each two neighbours on their own,
so no merge has to be run over a text. At each place the longest piece that an Aho-Corasick automaton finds is tried
first, then its prefixes; two neighbours are checked by merging their characters again, and the answer is kept. A place
from which no piece fits is marked in a bitfield and never tried again, as the pieces before a place are always the same,
however it was reached. A text so takes time in proportion to its length.

Texts are cut where no piece reaches across: before a space that follows something else, and around characters that are
in no piece. What was cut before comes from a table of bounded size.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shipped, slices

shipped(__name__)

#: The mark that stands for a space, and what an unknown id and a broken byte decode to.
SPACE_MARK = "▁"
UNKNOWN_TEXT = " ⁇ "
BROKEN = "�"
#: Segments in the newer and in the older half of a Python worker's table, and the longest segment kept.
KEPT_SEGMENTS = 250_000
KEPT_LENGTH = 64
#: Checked neighbours a Python worker remembers; the table is emptied when full.
KEPT_PAIRS = 400_000


def read_model(path: str) -> dict:
    """What coding needs of a model file, as plain values: pieces with scores and kinds, and the ids of some of them.

    Only merge-type models without rewriting rules that keep all spaces are taken.
    """
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    trained, rules = model.trainer_spec, model.normalizer_spec
    kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
    if trained.model_type != trained.BPE:
        raise ValueError("the model's pieces are not made by merging")
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces or trained.treat_whitespace_as_suffix:
        raise ValueError("the model rewrites texts before it cuts them")
    names = {kinds.NORMAL: "piece", kinds.BYTE: "byte", kinds.UNKNOWN: "unknown", kinds.CONTROL: "control"}
    if any(p.type not in names for p in model.pieces):
        raise ValueError("the model has pieces that users defined or left unused")
    return {
        "pieces": [(p.piece, p.score, names[p.type]) for p in model.pieces],
        "end": trained.eos_id, "unknown": trained.unk_id, "bytes": trained.byte_fallback, "prefix": rules.add_dummy_prefix,
    }


class Coder:
    """Encoder and decoder of one model, as read by ``read_model``."""

    def __init__(self, model: dict):
        pieces = model["pieces"]
        self.end, self.unknown, self.prefix = model["end"], model["unknown"], model["prefix"]
        self.number = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == "piece"}
        self.score = {p: s for p, s, kind in pieces if kind == "piece"}
        self.of_byte = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == "byte"} if model["bytes"] else {}
        # Characters that only occur inside longer pieces get numbers behind those of the model.
        self.text = [p for p, _, _ in pieces]
        characters = {c for p in self.number for c in p}
        for c in sorted(characters - set(self.number)):
            self.number[c] = len(self.text)
            self.text.append(c)
        self.length = [len(t) for t in self.text]
        self.shorter = {}
        for p, i in self.number.items():
            prefixes = (self.number.get(p[:n]) for n in range(len(p) - 1, 0, -1))
            self.shorter[i] = next((x for x in prefixes if x is not None), None)
        self.found = ahocorasick.Automaton()
        for p, i in self.number.items():
            self.found.add_word(p, i)
        self.found.make_automaton()
        self.cut = self.cutter(characters)
        self.fits: dict[tuple[int, int], bool] = {}
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # What each id decodes to; a byte alone need not be a character.
        self.token = [p.replace(SPACE_MARK, " ").encode() for p, _, _ in pieces]
        self.single = np.zeros(len(pieces), bool)
        for i, (p, _, kind) in enumerate(pieces):
            if kind == "byte":
                self.token[i], self.single[i] = bytes([int(p[3:5], 16)]), True
            elif kind != "piece":
                self.token[i] = UNKNOWN_TEXT.encode() if kind == "unknown" else b""
        self.led = np.array([kind == "piece" and p.startswith(SPACE_MARK) for p, _, kind in pieces])
        self.silent = np.array([kind == "control" for _, _, kind in pieces])

    def cutter(self, characters: set[str]) -> re.Pattern:
        """Segments that no piece reaches out of: spaces and what follows them; characters that are in no piece."""
        inside = "".join(map(re.escape, sorted(characters - {SPACE_MARK})))
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in self.number):
            return re.compile(f"[{inside}{SPACE_MARK}]+|[^{inside}{SPACE_MARK}]+")
        return re.compile(f"{SPACE_MARK}*[{inside}]+|{SPACE_MARK}+|[^{inside}{SPACE_MARK}]+")

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text, by merging its characters."""
        parts = list(text)
        score = self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def stands(self, before: int, piece: int) -> bool:
        """Whether two neighbours (-1: none before) stay as they are when their characters are merged again."""
        held = self.fits.get((before, piece))
        if held is None:
            want = [self.text[piece]] if before < 0 else [self.text[before], self.text[piece]]
            held = self.merged("".join(want)) == want
            if len(self.fits) >= KEPT_PAIRS:
                self.fits.clear()
            self.fits[(before, piece)] = held
        return held

    def segment(self, text: str) -> list[int]:
        """The pieces of a segment whose characters are all known, by backtracking."""
        n, length, shorter, stands, fits = len(text), self.length, self.shorter, self.stands, self.fits
        longest = [-1] * (n + 1)
        for last, piece in self.found.iter(text):
            longest[last + 1 - length[piece]] = piece
        failed = bytearray(n // 8 + 1)
        path: list[int] = []
        at, piece, before = 0, longest[0], -1
        while at < n:
            while piece is not None:
                end = at + length[piece]
                if not failed[end >> 3] >> (end & 7) & 1:
                    held = fits.get((before, piece))
                    if stands(before, piece) if held is None else held:
                        break
                piece = shorter[piece]
            if piece is not None:
                path.append(piece)
                at, before, piece = end, piece, longest[end]
                continue
            failed[at >> 3] |= 1 << (at & 7)
            piece = path.pop()
            at -= length[piece]
            before = path[-1] if path else -1
        return path

    def ids(self, segment: str) -> list[int]:
        """The ids of a segment; a character without a piece of its own becomes its bytes, or the unknown id."""
        if segment[0] in self.number:
            known = self.segment(segment)
            if max(known) < len(self.token):
                return known
            parts = [p if p < len(self.token) else self.text[p] for p in known]
        else:
            parts = list(segment)
        out: list[int] = []
        for p in parts:
            if isinstance(p, int):
                out.append(p)
            elif self.of_byte:
                out += [self.of_byte[b] for b in p.encode("utf-8", "surrogatepass")]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def unseen(self, segment: str) -> bytes:
        """The ids of a segment that is not in the newer half of the table."""
        ids = self.older.get(segment)
        if ids is None:
            ids = array("i", self.ids(segment)).tobytes()
        if len(segment) <= KEPT_LENGTH:
            if len(self.kept) >= KEPT_SEGMENTS:
                self.older = dict(self.kept)
                self.kept.clear()
            self.kept[segment] = ids
        return ids

    def encode(self, text: str | None, end: bool = False) -> np.ndarray:
        last = [array("i", [self.end]).tobytes()] if end else []
        if not text:
            return np.frombuffer(b"".join(last), np.int32)
        segments = self.cut.findall((SPACE_MARK if self.prefix else "") + text.replace(" ", SPACE_MARK))
        parts = list(map(self.kept.get, segments))
        at = -1
        for _ in range(parts.count(None)):
            at = parts.index(None, at + 1)
            parts[at] = self.kept.get(segments[at]) or self.unseen(segments[at])
        return np.frombuffer(b"".join(parts + last), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: without control ids, and without the space that the encoder put in front."""
        silent = self.silent[ids]
        first = np.argmin(silent) if len(ids) else 0
        skip = 1 if self.prefix and len(ids) and self.led[ids[first]] else 0
        if not silent[:-1].any():
            try:
                return b"".join(map(self.token.__getitem__, ids.tolist()))[skip:].decode()
            except UnicodeDecodeError:
                pass
        return self.pieced(ids)[skip:]

    def pieced(self, ids: np.ndarray) -> str:
        """The text of ids whose bytes are not all characters: each byte that begins none becomes a mark.

        A control id between bytes ends a character.
        """
        out, run = [], b""
        for i in [*ids.tolist(), None]:
            if i is not None and self.single[i]:
                run += self.token[i]
                continue
            while run:
                size = next((n for n in range(1, 5) if valid(run[:n])), 0)
                out.append(run[:size].decode() if size else BROKEN)
                run = run[size or 1 :]
            if i is not None:
                out.append(self.token[i].decode())
        return "".join(out)


def valid(data: bytes) -> bool:
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


_coders: dict[int, Coder] = {}


def coder(model: dict) -> Coder:
    """The coder of a model, built once per Python process and model."""
    name = hash((tuple(model["pieces"]), model["end"], model["prefix"], model["bytes"]))
    if name not in _coders:
        _coders[name] = Coder(model)
    return _coders[name]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def tokenized(docs: DataFrame, path: str | None = None, text: str = "text", ids: str = "ids", decoded: str = "decoded",
              end: bool = True) -> DataFrame:
    """``docs`` with the piece ids of ``text``, an end id behind them, and the text they decode to, one row per row.

    ``path`` is a model file; the driver reads it and sends it to the tasks. A null or empty text has the end id only and
    decodes to the empty text. The mark for spaces, where a text has it, decodes to a space. Columns named like the two new
    ones are replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(read_model(path or default_path()))
    rows = docs.drop(ids, decoded)
    at = rows.columns.index(text)
    names = [*rows.columns, ids, decoded]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = coder(model.value)
        for part in slices(batches):
            lists = [mine.encode(t, end) for t in part.column(at).to_pylist()]
            ends = np.cumsum([0, *map(len, lists)], dtype=np.int32)
            numbers = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists)))
            texts = pa.array([mine.decode(x) for x in lists], pa.string())
            yield pa.RecordBatch.from_arrays([*part.columns, numbers, texts], names=names)

    schema = rows.select("*", F.lit(None).cast("array<int>").alias(ids), F.lit(None).cast("string").alias(decoded)).schema
    return rows.mapInArrow(coded, schema)
