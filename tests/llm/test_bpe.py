"""Byte-level BPE against the tokenizers library, and round trips."""

import random

import public_tokenizers
from fixtures import odd_docs, odd_texts
from tokenizers import Tokenizer

from tidemark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def coder():
    return bpe.coder(open(PATH, encoding="utf-8").read())


def test_ids_and_text_equal_the_library():
    theirs, mine = library(), coder()
    random.seed(3)
    marks = ["'s", "'ll", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "\x1c", "\x85", "é", "漢", "🙂", "e\u0301", "٣", "½", "…", "a", "B", "7",
             "<|endoftext|>", "<|endof", "|>", "\x00", "\x7f", "\ufeff", "\u200b", "the", "ing"]
    cases = [t for t in odd_texts() if t] + ["".join(random.choices(marks, k=random.randint(1, 60))) for _ in range(3000)]
    cases += ["".join(chr(random.choice([random.randint(1, 0x2FF), random.randint(0x370, 0x20FF), random.randint(0x4E00, 0x9FFF)]))
                      for _ in range(40)) for _ in range(500)]
    for text in cases:
        want = theirs.encode(text, add_special_tokens=False).ids
        assert list(mine.encode(text)) == want, repr(text)
        assert mine.decode(want) == theirs.decode(want, skip_special_tokens=False) == text


def test_long_word_without_spaces():
    text = "".join(random.Random(5).choices("abcdefgh", k=100_000))
    assert list(coder().encode(text)) == library().encode(text, add_special_tokens=False).ids


def test_column_functions(spark):
    docs = odd_docs(spark)
    got = bpe.tokenized(docs).collect()
    theirs = library()
    assert len(got) == docs.count()
    for row in got:
        assert row.ids == theirs.encode(row.text or "", add_special_tokens=False).ids
        assert row.decoded == (row.text or "")
    assert bpe.tokenized(docs).columns == [*docs.columns, "ids", "decoded"]
    assert bpe.tokenized(docs.limit(0)).count() == 0


def test_broken_bytes_decode_to_replacement_marks():
    mine, theirs = coder(), library()
    for ids in ([mine.start[0xE6]], [mine.start[0xE6], mine.start[0xBC]], [mine.start[0x80]] * 3, []):
        assert mine.decode(ids) == theirs.decode(ids, skip_special_tokens=False)


def test_table_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    mine = bpe.Coder(open(PATH, encoding="utf-8").read())
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    assert list(mine.encode(text)) == library().encode(text, add_special_tokens=False).ids
    assert len(mine.kept) <= 3
