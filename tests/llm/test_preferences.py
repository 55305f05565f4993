"""Preference pairs against plain code."""

from pyspark.sql import functions as F

from tidemark.llm import preferences

TURNS = [
    (0, 0, "system", "be kind"), (0, 1, "user", "hi"), (0, 2, "assistant", "hello"), (0, 3, "user", "more"), (0, 4, "assistant", "ok"),
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "go away"),
    (2, 0, "user", "same"), (2, 1, "assistant", "same"), (3, 0, "user", "same"), (3, 1, "assistant", "same"),
    (4, 0, "user", "alone"),
    (6, 0, "user", None), (6, 1, None, "x"), (7, 0, "user", None), (7, 1, None, "x"), (7, 2, "assistant", ""),
    (8, 5, "user", "é🙂"), (8, 9, "assistant", "y" * 5000), (8, 9, "assistant", "tie"), (8, 9, "assistant", "tie"), (9, None, "assistant", "z"),
    (None, 0, "user", "no conversation"),
]
SCHEMA = "conv_id int, turn int, role string, text string"


def plain(turns):
    sides = {}
    key = lambda x: (x[0] is not None, x[0] if x[0] is not None else 0, x[1] is not None, x[1] or "", x[2] is not None, x[2] or "")
    for conv, *rest in set(turns):
        if conv is not None:
            sides.setdefault(conv, []).append(tuple(rest))
    out = {}
    for pair in {c // 2 for c in sides}:
        a, b = (sorted(sides.get(2 * pair + i, []), key=key) for i in (0, 1))
        if not a or not b:
            continue
        n = 0
        while n < min(len(a), len(b)) and a[n][1:] == b[n][1:]:
            n += 1
        show = lambda t: f"<|im_start|>{t[1] or ''}\n{t[2] or ''}<|im_end|>\n"
        one = {"prompt": "".join(map(show, a[:n]))}
        for name, turns_ in (("chosen", a[n:]), ("rejected", b[n:])):
            text, spans = "", []
            for t in turns_:
                line = show(t)
                if t[1] == "assistant":
                    spans.append((len(text) + len("<|im_start|>assistant\n"), len(text) + len(line) - 1))
                text += line
            one[name], one[f"{name}_spans"] = text, spans
        out[pair] = one
    return out


def check(spark, turns):
    df = spark.createDataFrame([(*t, "extra", 1) for t in turns], SCHEMA + ", line string, at int")
    rows = preferences.segments(df, F.floor(F.col("conv_id") / 2), F.col("conv_id") % 2 == 0)
    got = {r.pair_id: r for r in preferences.paired(rows).collect()}
    want = plain(turns)
    assert set(got) == set(want)
    for pair, one in want.items():
        for name in ("prompt", "chosen", "rejected"):
            assert got[pair][name] == one[name]
        for name in ("chosen_spans", "rejected_spans"):
            assert [tuple(s) for s in got[pair][name] or []] == one[name]


def test_pairs_equal_plain_ones(spark):
    check(spark, TURNS)


def test_long_conversations_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(preferences, "CHUNK", 3)
    long = [(20 + side, i, "assistant" if i % 2 else "user", f"turn {i}" if i < 30 else f"{side} {i}") for side in (0, 1) for i in range(50)]
    check(spark, TURNS + long)


def test_no_turns(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert preferences.segments(df, F.col("conv_id"), F.col("conv_id") == 0).count() == 0
