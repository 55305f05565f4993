"""As-of lookups and version intervals against a loop over the changes; hot keys included."""

import random

import pytest

from tidemark.operators import history


def changes_and_rows(seed):
    rng = random.Random(seed)
    changes = [(rng.choices(["a", "b", None], [6, 2, 1])[0], rng.choice("uuucd"), rng.choice([*range(0, 50, 2), None]), i,
                rng.choice([None, f"n{i}"]), rng.choice([None, i])) for i in range(80)]
    rows = [(rng.choices(["a", "b", "z", None], [6, 2, 1, 1])[0], rng.choice([None, *range(-2, 55)]), i) for i in range(150)]
    return changes, rows


def state_at(changes, key, time):
    """Name and size of a key after all changes up to a time, or None while it is deleted or unknown."""
    state = None
    for k, op, at, seq, name, size in sorted((c for c in changes if None not in (c[0], c[2])), key=lambda c: (c[2], c[3])):
        if k != key or at > time:
            continue
        if op == "d":
            state = None
        else:
            old = state or (None, None)
            state = (old[0] if name is None else name, old[1] if size is None else size)
    return state


CHANGES = "k STRING, op STRING, at BIGINT, seq INT, name STRING, size INT"


@pytest.mark.parametrize("hot_rows", [None, 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_rows_get_the_version_of_their_time(spark, hot_rows, seed):
    changes, rows = changes_and_rows(seed)
    df = spark.createDataFrame(rows, "k STRING, t BIGINT, name INT")
    got = history.asof_lookup(df, spark.createDataFrame(changes, CHANGES), "k", "t", ["name", "size"], ["at", "seq"], "d_", hot_rows)
    assert got.columns == ["k", "t", "name", "d_name", "d_size"]
    want = [(*r, *((None not in r[:2] and state_at(changes, r[0], r[1])) or (None, None))) for r in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("hot_rows", [None, 10])
def test_intervals_of_versions(spark, hot_rows):
    changes, _ = changes_and_rows(3)
    got = history.intervals(spark.createDataFrame(changes, CHANGES), "k", ["name", "size"], ["at", "seq"], hot_rows)
    want = []
    for key in "ab":
        times = sorted({c[2] for c in changes if c[0] == key and c[2] is not None})
        for at, to in zip(times, [*times[1:], None]):
            if (state := state_at(changes, key, at)) is not None:
                want.append((key, *state, at, to))
    assert got.columns == ["k", "name", "size", "valid_from", "valid_to"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_nothing_to_look_up(spark):
    changes, rows = changes_and_rows(1)
    df, dim = spark.createDataFrame(rows, "k STRING, t BIGINT, n INT"), spark.createDataFrame(changes, CHANGES)
    assert history.asof_lookup(df, dim.limit(0), "k", "t", ["name"], ["at"]).filter("name IS NULL").count() == len(rows)
    assert history.asof_lookup(df.limit(0), dim, "k", "t", ["name"], ["at"]).count() == 0
