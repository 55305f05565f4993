"""From MinHash signatures to components: banding, verification, and no pairs within large groups.

A unit is a distinct text (line or paragraph). Units that agree in a band of their signature share a bucket. Each is
first compared with the smallest unit of its bucket only, and what is similar becomes a component. What is left are
buckets with units of several components. In larger ones of these each unit is compared with another one of the bucket for a
few turns, until hardly any components are left to join. Then the sketches of all units of a bucket that are in different
components are compared; only in buckets of very many units similar pairs are found by exact prefix filtering instead. No
link between two units of one bucket is lost that way; a bucket of near copies, however large, gives a few comparisons per
unit, and one of many variants that are not similar gives hardly any.

Before two texts are brought together, their sketches are compared: a sketch has a bit for each of 1024 cells, which tells
whether the cell has an odd number of the unit's shingles. Two sets differ in at least as many shingles as their sketches
in bits, so a pair is passed over only if it cannot be similar. Cells must not be few against shingles: half of the bits
differ in any two sets of very many shingles, and no more tell of them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, looked_up, release, stored
from tidemark.llm.components import components

#: Larger buckets take turns first, so that a group of near copies does not give a pair for any two of them.
FEW_UNITS = 16
#: In buckets of more units than this, comparing all sketches would cost more than prefix filtering.
MANY_UNITS = 1 << 13
#: Turns in which the units of larger buckets are compared with one of them, at most.
TURNS = 4
#: Numbers of 64 bits that a sketch is made of.
SKETCH = tuple(f"s{i}" for i in range(16))
#: Numbers that a sketch is folded to for a first look.
FOLDED = 4


def recall(similarity: float, bands: int, rows: int) -> float:
    """Chance that two units of this similarity share a bucket."""
    return 1 - (1 - similarity**rows) ** bands


def tuned(threshold: float, least_recall: float, rows: int) -> int:
    """The fewest bands of ``rows`` that reach ``least_recall`` at the threshold."""
    bands = 1
    while recall(threshold, bands, rows) < least_recall:
        bands += 1
    return bands


def buckets(rows: DataFrame, once: bool = False) -> tuple[DataFrame, DataFrame]:
    """Buckets with two or more units: ``key``, ``node``, ``size``; and ``node``, ``h1``, ``h2`` of these units.

    ``rows`` has ``key``, ``h1``, ``h2`` and ``size`` of each unit and band; ``h1`` and ``h2`` name a unit, whose rows may
    repeat. ``once`` says that hardly any do, so that all are shuffled as they are, a single time. Else lone units, most of
    all, end in an aggregate.
    """
    if once:
        counted = rows.select("key", "h1", "h2", "size", F.count("*").over(Window.partitionBy("key")).alias("n"))
        members = checkpointed(counted.filter("n > 1").drop("n").distinct())
    else:
        shared = rows.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).filter("low != high")
        keys = checkpointed(shared.select("key"))
        release(rows.sparkSession)
        members = checkpointed(looked_up(rows, keys, ["key"]).distinct())
    release(rows.sparkSession)
    named = members.select("h1", "h2").distinct().withColumn("node", F.monotonically_increasing_id())
    named = checkpointed(named.select("node", "h1", "h2"))
    return checkpointed(members.join(named, ["h1", "h2"]).select("key", "node", "size")), named


def _sketched(units: DataFrame, shingles: Callable[[str], Column]) -> DataFrame:
    """``node``, the ``size`` of the shingle set and its sketch, of ``units`` with ``node`` and ``unit``."""
    each = units.select("node", F.explode_outer(shingles("unit")).alias("h"))
    # The lowest bits of a hash name the number, the highest six the bit of it.
    each = each.select("node", "h", F.expr("shiftleft(1L, cast(shiftrightunsigned(h, 58) AS int))").alias("bit"))
    numbers = [F.bit_xor(F.expr(f"CASE WHEN (h & {len(SKETCH) - 1}) = {i} THEN bit ELSE 0L END")).alias(name) for i, name in enumerate(SKETCH)]
    return each.groupBy("node").agg(F.count("h").cast("int").alias("size"), *numbers)


def _folded(side: str) -> list[Column]:
    """The sketch in fewer cells, each of which has the shingles of several: it is odd if an odd number of these are."""
    return [reduce(Column.bitwiseXOR, [F.col(f"{c}{side}") for c in SKETCH[i::FOLDED]]) for i in range(FOLDED)]


def _may_be_similar(left: list[Column], right: list[Column], threshold: float) -> Column:
    """Whether two sets may have this Jaccard similarity, by their sizes and sketches (``size``, then the sketch)."""
    both = left[0] + right[0]
    bits = reduce(Column.__add__, [F.bit_count(x.bitwiseXOR(y)) for x, y in zip(left[1:], right[1:])])
    apart = F.greatest(bits, F.abs(left[0] - right[0]))
    return both - apart >= threshold * (both + apart)


def _fitting(pairs: DataFrame, units: DataFrame, threshold: float) -> DataFrame:
    """The ``pairs`` that sizes and sketches of ``units`` do not rule out; most go at a first look, with folded sketches."""
    folded = units.select("node", "size", *[c.alias(f"f{i}") for i, c in enumerate(_folded(""))])
    for known, figures in ((folded, ["size", *[f"f{i}" for i in range(FOLDED)]]), (units, ["size", *SKETCH])):
        a = known.select(F.col("node").alias("a"), *[F.col(c).alias(f"{c}_a") for c in figures])
        b = known.select(F.col("node").alias("b"), *[F.col(c).alias(f"{c}_b") for c in figures])
        left, right = ([F.col(f"{c}_{side}") for c in figures] for side in "ab")
        pairs = pairs.join(a, "a").join(b, "b").filter(_may_be_similar(left, right, threshold)).select(pairs.columns)
    return pairs


def _similar(pairs: DataFrame, units: DataFrame, shingles: Callable[[str], Column], threshold: float) -> DataFrame:
    """The ``pairs`` whose shingle sets have at least this Jaccard similarity; ``units`` has ``node`` and ``unit``.

    The units are moved to the pairs, not their sets, which are many times as large.
    """
    a = units.select(F.col("node").alias("a"), F.col("unit").alias("ua"))
    b = units.select(F.col("node").alias("b"), F.col("unit").alias("ub"))
    # As arrays of one, so that each set and what they share is made once.
    sets = F.array(F.struct(shingles("ua").alias("a"), shingles("ub").alias("b")))
    counts = F.transform(sets, lambda s: F.struct(F.size(F.array_intersect(s["a"], s["b"])).alias("both"), (F.size(s["a"]) + F.size(s["b"])).alias("all")))
    near = F.exists(counts, lambda n: n["both"] >= threshold * (n["all"] - n["both"]))
    return pairs.join(a, "a").join(b, "b").filter(near).select(pairs.columns)


def linked(
    rows: DataFrame, units_of: Callable[[DataFrame], DataFrame], shingles: Callable[[str], Column], threshold: float,
    once: bool = False,
) -> DataFrame:
    """``h1``, ``h2`` and ``component`` of every unit similar to another one of its buckets, chains included.

    ``rows`` and ``once`` are as in :func:`buckets`, ``size`` that of the unit's shingle set, or one for all; ``units_of`` turns a table of ``node``, ``h1`` and ``h2`` into ``node``
    and ``unit``, whose set is ``shingles`` of the column. It is asked once, for all units that share a bucket.
    """
    in_buckets, named = buckets(rows, once)
    units = stored(units_of(named))
    release(rows.sparkSession)
    sketches = stored(_sketched(units, shingles))
    release(rows.sparkSession)
    fits = lambda x, y: F.least(x, y) >= threshold * F.greatest(x, y)
    fitting = lambda pairs: checkpointed(_fitting(pairs, sketches, threshold))
    similar = lambda pairs: checkpointed(_similar(fitting(pairs), units, shingles, threshold))
    in_components = lambda found: named.join(found, "node").select("h1", "h2", "component")
    first = in_buckets.groupBy("key").agg(F.min("node").alias("a"))
    # The representative's size comes with it from the bucket itself.
    heads = in_buckets.join(first, "key").filter("node = a").select("key", "a", F.col("size").alias("size_a"))
    star = in_buckets.join(heads, "key").filter((F.col("node") != F.col("a")) & fits(F.col("size"), F.col("size_a")))
    star = star.select("a", F.col("node").alias("b")).distinct()
    near = similar(star)
    release(rows.sparkSession)
    found = components(near)

    placed = in_buckets.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = checkpointed(_mixed(placed))
    release(rows.sparkSession)
    if mixed.isEmpty():
        return in_components(found)
    crowded, joined = _in_turns(mixed.filter(F.col("units") > FEW_UNITS).select("key", "units", "node", "component"), similar)
    near = reduce(DataFrame.union, joined, near)
    few = mixed.filter(F.col("units") <= FEW_UNITS).select("key", "units", "node", "component").union(crowded)
    rest = _in_buckets(few.filter(F.col("units") <= MANY_UNITS), sketches, threshold)
    many = checkpointed(crowded.filter(F.col("units") > MANY_UNITS).select("node", "component").distinct())
    if not many.isEmpty():
        rest = rest.union(_by_prefix(units, sketches.join(many, "node"), shingles, threshold)).distinct()
    rest = checkpointed(rest)
    release(rows.sparkSession)
    rest = checkpointed(_similar(rest, units, shingles, threshold))
    release(rows.sparkSession)
    if not joined and rest.isEmpty():
        return in_components(found)
    return in_components(components(near.union(rest)))


def _mixed(placed: DataFrame) -> DataFrame:
    """``key``, ``units`` (their number), ``node`` and ``component`` of the buckets with units of several components."""
    spread = placed.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("units")
    ).filter("low != high")
    return placed.join(spread.select("key", "units"), "key").select("key", "units", "node", "component")


def _in_turns(crowded: DataFrame, similar: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, list[DataFrame]]:
    """The units with their components after some turns, and the similar pairs of each turn.

    In a turn every bucket names one of its units, another one each time, and those of other components are compared with it.
    """
    joined: list[DataFrame] = []
    for turn in range(TURNS):
        one = F.min(F.struct(F.xxhash64(F.lit(turn), "key", "node").alias("by"), "node", "component")).alias("one")
        named = crowded.groupBy("key").agg(one).select("key", F.col("one.node").alias("a"), F.col("one.component").alias("c"))
        pairs = crowded.join(named, "key").filter("component != c").select("a", F.col("node").alias("b"), "c", "component").distinct()
        near = similar(pairs)
        if near.isEmpty():
            break
        joined.append(near.select("a", "b"))
        moved = components(near, "c", "component").toDF("component", "moved")
        crowded = crowded.join(moved, "component", "left").select("key", "units", "node", F.coalesce("moved", "component").alias("component"))
        crowded = checkpointed(crowded)
        release(crowded.sparkSession)
    return crowded, joined


def _in_buckets(mixed: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """Pairs of ``node`` in different components of one bucket that sizes and sketches do not rule out."""
    # Turns may have left a bucket with one component.
    spread = mixed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low != high")
    placed = mixed.drop("units").join(spread.select("key"), "key").join(sketches, "node")
    return placed.join(_others(placed, "key"), "key").filter(_apart_and_near(threshold)).select(F.col("node").alias("a"), "b").distinct()


def _others(rows: DataFrame, on: str) -> DataFrame:
    """The same rows under other names, ``b`` for ``node``, to be joined with themselves."""
    return rows.select(on, F.col("node").alias("b"), *[F.col(c).alias(f"{c}_b") for c in rows.columns if c not in (on, "node")])


def _apart_and_near(threshold: float) -> Column:
    """For two rows of a self-join: in different components, each pair once, and not ruled out by sizes and sketches."""
    figures = ["size", *SKETCH]
    near = _may_be_similar([F.col(c) for c in figures], [F.col(f"{c}_b") for c in figures], threshold)
    return (F.col("node") < F.col("b")) & (F.col("component") != F.col("component_b")) & near


def _by_prefix(units: DataFrame, many: DataFrame, shingles: Callable[[str], Column], threshold: float) -> DataFrame:
    """Pairs of ``node`` in different components that may be similar, by prefix filtering; ``many`` has their sketches.

    Two sets of this Jaccard similarity share one of their rarest shingles: of n, those that are left when all but
    threshold times n are taken away, and one more. Rarest comes first, so variants of one text, each with shingles of its
    own, do not meet. Shingles that one set alone has take places in front, and only their number is kept. Sets that meet
    are a pair only if their sketches are near.
    """
    each = units.join(many.select("node"), "node").select("node", F.explode(shingles("unit")).alias("shingle"))
    shared = each.groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1")
    ranked = each.join(shared, "shingle").groupBy("node").agg(
        F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("ranked")
    )
    size = F.col("size")
    left = size - F.ceil(size * threshold - 1e-9).cast("int") + 1 - (size - F.size("ranked"))
    first = ranked.join(many, "node").withColumn("left", left).filter("left > 0")
    first = first.select("node", "component", "size", *SKETCH, F.explode(F.slice("ranked", F.lit(1), F.col("left"))).alias("x"))
    first = first.withColumn("shingle", F.col("x.shingle")).drop("x")
    pairs = first.join(_others(first, "shingle"), "shingle").filter(_apart_and_near(threshold))
    return pairs.select(F.col("node").alias("a"), "b").distinct()


def members(
    found: DataFrame, near: DataFrame, key: str, at: str, wanted: Callable[[DataFrame], DataFrame] = lambda placed: placed
) -> DataFrame:
    """Places whose unit repeats or is similar to another, with ``component`` and ``kept``; the others are left out.

    ``found`` has ``id``, ``tie``, the place ``at`` in the text, and ``h1`` and ``h2`` of the unit; ``near`` is the result of
    :func:`linked`. ``wanted`` may leave out some of these places before components are looked at. Of a component the place with the smallest id stays (a null id is the largest), of several the one
    with the smallest ``tie``, then the first in the text.
    """
    # Copies are one unit. Units that repeat or have a partner are few, and only their places are moved on.
    several = found.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1")
    alone = F.xxhash64("h1", "h2").bitwiseOR(F.lit(-(1 << 63)))
    copies = several.join(near, ["h1", "h2"], "full").select("h1", "h2", F.coalesce("component", alone).alias("component"))
    placed = found.join(checkpointed(copies), ["h1", "h2"]).drop("h1", "h2").distinct()
    placed = checkpointed(wanted(placed))
    place = lambda: F.struct(F.col("id").isNull().alias("unnamed"), "id", "tie", at)
    first = placed.groupBy("component").agg(F.min(place()).alias("first"), F.count("*").alias("n")).filter("n > 1")
    marked = placed.join(first.drop("n"), "component").withColumn("kept", place().eqNullSafe(F.col("first")))
    return marked.drop("first").withColumnRenamed("id", key)
