"""Secret scans: candidates by pattern, and a random forest that tells secrets from look-alikes.

What the forest sees of a candidate: its length and letters, how its characters follow each other (changes of class, and
how usual the pairs are in the corpus' words), how much of it the corpus' dictionary covers, whether it is part of a
path, and the words next to it. It is trained on labelled findings. All of it runs on DataFrames and Spark's own
classifier.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed

BEFORE, AFTER = 60, 20
KEY_WORDS = "pass(word|wd|phrase)?|pwd|secret|token|api[ _-]?key|access[ _-]?key|private[ _-]?key|credential|auth|bearer"
#: Behind a key word and ``=`` or ``:``, white space on the line and an opening quote: what is assigned. The length in
#: front is bounded, as look-behinds must be.
ASSIGNED = rf"(?i:{KEY_WORDS})[\w-]{{0,20}}[\"']?[ \t]{{0,4}}[=:][ \t]{{0,4}}"
#: A candidate: a run of key characters of some length with a digit in it, perhaps with base64 padding; or whatever is
#: assigned to a key word: up to the closing quote, or to white space, a comma, semicolon or bracket if there is none.
#: The short look-behinds in front spare the long ones at nearly every character.
CANDIDATE = (
    rf"(?<=\")(?<={ASSIGNED}\")[^\"\n]+(?=\")|(?<=')(?<={ASSIGNED}')[^'\n]+(?=')|(?<=`)(?<={ASSIGNED}`)[^`\n]+(?=`)"
    rf"|(?<=[=:][ \t]{{0,4}})(?<={ASSIGNED})[^\s\"'`,;()\[\]{{}}<>=:](?:(?!&\w+=)[^\s\"'`,;()\[\]{{}}<>])*"
    r"|(?<![\p{L}\p{N}+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{12,}={0,2}(?![\p{L}\p{N}])"
)
#: Whole words, in the value or right before it.
SHAM_WORDS = r"(?<![a-z0-9])(examples?|sample|dummy|placeholder|changeme|redacted|fake|test|your)(?![a-z])"
#: A word of the corpus is in the dictionary if it is there so often.
DICTIONARY_TIMES = 5
#: The forest is fitted on at most so many labelled findings, those with the smallest hash.
MOST_LABELLED = 20_000
TREES, DEPTH = 24, 6
SEED = 7
SURE = 0.5
FEATURES = (
    "n_chars", "digit_share", "upper_share", "lower_share", "distinct_share", "class_changes", "pair_log", "coverage",
    "in_path", "slashes", "dashes", "key_word", "sham_word", "assigned", "quoted", "words_before",
)


def findings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every candidate of every row, written once: ``finding``, ``id``, ``start``, ``candidate``, ``before``, ``after``.

    ``start`` counts characters. Null and empty texts have none; of equal rows each has its own.
    """
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).filter(F.col("text").rlike(CANDIDATE))
    edge = lambda x: F.struct(F.length(x).alias("n"), F.right(x, F.lit(BEFORE)).alias("tail"), F.left(x, F.lit(AFTER)).alias("head"))
    rows = rows.select(
        "id", F.monotonically_increasing_id().alias("row"), F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"),
        F.transform(F.split("text", CANDIDATE, -1), edge).alias("edges"),
    )
    count = F.size("found")
    zipped = F.arrays_zip(
        F.col("found").alias("candidate"), F.slice("edges", F.lit(1), count).alias("left"), F.slice("edges", F.lit(2), count).alias("right")
    )
    each = rows.select("id", "row", F.posexplode(zipped).alias("at", "x")).select(
        "id", "row", "at", F.col("x.candidate").alias("candidate"), F.col("x.left.n").alias("gap"),
        F.col("x.left.tail").alias("before"), F.col("x.right.head").alias("after"),
    )
    earlier = Window.partitionBy("row").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum((F.col("gap") + F.length("candidate")).cast("bigint")).over(earlier)
    placed = each.withColumn("start", end - F.length("candidate"))
    return checkpointed(
        placed.select(F.monotonically_increasing_id().alias("finding"), "id", "start", "candidate", "before", "after")
    )


def dictionary(docs: DataFrame, text: str = "text", times: int = DICTIONARY_TIMES) -> DataFrame:
    """``word`` and ``n``: lower-case words of three or more letters a-z that the corpus has at least ``times`` times."""
    words = docs.select(F.explode(F.split(F.lower(text), r"[^\p{L}\p{N}]+")).alias("word"))
    return checkpointed(words.filter(F.col("word").rlike("^[a-z]{3,}$")).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= times))


def pair_logs(words: DataFrame) -> DataFrame:
    """``pair`` of letters and log10 of how often the second follows the first; at most 26 times 26 rows."""
    pairs = words.select("n", F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, F.lit(2)))).alias("pair"))
    counted = pairs.groupBy("pair").agg(F.sum("n").alias("n"))
    first = Window.partitionBy(F.left("pair", F.lit(1)))
    return counted.select("pair", F.log10(F.col("n") / F.sum("n").over(first)).alias("log"))


def _described(candidates: DataFrame, words: DataFrame) -> DataFrame:
    """Pair logs and dictionary coverage of each distinct candidate."""
    low = candidates.withColumn("low", F.lower("candidate"))
    pairs = low.select("candidate", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length("low") - 1, F.lit(1))), lambda i: F.substring("low", i, F.lit(2)))).alias("pair"))
    # At most 676 rows.
    logs = pairs.join(F.broadcast(pair_logs(words)), "pair", "left").groupBy("candidate").agg(F.avg(F.coalesce("log", F.lit(-4.0))).alias("pair_log"))
    runs = low.select("candidate", F.explode(F.regexp_extract_all("low", F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    covered = runs.join(words.select("word"), "word").groupBy("candidate").agg(F.sum(F.length("word")).alias("covered"))
    return logs.join(covered, "candidate", "left").select(
        "candidate", "pair_log", (F.coalesce("covered", F.lit(0)) / F.length("candidate")).alias("coverage")
    )


def described(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with the columns :data:`FEATURES`."""
    share = lambda pattern: F.length(F.regexp_replace("candidate", pattern, "")) / F.length("candidate")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace("candidate", "[a-z]", "a"), "[A-Z]", "B"), "[0-9]", "0")
    runs = F.length(F.regexp_replace(classes, r"(.)\1*", "x"))
    low = F.lower(F.concat("before", F.lit(" ")))
    yes = lambda c: c.cast("double")
    features = {
        "n_chars": F.length("candidate").cast("double"),
        "digit_share": share("[^0-9]"),
        "upper_share": share("[^A-Z]"),
        "lower_share": share("[^a-z]"),
        "distinct_share": F.size(F.array_distinct(F.split("candidate", ""))) / F.length("candidate"),
        "class_changes": (runs - 1) / F.length("candidate"),
        "in_path": yes(
            F.col("before").rlike(r"([/\\]|://\S*)$") | F.col("candidate").rlike("^//|/[^/]+/") | F.col("after").rlike(r"^[/\\.]\w")
        ),
        "slashes": F.length(F.regexp_replace("candidate", "[^/]", "")).cast("double"),
        "dashes": F.length(F.regexp_replace("candidate", "[^_-]", "")).cast("double"),
        "key_word": yes(low.rlike(rf"({KEY_WORDS})\W*(\w+\W+){{0,2}}$")),
        "sham_word": yes(F.lower("candidate").rlike(SHAM_WORDS) | F.lower("before").rlike(rf"{SHAM_WORDS}\W{{0,4}}$")),
        "assigned": yes(F.col("before").rlike(r"[=:]\s*[\"'`]?$")),
        "quoted": yes(F.col("before").rlike(r"[\"'`]$") & F.col("after").rlike(r"^[\"'`]")),
        "words_before": F.size(F.regexp_extract_all("before", F.lit(r"\p{L}+"), F.lit(0))).cast("double"),
    }
    return found.join(_described(found.select("candidate").distinct(), words), "candidate").withColumns(features)


def judged(rows: DataFrame, secret: Column, other: Column, most_labelled: int = MOST_LABELLED) -> DataFrame:
    """``rows`` with ``labelled`` (true, false, null), ``probability`` and ``is_secret``.

    ``secret`` and ``other`` tell the labelled findings, by any of the rows' columns; where both hold, the row is a secret.
    The forest is fitted on at most ``most_labelled`` of them, half of each kind at most, and judges all rows, labelled ones
    too. If only one kind is labelled, or none, nothing can be learned and every candidate counts as a secret.
    """
    label = F.when(secret, 1.0).when(other, 0.0)
    rows = checkpointed(rows.withColumn("label", label))
    order = F.xxhash64("candidate", "before", "after")
    parts = []
    for value in (0.0, 1.0):
        part = rows.filter(F.col("label") == value).select("label", *FEATURES, order.alias("order"))
        parts.append(part.orderBy("order", "n_chars").limit(most_labelled // 2))
    # So few rows are brought into one order in one partition, so that the forest is the same each time.
    sample = checkpointed(parts[0].union(parts[1]).repartition(1).sortWithinPartitions("order", *FEATURES))
    kinds = sample.select("label").distinct().count()
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    if kinds == 2:
        forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
        model = forest.fit(assembler.transform(sample))
        scored = model.setProbabilityCol("forest").transform(assembler.transform(rows))
        scored = scored.withColumn("probability", vector_to_array("forest")[1])
    else:
        scored = rows.withColumn("probability", F.lit(1.0))
    return scored.withColumn("is_secret", F.col("probability") >= SURE).withColumn("labelled", F.col("label") == 1.0)


def sure_secret() -> Column:
    """Findings that are secrets for certain: a provider's format, or the value given to a key word.

    A mere word behind a colon, without quotes, may as well go on a sentence.
    """
    key = rf"(?i)({KEY_WORDS})[\w-]*[\"']?\s*[=:]\s*[\"'`]?$"
    prose = F.col("before").rlike(r":\s*$") & F.col("candidate").rlike(r"^\p{L}+[.!?]*$")
    given = F.col("before").rlike(key) & ~prose
    return (F.col("candidate").rlike("^AKIA[0-9A-Z]{16}$") | given) & (F.col("sham_word") == 0)


def sure_other() -> Column:
    """Findings that are none for certain: numbers, words of the corpus, parts of a path, shams."""
    return F.col("candidate").rlike("^[0-9_-]+$") | (F.col("coverage") >= 0.6) | (F.col("in_path") == 1) | (F.col("sham_word") == 1)


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per candidate: ``key``, ``start``, ``end``, ``probability``, ``is_secret`` and ``labelled``.

    The labelled findings are those that :func:`sure_secret` and :func:`sure_other` decide. Null and empty texts have no
    rows; equal documents have equal rows; other columns are not read.
    """
    rows = described(findings(docs, key, text), dictionary(docs, text))
    end = (F.col("start") + F.length("candidate")).alias("end")
    return judged(rows, sure_secret(), sure_other()).select(F.col("id").alias(key), "start", end, "probability", "is_secret", "labelled")
