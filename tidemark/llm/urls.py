"""URL filters: lists of host and path rules, and rules mined from labelled URLs.

URLs are baskets of tokens. FP-growth mines the combinations that are frequent among labelled URLs, together with the
label. A combination becomes a blocking rule if enough of the URLs with it are bad (confidence), and no smaller
combination in it is as sure. Tokens that stand in exactly the same URLs are mined as one, so that a long URL that is
there a few times gives no more combinations than a short one. Rules are matched by an inverted index: a rule is filed under its rarest token, a URL
looks up its own tokens, and only the rules found there are compared with the whole URL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, free_name, lower_ascii

BAD = "=bad"
#: A rule has at least so many URLs, the same at every size. A share of all would lose bad hosts as data grow.
MIN_SUPPORT = 0.0
MIN_URLS = 5
#: A rule blocks if this share of its URLs is bad, and this many times the share among all.
MIN_CONFIDENCE = 0.5
MIN_LIFT = 2.0
#: The share is the lower end of Wilson's interval at so many standard deviations, so that few URLs need a higher one.
CERTAIN = 1.645


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; without it empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty where there is no host part."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null where none does.

    A rule is a host and the start of a path, such as ``example.com/en/``; it fits the host and its subdomains. Of
    equally long rules the first by name wins. ``rules`` is a list written by hand and becomes one CASE expression.
    """
    rule = verdict = None
    for name, what in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        own, slash, rest = name.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        rule = F.when(fits, name) if rule is None else rule.when(fits, name)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    return (F.lit(None).cast("string"), F.lit(None).cast("string")) if rule is None else (rule, verdict)


def tokens(url: Column) -> Column:
    """The distinct tokens of a URL: scheme, host labels, whole domain, path segments and query keys.

    A number in a path counts as ``#``, its length apart, since single pages are no pattern.
    """
    hosts = F.split(host(url), r"\.")
    parts = F.filter(F.split(path(url), "/"), lambda x: x != "")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda x: F.split_part(x, F.lit("="), F.lit(1))), lambda x: x != "")
    named = lambda kind, items: F.transform(items, lambda x: F.concat(F.lit(kind), x))
    return F.array_distinct(
        F.concat(
            F.array(F.concat(F.lit("s:"), F.lower(F.regexp_extract(url, r"^([A-Za-z][\w+.-]*)://", 1)))),
            F.array(F.concat(F.lit("d:"), host(url))),
            named("h:", F.filter(hosts, lambda x: x != "")),
            named("p:", F.transform(parts, lambda x: F.regexp_replace(x, r"\d+", "#"))),
            named("q:", keys),
        )
    )


def mined(
    labelled: DataFrame, url: str = "url", bad: str = "bad", min_support: float = MIN_SUPPORT, min_urls: int = MIN_URLS,
    min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT, certain: float = 0.0,
) -> DataFrame:
    """Blocking rules from labelled URLs: ``items``, ``rule``, ``confidence``, ``lift`` and ``urls`` (how many fit).

    All labelled rows count, repeated ones as often as they are there. Rows without a URL or label are left out. No
    labelled rows, or no bad ones, give no rules. Confidence is the plain share; ``certain`` above 0 also asks its lower
    bound to reach ``min_confidence``. Which rules come out does not depend on how the rows are dealt.
    """
    known = labelled.filter(F.col(url).contains("://") & F.col(bad).isNotNull())
    baskets = known.select(
        F.when(F.col(bad), F.array_append(tokens(F.col(url)), F.lit(BAD))).otherwise(tokens(F.col(url))).alias("items")
    )
    baskets = checkpointed(baskets.withColumn("row", F.monotonically_increasing_id()))
    rows, wrong = baskets.agg(F.count("*"), F.count_if(F.array_contains("items", BAD))).first()
    spark = labelled.sparkSession
    if not wrong:
        return spark.createDataFrame([], "items array<string>, rule string, confidence double, lift double, urls bigint")
    least = max(min_support * rows, min_urls)
    alike = checkpointed(_alike(baskets, least * min_confidence))
    baskets = checkpointed(_merged(baskets, alike))
    # A combination that is frequent enough among the bad ones; how many others have it is counted afterwards.
    model = FPGrowth(minSupport=min(1.0, least * min_confidence / rows), minConfidence=1e-9).fit(baskets)
    found = model.freqItemsets
    with_bad = found.filter(F.array_contains("items", BAD) & (F.size("items") > 1)).select(
        F.array_sort(F.array_remove("items", BAD)).alias("items"), F.col("freq").alias("bad_urls")
    )
    urls = found.select(F.array_sort("items").alias("items"), F.col("freq").alias("urls"))
    sure = F.col("bad_urls") / F.col("urls")
    rules = with_bad.join(urls, "items").withColumn("confidence", sure).withColumn("lift", sure * rows / wrong)
    rules = rules.filter(
        (F.col("urls") >= least) & (F.col("confidence") >= min_confidence) & (F.col("lift") >= min_lift)
        & ((lower_bound(sure, F.col("urls"), certain) >= min_confidence) if certain else F.lit(True))
    )
    rules = checkpointed(
        rules.select("items", F.array_join("items", " ").alias("rule"), "confidence", "lift", "urls")
    )
    return checkpointed(_spelled_out(_without_implied(rules), alike))


def _alike(baskets: DataFrame, least: float) -> DataFrame:
    """Tokens of at least ``least`` URLs in groups that stand in the same URLs: ``token`` (the first) and ``tokens``.

    Groups are told by how many URLs they have and by two sums of hashes of these.
    """
    each = baskets.select("row", F.explode("items").alias("token"))
    # Sums of 64-bit hashes in 38-digit decimals neither overflow nor depend on the order of rows.
    total = lambda seed: F.sum(F.xxhash64("row", F.lit(seed)).cast("decimal(20,0)"))
    where = each.groupBy("token").agg(F.count("*").alias("n"), total(1).alias("one"), total(2).alias("two"))
    same = where.filter(F.col("n") >= least).groupBy("n", "one", "two", F.col("token") == BAD)
    return same.agg(F.array_sort(F.collect_list("token")).alias("tokens")).select(F.col("tokens")[0].alias("token"), "tokens")


def _merged(baskets: DataFrame, alike: DataFrame) -> DataFrame:
    """The baskets with the first token of each group only; tokens of too few URLs are left out."""
    each = baskets.select("row", F.explode("items").alias("token")).join(alike.select("token"), "token")
    return each.groupBy("row").agg(F.collect_list("token").alias("items")).select("items")


def _spelled_out(rules: DataFrame, alike: DataFrame) -> DataFrame:
    """Rules of groups as rules of tokens: one for each choice of a token per group, all equally sure.

    No rule needs two tokens of a group, as one of them fits the same URLs.
    """
    groups = rules.select("rule", F.explode("items").alias("token")).join(alike, "token")
    groups = groups.groupBy("rule").agg(F.collect_list("tokens").alias("groups"))
    choices = F.aggregate(
        "groups", F.array(F.array().cast("array<string>")),
        lambda made, group: F.flatten(F.transform(made, lambda one: F.transform(group, lambda token: F.array_append(one, token)))),
    )
    spelled = groups.select("rule", F.explode(choices).alias("items")).withColumn("items", F.array_sort("items"))
    rest = rules.drop("items").join(spelled, "rule")
    return rest.select("items", F.array_join("items", " ").alias("rule"), "confidence", "lift", "urls")


def lower_bound(share: Column, n: Column, deviations: float) -> Column:
    """The lower end of Wilson's interval for a share of ``n``."""
    z = deviations * deviations
    spread = deviations * F.sqrt(share * (1 - share) / n + z / (4 * n * n))
    return (share + z / (2 * n) - spread) / (1 + z / n)


def _without_implied(rules: DataFrame) -> DataFrame:
    """The rules that no rule with fewer tokens, all of them among theirs, matches in confidence.

    The smaller rule of a pair is looked up by its first token among the tokens of the larger one.
    """
    larger = rules.select("rule", "items", "confidence", F.explode("items").alias("token"))
    smaller = rules.select(
        F.col("items")[0].alias("token"), F.col("items").alias("less"), F.col("confidence").alias("as_sure")
    )
    implied = larger.join(smaller, "token").filter(
        (F.size("less") < F.size("items")) & (F.col("as_sure") >= F.col("confidence"))
        & (F.size(F.array_except("less", "items")) == 0)
    )
    return rules.join(implied.select("rule").distinct(), "rule", "left_anti")


def matches(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """For each distinct URL that a rule fits: the surest rule (then the longest, then by name) and its confidence."""
    each = rules.select("rule", F.explode("items").alias("token"))
    often = each.groupBy("token").agg(F.count("*").alias("n"))
    filed = each.join(often, "token").groupBy("rule").agg(F.min_by("token", F.struct("n", "token")).alias("token"))
    index = rules.join(filed, "rule").select("token", "rule", "items", "confidence")
    distinct = urls.select(F.col(url).alias("url")).filter(F.col("url").isNotNull()).distinct()
    own = distinct.withColumn("tokens", tokens(F.col("url"))).withColumn("token", F.explode("tokens"))
    fits = own.join(index, "token").filter(F.size(F.array_except("items", "tokens")) == 0)
    order = F.struct(F.col("confidence"), F.size("items"), F.col("rule"))
    return fits.groupBy("url").agg(F.max(order).alias("best")).select(
        F.col("url").alias(url), F.col("best.rule").alias("mined_rule"), F.col("best.confidence").alias("confidence")
    )


def judged(pages: DataFrame, mined_rules: DataFrame, rules: Sequence[tuple[str, str]], url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict``, ``mined_rule`` and ``confidence``, one row per row.

    The listed rule decides; where none fits, a URL is blocked if a mined rule fits it and allowed otherwise. A null URL,
    or one without ``://``, has an empty host and path and is allowed. Columns of these names are replaced.
    """
    added = ("host", "path", "rule", "verdict", "mined_rule", "confidence")
    rows = pages.drop(*added).withColumn("host", host(F.col(url))).withColumn("path", path(F.col(url)))
    rule, what = listed(F.col("host"), F.col("path"), rules)
    mark = free_name(rows, "_listed")
    rows = rows.withColumn("rule", rule).withColumn(mark, what)
    open_urls = rows.filter(F.col("rule").isNull())
    found = matches(open_urls, mined_rules, url)
    # Only URLs that the list leaves open are looked up; the others are spread as they come.
    looked = rows.join(found, url, "left")
    left_open = F.col("rule").isNull()
    return (
        looked.withColumn("mined_rule", F.when(left_open, F.col("mined_rule")))
        .withColumn("confidence", F.when(left_open, F.col("confidence")))
        .withColumn("verdict", F.coalesce(F.col(mark), F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")))
        .drop(mark)
    )
