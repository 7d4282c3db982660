"""URL filter: rules first, else the ratio of two character language models.

Two smoothed variable-order Markov models are counted, one over the URLs that the rules allow and one over those they
block. A character's probability mixes the orders from `ORDER` down to none: the count of (context, character) plus
`WEIGHT` times the next lower order's probability, over the count of the context plus `WEIGHT`; below all orders every
character is equally likely. A URL that no rule fits is judged by the difference of its two log-likelihoods per
character, against a threshold calibrated on a fifth of the ruled URLs, which the models do not count: the value between
the means of its two classes. With only one class of ruled URLs there is no ratio and that class is the verdict;
with none at all, everything is allowed.

Everything is DataFrame functions. Missing URLs and those without `://` have an empty host and path and no rule, and
are judged by their whole text (a missing one is empty: difference 0, allowed unless the threshold is above 0).
Repeated rows are judged each; other columns are kept out; the model covers all characters of all URLs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import checkpointed

ORDER = 3
WEIGHT = 2.0
ALPHABET = 256.0
CALIBRATE = 5      # one in so many ruled URLs calibrates and is not counted
START = "\u0002"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("com", "/", True), Rule("example.com", "/en/", False), Rule("www.example.com", "/en/", True),
         Rule("net", "/es/", False), Rule("net", "/fr/", False))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(lower_ascii(after), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """The longest rule that fits, as a struct of its name and whether it allows; else null."""
    found = F.lit(None).cast("struct<name:string,allow:boolean>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.allow).alias("allow"))).otherwise(found)
    return found


def _characters(urls: DataFrame, order: int) -> DataFrame:
    """A row for every character (UTF-16 unit) of every URL, with the `order` characters before it, as bytes: units have a
    fixed width, so that cutting one does not depend on its place and a long URL costs as much a character as a short one."""
    data = F.encode(F.concat(F.lit(START * order), F.col("url")), "UTF-16BE")
    places = F.when(F.length("url") > 0, F.sequence(F.lit(1), F.length("data") - 2 * order, F.lit(2)))
    spread = urls.withColumn("data", data).withColumn("place", F.explode(places))
    return spread.select(*[c for c in urls.columns if c != "url"],
                         F.substring("data", F.col("place"), F.lit(2 * order)).alias("before"),
                         F.substring("data", F.col("place") + 2 * order, F.lit(2)).alias("letter"))


def _gains(characters: DataFrame, order: int) -> DataFrame:
    """For every context and letter seen the difference of the two models' log-probabilities, all orders mixed.

    Characters are counted once, with the longest context; shorter ones are sums of those counts. These tables have a row for
    every string of at most `order` + 1 characters that occurs, which is little beside the input."""
    counts = [checkpointed(characters.groupBy(F.col("before").alias("context"), "letter").agg(
        F.count_if(F.col("allow") & F.col("count_it")).alias("yes_n"), F.count_if(~F.col("allow") & F.col("count_it")).alias("no_n")))]
    shorter = F.substring("context", F.lit(3), F.lit(2 * order))
    for _ in range(order):
        counts.append(counts[-1].groupBy(shorter.alias("context"), "letter").agg(F.sum("yes_n").alias("yes_n"), F.sum("no_n").alias("no_n")))
    below = None
    for level in reversed(counts):
        whole = Window.partitionBy("context")  # a row a letter; without a context there are as many rows as letters
        level = level.withColumns({"yes_all": F.sum("yes_n").over(whole), "no_all": F.sum("no_n").over(whole)})
        if below is None:
            level = level.withColumns({"yes": F.lit(1.0 / ALPHABET), "no": F.lit(1.0 / ALPHABET)})
        else:
            level = level.withColumn("short", shorter).join(below.withColumnRenamed("context", "short"), ["short", "letter"])
        below = level.select("context", "letter", *[((F.col(f"{c}_n") + WEIGHT * F.col(c)) / (F.col(f"{c}_all") + WEIGHT)).alias(c)
                                                    for c in ("yes", "no")])
    return below.select(F.col("context").alias("before"), "letter", (F.log("yes") - F.log("no")).alias("gain"))


def judge(df: DataFrame, rules: Sequence[Rule] = RULES, order: int = ORDER, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """A row for each URL: id, host, path, rule (or null), verdict, and `score`, the calibrated difference of
    log-likelihoods per character (above 0: more like the allowed ones)."""
    urls = df.select(df[id_col].alias("id"), F.coalesce(df[url_col].cast("string"), F.lit("")).alias("url"))
    urls = urls.select("id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = urls.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    # equal URLs are counted and judged once, with their number as weight of the calibration
    distinct = ruled.groupBy("url").agg(F.first("rule.allow").alias("allow"), F.count(F.lit(1)).alias("copies"))
    distinct = distinct.withColumn("count_it", F.pmod(F.xxhash64("url"), F.lit(CALIBRATE)) != 0)
    # a number stands for the URL beside its characters; the checkpoint keeps it
    distinct = checkpointed(distinct.withColumn("number", F.monotonically_increasing_id()))
    letters = _characters(distinct, order)
    gains = _gains(letters, order)
    scored = checkpointed(letters.filter(F.col("allow").isNull() | ~F.col("count_it")).join(gains, ["before", "letter"])
              .groupBy("number").agg(F.avg("gain").alias("difference"), F.first("allow").alias("allow"),
                                                       F.first("copies").alias("copies")))

    def mean(allowed: bool) -> Column:
        mine = F.col("allow") == F.lit(allowed)
        return F.try_divide(F.sum(F.when(mine, F.col("difference") * F.col("copies"))), F.sum(F.when(mine, F.col("copies"))))

    middle = scored.agg(((mean(True) + mean(False)) / 2).alias("middle"))  # one row
    differences = scored.filter(F.col("allow").isNull()).select("number", "difference").join(distinct.select("number", "url"), "number").drop("number")
    judged = ruled.join(differences, "url", "left")
    score = F.coalesce(F.col("difference"), F.lit(0.0)) - F.coalesce(middle.scalar(), F.lit(0.0))
    only = distinct.agg(F.when(F.min("allow") == F.max("allow"), F.min("allow"))).scalar()
    liked = F.coalesce(only, score >= 0)
    allowed = F.coalesce(F.col("rule.allow"), liked)
    return judged.select(F.col("id").alias(id_col), "host", "path", F.col("rule.name").alias("rule"),
                         F.when(allowed, F.lit("allow")).otherwise(F.lit("block")).alias("verdict"),
                         F.when(F.col("rule").isNull(), score).alias("score"))
