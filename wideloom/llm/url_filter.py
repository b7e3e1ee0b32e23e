"""URL filters: stated host rules first, mined association rules for the rest.

Spark's FP-growth mines combinations of URL tokens from labelled URLs.  Combinations that contain
the label become rules when their support and confidence suffice and no rule on fewer of their
tokens is as confident.  Rules are matched through an inverted index: each is filed under its
rarest token, joined with the tokens of the distinct token sets, and checked in full.

Before mining, tokens that are in every URL or in too few are dropped, and tokens that occur in
exactly the same URLs are merged into one, which changes no support but keeps a large group of
equal URLs from having exponentially many combinations.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wideloom.llm.common import prepared, small, stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LABEL = "=block"


@dataclass(frozen=True)
class HostRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: str | Column = "url") -> tuple[Column, Column]:
    """Lower-cased host (after the first ``://``) and path; both empty without ``://`` or for null."""
    u = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    mark = F.instr(u, "://")
    rest = F.when(mark > 0, F.substring(u, mark + 3, F.length(u))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def longest_rule(rules: Sequence[HostRule], host: str = "host", path: str = "path") -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, null without one.  The list is a parameter."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((F.col(host) == r.host) | F.endswith(F.col(host), F.lit("." + r.host))) & F.startswith(F.col(path), F.lit(r.path))
        text = F.when(fits, F.lit(r.text)).otherwise(text)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def url_tokens(url: str | Column = "url", host: str = "host", path: str = "path") -> Column:
    """Sorted distinct tokens: scheme, host labels, path parts (digits as #), query keys, fragment."""
    u = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    named = lambda kind, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))
    plain = F.regexp_extract(u, r"^([^#]*)", 1)
    asked = F.regexp_extract(plain, r"(?s)\?(.*)", 1)
    keys = F.transform(F.split(asked, "&"), lambda x: F.regexp_extract(x, r"(?s)^([^=]*)", 1))
    return F.array_sort(F.array_distinct(F.concat(
        named("scheme:", F.array(F.regexp_extract(u, r"(?s)^(.*?)://", 1))),
        named("host:", F.split(F.col(host), r"\.")),
        named("path:", F.split(F.regexp_replace(F.col(path), "[0-9]+", "#"), "/")),
        named("query:", keys),
        F.when(F.instr(u, "#") > 0, F.array(F.lit("fragment:"))).otherwise(F.array().cast("array<string>")))))


def mine_rules(labelled: DataFrame, tokens: str = "tokens", label: str = "block", min_support: float = 0.002,
               min_confidence: float = 0.5) -> DataFrame:
    """(rule, tokens, rarest, support, confidence) from distinct token arrays and a 0/1 label.

    ``min_support`` is the share of the labelled rows that have all tokens and the label.  The number
    of rows is bounded by it, not by the table.  Rows without a label are ignored; without any
    labelled row, or any of label 1, there are no rules.
    """
    spark = prepared(labelled.sparkSession)
    rows = stored(labelled.where(F.col(label).isin(0, 1)).select(
        F.col(tokens).alias("tokens"), F.col(label).cast("int").alias("y"), F.monotonically_increasing_id().alias("row")),
        "url-labelled")
    n = rows.count()
    none = spark.createDataFrame([], "rule string, tokens array<string>, rarest string, support double, confidence double")
    if not n:
        return none
    least = min_support * n
    seen = (rows.select("row", F.explode("tokens").alias("token")).groupBy("token")
            .agg(F.count("*").alias("n"), F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("print"))
            .where((F.col("n") >= least) & (F.col("n") < n)))
    merged = stored(seen.groupBy("n", "print").agg(F.min("token").alias("token"), F.sort_array(F.collect_list("token")).alias("same"))
                    .select("token", "n", "same"), "url-tokens")  # at most tokens-per-row / min_support rows
    kept = (rows.select("row", "y", F.explode("tokens").alias("token")).join(small(merged.select("token")), "token")
            .groupBy("row", "y").agg(F.collect_set("token").alias("items"))
            .select(F.when(F.col("y") == 1, F.array_append("items", F.lit(LABEL))).otherwise(F.col("items")).alias("items")))
    found = stored(FPGrowth(itemsCol="items", minSupport=min(1.0, least / max(1, kept.count())), minConfidence=0.0)
                   .fit(kept).freqItemsets, "url-itemsets") if not merged.isEmpty() else None
    if found is None:
        return none
    plain = found.where(~F.array_contains("items", LABEL)).select(F.array_sort("items").alias("key"), F.col("freq").alias("all"))
    both = found.where(F.array_contains("items", LABEL) & (F.size("items") > 1)).select(
        F.array_sort(F.array_remove("items", LABEL)).alias("key"), "freq")
    rules = stored(both.join(plain, "key").select("key", (F.col("freq") / F.lit(n)).alias("support"),
                                                  (F.col("freq") / F.col("all")).alias("confidence"))
                   .where(F.col("confidence") >= min_confidence), "url-rules")
    # A rule is redundant when one of its tokens can go without loss of confidence.
    fewer = rules.select("key", "confidence", F.explode("key").alias("gone")).select(
        F.col("key").alias("whole"), "confidence", F.array_remove("key", F.col("gone")).alias("part"))
    shorter = rules.select(F.col("key").alias("part"), F.col("confidence").alias("less"))
    beaten = fewer.join(shorter, "part").where("less >= confidence").select(F.col("whole").alias("key")).distinct()
    alone = rules.join(beaten, "key", "left_anti")
    spread = alone.select("key", "support", "confidence", F.explode("key").alias("token")).join(merged, "token")
    return spread.groupBy("key", "support", "confidence").agg(
        F.sort_array(F.flatten(F.collect_list("same"))).alias("tokens"), F.min(F.struct("n", "token")).alias("least")).select(
        F.array_join("key", " ").alias("rule"), "tokens", F.col("least.token").alias("rarest"), "support", "confidence")


def matched(sets: DataFrame, rules: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(tokens, rule, confidence): the most confident rule of each distinct token set that fits one."""
    r = rules.select("rule", F.col("tokens").alias("needed"), F.col("rarest").alias("token"), "support", "confidence")
    each = sets.select(F.col(tokens).alias("tokens")).distinct()
    return (each.withColumn("token", F.explode("tokens")).join(small(r), "token")
            .where(F.size(F.array_except("needed", "tokens")) == 0)
            .groupBy("tokens").agg(F.max(F.struct("confidence", "support", "rule")).alias("best"))
            .select("tokens", "best.rule", "best.confidence"))


def filtered(pages: DataFrame, rules: Sequence[HostRule], labelled: DataFrame, key: str = "page_id", url: str = "url",
             min_support: float = 0.002, min_confidence: float = 0.5) -> DataFrame:
    """(key, host, path, rule, verdict, mined): one row per row of ``pages``.

    ``labelled`` has the columns url and block (0 or 1).  A stated rule decides where one fits;
    elsewhere a mined rule blocks (``mined`` names its tokens), and everything else is allowed.
    """
    def parsed(df: DataFrame, *keep: Column) -> DataFrame:
        host, path = host_and_path(F.col(url))
        return df.select(*keep, F.col(url).alias("url"), host.alias("host"), path.alias("path")).withColumn(
            "tokens", url_tokens("url"))

    mined = stored(mine_rules(parsed(labelled, F.col("block")), "tokens", "block", min_support, min_confidence), "url-mined")
    rows = parsed(pages, F.col(key)).drop("url")
    text, verdict = longest_rule(rules)
    hits = matched(rows, mined).select(F.col("tokens"), F.col("rule").alias("mined"))
    return (rows.withColumn("rule", text).withColumn("stated", verdict).join(small(hits), "tokens", "left")
            .select(key, "host", "path", "rule",
                    F.coalesce("stated", F.when(F.col("mined").isNotNull(), "block").otherwise("allow")).alias("verdict"),
                    F.when(F.col("stated").isNull(), F.col("mined")).alias("mined")))
