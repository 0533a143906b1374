"""URL filters: the longest allow or block rule of every url, by a sorted sweep.

Canonical keys. A host's labels are reversed, so all hosts below a domain share a
prefix, and the path follows after a ``#`` (which neither can hold). A rule
(host, path) is then the interval of all keys that begin with its own key. A rule
also fits subdomains, so a url has one key for each of its host's parent domains,
up to the number of labels of the longest rule host.

Sweep. Intervals of prefixes are nested or apart. Where a rule starts it comes on
top of the stack of active rules, where it ends its enclosing rule is on top
again; between two such ends the top does not change, so the ends are written
with the rule on top after them. Ends and keys are sorted together by range
partition, and every key takes the top left by the last end at or before it: a
running last value inside a partition, and for the head of a partition what the
partitions before it left (one row each).

Urls are reduced to distinct (host, path) pairs, and those to distinct keys, before
the sweep: the home pages of all hosts below a domain share a key and are one row of
it. What the sweep finds is written and joined back, keys to pairs and pairs to pages;
both joins read written tables, so Spark splits a key or a url that most rows share.
Joins and windows only: no Python runs on the rows.

Defined results: a null url, or one without ``://``, has empty host and path and
no rule; other urls without a rule get the default verdict; of equal rules block
wins; rules of null or empty host or null path are left out; repeated rows are
judged alike; no rules or no pages give defaults or nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, small_side

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NONE = ""      # top of an empty stack


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit("#"), path)


def _rule_ends(rules: DataFrame) -> DataFrame:
    """(key binary, top): both ends of every rule and the rule on top of the stack after it."""
    inner = rules.select("rule", "key", F.explode(F.sequence(F.lit(1), F.length("key") - 1)).alias("n")) \
        .select("rule", F.substring("key", F.lit(1), F.col("n")).alias("key"), "n")
    outer = rules.select("key", F.col("rule").alias("outer"))
    around = inner.join(outer, "key").groupBy("rule").agg(F.max_by("outer", "n").alias("outer"))
    starts = rules.select(F.encode("key", "UTF-8").alias("key"), F.col("rule").alias("top"))
    # no text holds the byte FF, so it comes after all keys with the rule's prefix
    closed = rules.join(around, "rule", "left").select(
        F.concat(F.encode("key", "UTF-8"), F.unhex(F.lit("FF"))).alias("key"),
        F.coalesce("outer", F.lit(_NONE)).alias("top"))
    return starts.unionByName(closed)


def last_at_or_before(ends: DataFrame, keys: DataFrame) -> DataFrame:
    """Distinct ``keys`` (binary) with ``top`` of the last of ``ends`` (key, top) up to each."""
    points = ends.select("key", F.lit(0).alias("kind"), "top").unionByName(
        keys.select("key", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("top")))
    swept = saved(points.repartitionByRange("key", "kind").sortWithinPartitions("key", "kind")
                  .withColumn("at", F.monotonically_increasing_id())
                  .withColumn("part", F.shiftright("at", 33)), "url-sweep")
    left = swept.groupBy("part").agg(
        F.max_by("top", F.when(F.col("top").isNotNull(), F.col("at"))).alias("left"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = saved(left.withColumn("carried", F.last("left", ignorenulls=True).over(before))
                    .select("part", "carried"), "url-carried")      # one row a partition
    inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return (swept.withColumn("top", F.last("top", ignorenulls=True).over(inside))
            .filter("kind = 1").join(small_side(carried, 100_000), "part")
            .select("key", F.coalesce("top", "carried", F.lit(_NONE)).alias("top")))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """All columns of ``pages`` with _url_host, _url_path, _url_rule and _url_verdict.

    ``rules``: (host, path, verdict), verdict allow or block.
    """
    known = rules.filter("host is not null and host != '' and path is not null").groupBy(
        F.translate("host", _UPPER, _LOWER).alias("host"), "path").agg(F.max("verdict").alias("verdict"))
    known = saved(known.withColumn("rule", F.concat("host", "path"))
                  .withColumn("labels", F.size(_labels(F.col("host"))))
                  .withColumn("key", _key(_labels(F.col("host")), F.col("path"))), "url-rules")
    deepest = known.agg(F.max("labels")).first()[0] or 0

    host, path = host_and_path(pages[url])
    marked = pages.select(*(pages[c] for c in pages.columns),
                          host.alias("_url_host"), path.alias("_url_path"))
    pairs = marked.select("_url_host", "_url_path").distinct().filter("_url_host != ''")
    labels = _labels(F.col("_url_host"))
    level = F.explode(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deepest)))) if deepest \
        else F.explode(F.array().cast("array<int>"))
    keys = saved(pairs.select("_url_host", "_url_path", level.alias("n")).select(
        F.encode(_key(F.slice(labels, F.lit(1), F.col("n")), F.col("_url_path")), "UTF-8").alias("key"),
        "_url_host", "_url_path"), "url-keys")
    tops = last_at_or_before(_rule_ends(known), keys.select("key").distinct()).filter(F.col("top") != _NONE)
    named = saved(tops.join(known.select(F.col("rule").alias("top"), "verdict", "labels"), "top"), "url-tops")
    best = saved(keys.join(named, "key").groupBy("_url_host", "_url_path").agg(
        F.max(F.struct(F.length("top").alias("n"), F.col("labels"), F.col("top").alias("rule"),
                       F.col("verdict"))).alias("_url_best")), "url-best")
    return marked.join(best, ["_url_host", "_url_path"], "left").select(
        *(marked[c] for c in pages.columns), "_url_host", "_url_path",
        F.col("_url_best.rule").alias("_url_rule"),
        F.coalesce("_url_best.verdict", F.lit(default)).alias("_url_verdict"))
