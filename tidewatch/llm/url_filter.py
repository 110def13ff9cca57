"""Host and path rules over URLs by a sorted sweep of reversed-host intervals.

A rule ``(host, path, verdict)`` fits a URL whose host is the rule's host or lies below it and whose path
starts with the rule's path. Labels of a host are reversed and closed by a dot, then the path follows
(``example.com`` and ``/en/`` give ``com.example./en/``), so everything below a rule is one interval of keys,
and the intervals of two rules nest or are apart. Rules and URLs are sorted together by range partitions;
opening a rule pushes it, its end pops back to the rule around it, and each URL key meets the top of the
stack. A URL enters once for each host at or above its own (as many as it has labels), so that path rules of
a parent host are met too; the longest rule wins.

Built-in functions only: no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.llm.common import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for NULL or without ``://``."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _key(labels: Column, path: Column) -> Column:
    """Reversed labels, a dot after each, then the path, as bytes."""
    return F.encode(F.concat(F.array_join(F.reverse(labels), "."), F.lit("."), path), "UTF-8")


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """``rules`` (host, path, verdict) as a table."""
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    if not rows:
        return spark.createDataFrame([], "host string, path string, verdict string")
    return spark.range(1).select(F.inline(F.array(*rows)))


def _nested(rules: DataFrame) -> DataFrame:
    """One row per rule key with the rule around it: its longest proper prefix among the rules."""
    one = (
        rules.where("host IS NOT NULL AND path IS NOT NULL")
        .withColumn("host", F.translate("host", UPPER, LOWER))
        .withColumn("key", _key(F.split("host", r"\."), F.col("path")))
        .groupBy("key", "host", "path")
        # A rule given twice with both verdicts blocks.
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("rule", F.struct(F.concat("host", "path").alias("name"), F.length("host").alias("host_length"), "verdict"))
        .select("key", "rule")
    )
    prefixes = one.select(
        F.col("key").alias("inner_key"),
        F.explode(F.expr("transform(sequence(1, greatest(length(key) - 1, 1)), i -> substring(key, 1, i))")).alias("key"),
    ).where("key <> inner_key")
    around = prefixes.join(one, "key").groupBy("inner_key").agg(F.max_by("rule", F.length("key")).alias("around"))
    return one.join(around, one["key"] == around["inner_key"], "left").select("key", "rule", "around")


def judge(urls: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Distinct ``(host, path)`` of ``urls`` with ``rule`` (NULL if none fits) and ``verdict``.

    ``urls`` has non-NULL ``host`` and ``path``; ``rules`` has ``host``, ``path``, ``verdict``. Longest means
    most characters of host and path together, then the longer host. No rules, or none that fits: ``default``.
    """
    nested = _nested(rules)
    top = F.struct(F.col("rule").alias("rule"))
    events = nested.select("key", F.lit(0).alias("kind"), F.lit("").alias("host"), F.lit("").alias("path"), top.alias("top")).unionByName(
        # 0xFF is in no UTF-8 text: it ends the interval of a prefix.
        nested.select(
            F.concat("key", F.unhex(F.lit("FF"))).alias("key"), F.lit(0).alias("kind"), F.lit("").alias("host"), F.lit("").alias("path"),
            F.struct(F.col("around").alias("rule")).alias("top"),
        )
    )
    distinct = urls.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    # A level deeper than the deepest rule meets none, so a host enters as often as rules have labels at most.
    deepest = rules.agg(F.coalesce(F.max(F.size(F.split("host", r"\."))), F.lit(1))).scalar()
    levels = distinct.withColumn("n", F.explode(F.sequence(F.lit(1), F.least(F.size(labels), F.greatest(deepest, F.lit(1)))))).select(
        _key(F.slice(labels, -F.col("n"), F.col("n")), F.col("path")).alias("key"),
        F.lit(1).alias("kind"), "host", "path",
        F.lit(None).cast(events.schema["top"].dataType).alias("top"),
    )
    order = ["key", "kind", "host", "path"]
    # Equal keys are told apart by host and path, so a common path below one domain is not one partition.
    swept = cut_lineage(
        events.unionByName(levels).repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "url-sweep"
    )
    last = swept.where("top IS NOT NULL").groupBy("part").agg(F.max_by("top", F.struct("key", "kind")).alias("left_over"))
    # One row per partition: what the stack holds where the partition begins.
    carried = (
        swept.select("part").distinct().join(last, "part", "left")
        .select("part", F.last("left_over", True).over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    )
    so_far = F.last("top", True).over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    met = (
        swept.withColumn("so_far", so_far).where("kind = 1")
        .join(carried, "part", "left")
        .select("host", "path", F.coalesce("so_far", "carried")["rule"].alias("rule"))
    )
    best = met.groupBy("host", "path").agg(
        F.max_by("rule", F.when(F.col("rule").isNotNull(), F.struct(F.length("rule.name"), "rule.host_length"))).alias("rule")
    )
    return best.select("host", "path", F.col("rule.name").alias("rule"), F.coalesce("rule.verdict", F.lit(default)).alias("verdict"))


def filter_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """``key``, host, path, rule and verdict of every row of ``pages``; repeated rows stay repeated.

    A NULL URL, or one without ``://``, has empty host and path and is judged like any other.
    """
    seen = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    return seen.join(judge(seen, rules, default), ["host", "path"], "left").select(key, "host", "path", "rule", "verdict")
