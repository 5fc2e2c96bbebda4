"""URL rules by a sort-merge range join.

A rule is a host and a path. Its key is the host's labels in reverse, a slash and the path; all keys
that begin with it are an interval. A URL has one key for each of its host's suffixes, so "the host
and its subdomains" are equal keys and "the path starts with" is the interval. Distinct keys and
rules are dealt to ranges of keys; a rule goes to every range that its interval meets. Within a range
both are sorted, and one sweep keeps the stack of rules whose interval is open: the next key closes
what it does not begin with, and the top of the stack is the longest rule of this key.

Range borders are quantiles of keys chosen by hash, at most `BORDER_KEYS` per range. Equal URLs are one
key, so a host with a third of all pages is as many keys as it has paths. Only hosts and paths move.

Defined cases: a null URL or one without `://` has an empty host and path and no rule; equal rules
keep the one that sorts first by verdict; empty tables of pages or rules give none or no matches.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sampled keys for each border between ranges.
BORDER_KEYS = 64
LAST = "\U0010ffff"
RULE, URL = 0, 1


def after_scheme(url: Column) -> Column:
    """What follows the first `://`, whatever a query or fragment holds; null without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end; A-Z lowered."""
    host = F.regexp_extract(after_scheme(url), "^[^/?#]*", 0)
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), "^[^/?#]*(/[^?#]*)", 1), F.lit(""))


def reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, "\\."))


def suffix_keys(host: Column, path: Column) -> Column:
    """One key for the host and each of its parent domains."""
    labels = reversed_labels(host)
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit("\n"), path),
    )


def rule_key(host: Column, path: Column) -> Column:
    """A line feed ends the labels: it sorts below whatever a label holds."""
    return F.concat(F.array_join(reversed_labels(F.lower(host)), "."), F.lit("\n"), path)


def key_borders(keys: DataFrame, ranges: int) -> list[str]:
    """At most ranges - 1 borders that share the keys about evenly."""
    count = keys.count()
    step = max(1, count // (BORDER_KEYS * ranges))
    chosen = keys.where(F.pmod(F.xxhash64("key"), F.lit(step)) == 0).limit(4 * BORDER_KEYS * ranges)
    found = sorted(r["key"] for r in chosen.collect())
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else []


def sweep(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, key, kind, rule) in order; returns (key, rule) where a rule is open."""
    stack: list[tuple[str, str]] = []
    part = None
    for batch in rows:
        keys, rules = [], []
        for p, key, kind, rule in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if p != part:
                part, stack = p, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == RULE:
                if not stack or stack[-1][0] != key:
                    stack.append((key, rule))
            elif stack:
                keys.append(key)
                rules.append(stack[-1][1])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(rules, pa.string())], ["key", "rule"])


def judge_urls(
    pages: DataFrame, rules: DataFrame, url_column: str = "url", default: str = "allow", ranges: int | None = None
) -> DataFrame:
    """(row, host, path, rule, verdict), one row per row; `row` is a struct of the columns.

    rules: (host, path, verdict). The longest fitting rule wins, measured by host and path together;
    ties go to the longer host. Without one the verdict is `default`.
    """
    spark = pages.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = pages.select(
        F.struct("*").alias("row"), host_of(F.col(url_column)).alias("host"), path_of(F.col(url_column)).alias("path")
    )
    # A path without its slash begins like no rule.
    urls = keyed.where("host <> ''").select("host", "path").distinct()
    suffixes = urls.select("host", "path", F.explode(suffix_keys(F.col("host"), F.col("path"))).alias("key"))
    keys = suffixes.select("key").distinct()
    borders = key_borders(keys, ranges)

    @F.pandas_udf("int")
    def part_of(key: pd.Series) -> pd.Series:
        return key.map(lambda k: bisect_right(borders, k)).astype("int32")

    ruled = rules.select(
        rule_key(F.col("host"), F.col("path")).alias("key"),
        F.concat("host", "path").alias("rule"),
        "verdict",
        F.lower("host").alias("host"),
    ).where("key is not null")
    ruled = ruled.groupBy("key").agg(F.min(F.struct("verdict", "rule", "host")).alias("r")).select("key", "r.*")
    covered = F.explode(F.sequence(part_of("key"), part_of(F.concat("key", F.lit(LAST)))))
    both = (
        keys.select(part_of("key").alias("part"), "key", F.lit(URL).alias("kind"), F.lit(None).cast("string").alias("rule"))
        .unionByName(ruled.select(covered.alias("part"), "key", F.lit(RULE).alias("kind"), F.col("key").alias("rule")))
    )
    matches = (
        both.repartition("part")
        .sortWithinPartitions("part", "key", "kind")
        .mapInArrow(sweep, "key string, rule string")
        .withColumnRenamed("rule", "rule_key")
    )
    of_key = matches.join(ruled.withColumnRenamed("key", "rule_key"), "rule_key").select("key", "rule", "verdict", F.length("host").alias("n"))
    best = (
        suffixes.join(of_key, "key")
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("size"), "n", "rule", "verdict")).alias("best"))
        .select("host", "path", "best.rule", "best.verdict")
    )
    return keyed.join(best, ["host", "path"], "left").select(
        "row", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (verdict, host, path)."""
    return spark.createDataFrame(
        pa.table({k: pa.array([r[i] for r in rules], pa.string()) for k, i in (("host", 1), ("path", 2), ("verdict", 0))})
    )
