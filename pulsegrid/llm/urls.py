"""Allow and block rules for urls, by a range join of reversed hosts.

A host is written backwards, a full stop after every label (``net.example.``). All subdomains of a
rule's host then lie in one interval of keys, and intervals of different rules are nested or apart.
Urls and rules are dealt to the same key ranges and sorted; a sweep over each range keeps a stack of
the rules whose intervals are open.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulsegrid.llm.sampling import drawn

SAMPLE_PER_RANGE = 64  #: sampled urls per key range, from which range bounds are taken
LAST = "/"  #: the character after the full stop: ends an interval


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path of a url; both empty if it is null or has no ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return _lower(host), path


def reversed_host(host: Column) -> Column:
    return F.when(host == "", "").otherwise(
        F.concat(F.concat_ws(".", F.reverse(F.split(host, r"\."))), F.lit("."))
    )


class Stack:
    """Open rules, outermost host first; per host its rules by path."""

    def __init__(self) -> None:
        self.hosts: list[tuple[str, list[str], dict[str, tuple[str, str]]]] = []

    def leave(self, key: str) -> None:
        """Closes the hosts whose intervals do not hold ``key``."""
        while self.hosts and not key.startswith(self.hosts[-1][0]):
            self.hosts.pop()

    def push(self, host: str, path: str, rule: str, verdict: str) -> None:
        if not self.hosts or self.hosts[-1][0] != host:
            self.hosts.append((host, [], {}))
        _, paths, rules = self.hosts[-1]
        at = bisect_left(paths, path)
        if at == len(paths) or paths[at] != path:
            paths.insert(at, path)
        if path not in rules or verdict == "block":
            rules[path] = (rule, verdict)

    def longest(self, path: str) -> tuple[str, str] | None:
        """The rule with the longest text whose path starts ``path``, of the open hosts."""
        best = None
        for _, paths, rules in self.hosts:
            end = len(path)
            while True:
                at = bisect_right(paths, path[:end])
                if not at:
                    break
                near = paths[at - 1]
                if path.startswith(near):
                    if best is None or len(rules[near][0]) >= len(best[0]):
                        best = rules[near]
                    break
                # No rule between: only a path that both have in front can fit.
                end = min(end, next((i for i, (x, y) in enumerate(zip(near, path)) if x != y), end - 1))
        return best


def _sweep(default: str):
    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stack, part = Stack(), None
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                if row.part != part:
                    stack, part = Stack(), row.part
                stack.leave(row.key)
                if row.is_page:
                    rule, verdict = stack.longest(row.path) or (None, default)
                    out.append((row.page_id, row.host, row.path, rule, verdict))
                else:
                    stack.push(row.key, row.path, row.rule, row.verdict)
            yield pd.DataFrame(out, columns=["page_id", "host", "path", "rule", "verdict"])

    return of


def rules_table(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """``(verdict, rule)`` from pairs like ``("block", "net/")``."""
    return spark.createDataFrame(list(rules), "verdict string, rule string")


def judge(
    pages: DataFrame,
    rules: DataFrame,
    id: str = "page_id",
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` per row of ``pages``.

    ``rules (verdict, rule)``: a rule is a host and a path (``example.net/en/``). It fits its host and
    all subdomains if the url's path starts with its path; the longest fitting rule wins, on a tie
    that of the longer host, and of equal rules a block. If none fits, rule is null and the verdict
    ``default``. A url that is null or has no ``://`` has an empty host and path and fits no rule.
    Rows with null or repeated ids are judged each; null rules are ignored; empty tables are fine.

    Ranges are as many as shuffle partitions; their bounds come from a sample of SAMPLE_PER_RANGE
    urls each. A rule goes to every range its interval meets. Where one key fills several ranges,
    its rows are dealt over all of them.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url))
    swept = pages.select(
        F.col(id).cast("string").alias("page_id"), host.alias("host"), path.alias("path")
    ).withColumn("key", reversed_host(F.col("host")))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The path belongs to the sort order, so that a host's urls can fill several ranges.
    full = F.concat("key", F.lit("\x00"), "path")
    keys = swept.select("page_id", "path", full.alias("full"))
    some = drawn(keys, pages.count(), SAMPLE_PER_RANGE * ranges, 5, "page_id", "path", "full")
    sample = sorted(r["full"] for r in some.select("full").collect())
    bounds = sample[SAMPLE_PER_RANGE::SAMPLE_PER_RANGE]

    def range_of(keys: pd.Series, salts: pd.Series) -> pd.Series:
        low = [bisect_left(bounds, k) for k in keys]
        high = [bisect_right(bounds, k) for k in keys]
        return pd.Series([a + s % (b - a + 1) for a, b, s in zip(low, high, salts)], dtype="int64")

    def ranges_of(keys: pd.Series) -> pd.Series:
        return pd.Series(
            [list(range(bisect_left(bounds, k), bisect_right(bounds, k[:-1] + LAST) + 1)) for k in keys]
        )

    salt = F.expr("abs(xxhash64(page_id, path) % 1000003)")
    urls = swept.withColumn("part", F.pandas_udf(range_of, "long")(full, salt)).select(
        "part", "key", F.lit(True).alias("is_page"), "page_id", "host", "path",
        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"),
    )
    rule = F.col("rule")
    spans = (
        rules.filter(rule.isNotNull() & F.col("verdict").isNotNull())
        .select(
            "rule", "verdict",
            _lower(F.regexp_extract(rule, r"\A([^/]*)", 1)).alias("host"),
            F.regexp_extract(rule, r"\A[^/]*(.*)", 1).alias("path"),
        )
        .filter("host <> ''")
        .withColumn("key", reversed_host(F.col("host")))
        .withColumn("part", F.explode(F.pandas_udf(ranges_of, "array<long>")("key")))
        .select(
            "part", "key", F.lit(False).alias("is_page"),
            F.lit(None).cast("string").alias("page_id"),
            "host", "path", "rule", "verdict",
        )
    )
    dealt = urls.unionByName(spans).repartition(ranges, "part")
    in_order = dealt.sortWithinPartitions("part", "key", "is_page")
    # Ids are text in between: beside nulls, large numbers would not come back whole from pandas.
    kind = pages.select(id).schema[0].dataType
    found = in_order.mapInPandas(
        _sweep(default), "page_id string, host string, path string, rule string, verdict string"
    )
    return found.withColumn("page_id", F.col("page_id").cast(kind))
