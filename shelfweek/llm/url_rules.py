"""URL rules by a sort-merge range join.

A host is written with its labels reversed (``com.example.www.``), so that a rule for a host
and all its subdomains is one interval of keys: those that begin with the rule's. URLs and
rules are range-partitioned by that key together and sorted; a sweep over a partition keeps
a stack of the rules whose interval it is in, innermost last, which for each URL are the
rules of its host's suffixes. A rule that began in an earlier partition is added to the
partitions its interval reaches into.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import numbered, settle

#: Rows of a range partition, about.
PARTITION_ROWS = 50_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased.
    Path: from there up to ``?``, ``#`` or the end. Both empty for null or without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


class _Stack:
    """The rules in force, by host key from the outermost to the innermost."""

    def __init__(self):
        self.open: list[tuple[str, list[str], list[tuple]]] = []

    def close_before(self, key: str) -> None:
        while self.open and not key.startswith(self.open[-1][0]):
            self.open.pop()

    def add(self, key: str, path: str, rule: tuple) -> None:
        if not self.open or self.open[-1][0] != key:
            self.open.append((key, [], []))
        _, paths, rules = self.open[-1]
        at = bisect_right(paths, path)
        paths.insert(at, path)
        rules.insert(at, rule)

    def longest(self, path: str) -> tuple | None:
        """The rule that fits with the most characters, the longer host among equals."""
        best, size = None, (-1, -1)
        for key, paths, rules in self.open:
            # of the paths up to this one in order, its prefixes: each found from the last
            at, upto = bisect_right(paths, path), path
            while at:
                found = paths[at - 1]
                if upto.startswith(found):
                    if (len(key) + len(found), len(key)) > size:
                        best, size = rules[at - 1], (len(key) + len(found), len(key))
                    break
                k = 0
                while k < len(found) and k < len(upto) and found[k] == upto[k]:
                    k += 1
                upto = upto[:k]
                at = bisect_right(paths, upto, 0, at)
        return best


def sweep(rows: pd.DataFrame) -> pd.DataFrame:
    """Judge the URLs of one partition; ``rows`` holds its rules and URLs."""
    rows = rows.sort_values(["key", "is_url", "path", "rule"], kind="stable")
    stack, out = _Stack(), []
    for key, path, is_url, row, rule, verdict in zip(
        rows["key"], rows["path"], rows["is_url"], rows["_row"], rows["rule"], rows["verdict"]
    ):
        stack.close_before(key)
        if is_url:
            found = stack.longest(path)
            if found:
                out.append((row, *found))
        else:
            stack.add(key, path, (rule, verdict))
    return pd.DataFrame(out, columns=["_row", "rule", "verdict"])


def judge(urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` and ``verdict`` (replaced if there already).

    ``rules``: host, path, verdict. A rule fits its host and all subdomains if the URL's path
    starts with the rule's; the longest (host and path together, then host) wins. Without a
    fitting rule ``rule`` is null and ``verdict`` is ``default``. Of rules with equal host and
    path the verdict last in order wins. Rules with a null or an empty host fit nothing; a
    null path is empty. Rule hosts are lower-cased as URLs' are. Repeated rows stay rows of
    their own. All columns of ``urls`` are written once; select those that are needed before.
    """
    rows = numbered(urls.select(F.struct("*").alias("_own")))
    host, path = host_and_path(F.col("_own").getField(url_col).cast("string"))
    parted = rows.select("_own", "_row", host.alias("host"), path.alias("path"))
    probes = parted.select(
        host_key(F.col("host")).alias("key"),
        "path",
        F.lit(True).alias("is_url"),
        "_row",
        F.lit(None).cast("string").alias("rule"),
        F.lit(None).cast("string").alias("verdict"),
    )
    own_host = F.translate("host", _UPPER, _LOWER)
    own_path = F.coalesce("path", F.lit(""))
    listed = rules.where("length(host) > 0").select(own_host.alias("host"), own_path.alias("path"), "verdict")
    listed = listed.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    listed = listed.select(
        host_key(F.col("host")).alias("key"),
        "path",
        F.lit(False).alias("is_url"),
        F.lit(None).cast("long").alias("_row"),
        F.concat("host", "path").alias("rule"),
        "verdict",
    )
    both = listed.union(probes)
    parts = max(1, -(-both.count() // PARTITION_ROWS))
    # URLs with equal keys are told apart by path and row, so a hot host has many partitions
    swept = both.repartitionByRange(parts, "key", "is_url", "path", "_row")
    swept = settle(swept.withColumn("part", F.spark_partition_id()))

    # rules whose interval began before a partition: their key begins the partition's first
    firsts = swept.groupBy("part").agg(F.min("key").alias("first"))
    labels = F.split("first", r"\.")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1),
        lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit(".")),
    )
    reached = firsts.select("part", F.explode(prefixes).alias("key"))
    carried = swept.where("NOT is_url").withColumnRenamed("part", "_from").join(reached, "key")
    carried = carried.where("_from < part").select(*swept.columns)

    found = (
        swept.union(carried)
        .groupBy("part")
        .applyInPandas(sweep, "_row long, rule string, verdict string")
    )
    out = parted.join(found, "_row", "left")
    own = [
        F.col("_own").getField(c).alias(c)
        for c in urls.columns
        if c not in ("host", "path", "rule", "verdict")
    ]
    return out.select(
        *own, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
