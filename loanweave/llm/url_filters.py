"""URL rules held in a trie of reversed host labels and path segments; the longest fitting rule decides.

``judge`` keeps every row and column of its input and adds ``host``, ``path``, ``rule`` and ``verdict`` (columns of
those names are replaced). A null url, or one without ``://``, has an empty host and path, fits no rule and takes the
default verdict. Repeated rows are judged alike; an empty table or rule list is fine.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules beyond this number (some 40 MB as a trie) are joined on host suffixes instead of being broadcast.
MAX_BROADCAST_RULES = 200_000

Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    host = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))


class Trie:
    """Rules by reversed host label, then by whole path segments; the last, possibly partial segment is kept as text."""

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for kind, host, path in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault("labels", {}).setdefault(label, {})
            *whole, partial = path.split("/")
            for segment in whole:
                node = node.setdefault("segments", {}).setdefault(segment, {})
            found = node.setdefault("rules", {})
            # of two rules with the same host and path the blocking one counts
            if found.get(partial, ("allow",))[0] == "allow":
                found[partial] = (kind, host + path)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(kind, rule) of the longest rule: most host labels first, then the longest path."""
        parts = path.split("/")
        best, node = None, self.root
        for label in reversed(host.split(".")):
            node = node.get("labels", {}).get(label)
            if node is None:
                break
            best = self._in_path(node, parts) or best
        return best

    @staticmethod
    def _in_path(node: dict, parts: list[str]) -> tuple[str, str] | None:
        best = None
        for segment in parts:
            fitting = [p for p in node.get("rules", ()) if segment.startswith(p)]
            if fitting:
                best = node["rules"][max(fitting, key=len)]
            node = node.get("segments", {}).get(segment)
            if node is None:
                break
        return best


def judge(urls: DataFrame, rules: DataFrame, default: str = "allow", most: int = MAX_BROADCAST_RULES) -> DataFrame:
    """Add host, path, rule (null without one) and verdict; ``rules`` has kind, host and path, none of them null."""
    rows = urls.drop("host", "path", "rule", "verdict")
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rules = rules.select("kind", "host", "path").distinct()
    few = rules.limit(most + 1).collect()
    judged = _by_trie(rows, few) if len(few) <= most else _by_join(rows, rules)
    return judged.withColumn("verdict", F.coalesce("_kind", F.lit(default))).drop("_kind")


def _by_trie(rows: DataFrame, rules: list) -> DataFrame:
    trie = rows.sparkSession.sparkContext.broadcast(Trie(tuple(r) for r in rules))

    @F.pandas_udf("_kind string, rule string")
    def look(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        find = trie.value.find
        for hosts, paths in batches:
            found = [find(h, p) or (None, None) for h, p in zip(hosts, paths)]
            yield pd.DataFrame(found, columns=["_kind", "rule"])

    found = rows.withColumn("_found", look("host", "path"))
    return found.select(*rows.columns, F.col("_found.rule").alias("rule"), F.col("_found._kind").alias("_kind"))


def _by_join(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """For long rule lists: every distinct host meets the rules of its suffixes, then the paths decide."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    by_host = rules.groupBy(F.col("host").alias("suffix")).agg(F.collect_list(F.struct("kind", "path")).alias("own"))
    offered = (
        rows.select("host").distinct().withColumn("suffix", F.explode(suffixes)).join(by_host, "suffix")
        .groupBy("host").agg(F.collect_list(F.struct("suffix", "own")).alias("_offered"))
    )
    flat = F.flatten(
        F.transform(
            "_offered",
            lambda o: F.transform(
                o["own"],
                lambda r: F.struct(
                    F.length(o["suffix"]).alias("labels"), F.length(r["path"]).alias("length"),
                    (r["kind"] == "block").alias("blocks"), o["suffix"].alias("host"), r["path"].alias("path"), r["kind"].alias("kind"),
                ),
            ),
        )
    )
    best = F.array_max(F.filter(flat, lambda r: F.startswith(F.col("path"), r["path"])))
    found = rows.join(offered, "host", "left").withColumn("_best", best)
    rule = F.concat(F.col("_best.host"), F.col("_best.path")).alias("rule")
    return found.select(*rows.columns, rule, F.col("_best.kind").alias("_kind"))
