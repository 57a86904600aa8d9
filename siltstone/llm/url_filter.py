"""URL filter: a trie over reversed host labels and path segments, longest match wins.

A rule is (host, path, verdict). It fits its host and every subdomain of it if the url's path starts
with the rule's path; among fitting rules the one with more host labels wins, then the one with the
longer path; if one (host, path) is both allowed and blocked, block wins.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A trie is sent to every executor only up to this many bytes of rule text; beyond it rules are joined.
MAX_TRIE_BYTES = 32 << 20
END = ""


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def split_url(df: DataFrame, url: str) -> DataFrame:
    """Add host and path: host after the first '://' with A-Z lower-cased, path up to '?' or '#'.

    NULL urls and urls without '://' have both empty.
    """
    parts = r"^.*?://([^/?#]*)([^?#]*)"
    pattern = "(?s)" + parts
    known = F.coalesce(F.col(url), F.lit(""))
    return df.withColumns(
        {
            "host": F.translate(F.regexp_extract(known, pattern, 1), UPPER, LOWER),
            "path": F.regexp_extract(known, pattern, 2),
        }
    )


def build_trie(rules: Sequence[Rule]) -> dict:
    """Nested dicts: reversed host labels, then END, then whole path segments.

    Under the node of the segments a rule's last, possibly partial segment is kept in a list at END,
    longest first, as (start of the segment, rule text, verdict).
    """
    root: dict = {}
    for rule in rules:
        node = root
        for label in reversed(rule.host.lower().split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault(END, {})
        *whole, last = rule.path.split("/")
        for segment in whole:
            node = node.setdefault("/" + segment, {})
        node.setdefault(END, []).append((last, rule.text, rule.verdict))

    def settle(node: dict) -> None:
        for key, value in node.items():
            if isinstance(value, list):
                value.sort(key=lambda entry: (-len(entry[0]), entry[0], entry[2] != "block"))
            else:
                settle(value)

    settle(root)
    return root


def longest_match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """The deepest rule along the host's labels, and below a host the longest path."""
    hosts, node = [], trie
    for label in reversed(host.split(".")):
        node = node.get(label) if label else None
        if node is None:
            break
        if END in node:
            hosts.append(node[END])
    segments = path.split("/")
    for node in reversed(hosts):
        found = None
        for segment in segments:
            for start, text, verdict in node.get(END, ()):
                if segment.startswith(start):
                    found = (text, verdict)
                    break
            node = node.get("/" + segment)
            if node is None:
                break
        if found:
            return found
    return None


def filter_urls(
    df: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = "allow", max_trie_bytes: int = MAX_TRIE_BYTES
) -> DataFrame:
    """Add host, path, rule (NULL if none fits) and verdict (`default` if none fits) to every row.

    The trie is broadcast while the rules hold at most `max_trie_bytes` of text; larger rule lists are
    joined on (host suffix, whole leading segments), see `join_rules`. Both give the same rows. No
    column of `df` is lost unless it bears one of the four names, which are then replaced. Repeated
    rows are judged one by one; NULL and empty urls have an empty host, which no rule fits.
    """
    df = split_url(df.drop("host", "path", "rule", "verdict"), url)
    if sum(len(rule.text) for rule in rules) > max_trie_bytes:
        return join_rules(df, rules, default)
    trie = df.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("struct<rule string, verdict string>")
    def judge(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        rules_of = trie.value
        for hosts, paths in parts:
            found = [longest_match(rules_of, h, p) or (None, default) for h, p in zip(hosts, paths)]
            yield pd.DataFrame(found, columns=["rule", "verdict"])

    return df.withColumn("__judged", judge("host", "path")).select(
        *df.columns, F.col("__judged.rule").alias("rule"), F.col("__judged.verdict").alias("verdict")
    )


def join_rules(df: DataFrame, rules: Sequence[Rule] | DataFrame, default: str = "allow") -> DataFrame:
    """`filter_urls` for rule lists of any size: distinct (host, path) meet rules by equal keys.

    A key is a host suffix and the whole leading path segments; the start of the next segment is
    compared after the join. Rules may be a DataFrame (host, path, verdict).
    """
    if not isinstance(rules, DataFrame):
        rules = df.sparkSession.createDataFrame([(r.host, r.path, r.verdict) for r in rules], "host string, path string, verdict string")
    keyed = rules.select(
        F.lower("host").alias("key_host"),
        F.regexp_extract("path", r"(?s)^(.*/)?([^/]*)$", 1).alias("key_path"),
        F.regexp_extract("path", r"(?s)^(.*/)?([^/]*)$", 2).alias("start"),
        F.concat("host", "path").alias("rule"),
        F.col("verdict"),
    )
    places = df.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    steps = F.split("path", "/")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    whole = F.transform(
        F.sequence(F.lit(1), F.size(steps)),
        lambda i: F.struct(
            F.when(i == 1, F.lit("")).otherwise(F.concat(F.array_join(F.slice(steps, 1, i - 1), "/"), F.lit("/"))).alias("key_path"),
            F.get(steps, i - 1).alias("next"),
        ),
    )
    candidates = places.withColumn("key_host", F.explode(suffixes)).withColumn("at", F.explode(whole))
    candidates = candidates.select("host", "path", "key_host", "at.key_path", "at.next")
    order = F.struct(F.size(F.split("key_host", r"\.")), F.length("key_path") + F.length("start"), F.col("verdict") == "block")
    best = (
        candidates.join(keyed, ["key_host", "key_path"])
        .where(F.col("next").startswith(F.col("start")))
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("rule", "verdict"), order).alias("__best"))
    )
    return df.join(best, ["host", "path"], "left").select(
        *df.columns, F.col("__best.rule").alias("rule"), F.coalesce("__best.verdict", F.lit(default)).alias("verdict")
    )
