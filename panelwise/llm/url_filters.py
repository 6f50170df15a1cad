"""URL rules by a sort-merge range join on reversed-host keys.

A host's key is its labels in reverse, each followed by a dot, so that a host and
all its subdomains are one interval of keys, and the intervals of two hosts are
nested or disjoint. Pages and rules are dealt to ranges of keys and sorted; one
sweep over each range keeps a stack of the hosts whose intervals are open, each
with its rules' paths, again nested intervals, in order.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pages of one range, and the most ranges; what bounds the sample of keys that the driver cuts ranges by is RANGES * SAMPLED keys.
RANGE_ROWS, RANGES, SAMPLED = 1 << 14, 4096, 32

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """What lies between the first :// and the next /, ?, # or the end, A-Z lower-cased; empty for null and without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty for null and without ://."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def host_key(host: Column) -> Column:
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


def _ranged(cuts: list[tuple[str, int]]):
    """Ranges [first, last] of keys: that of (key, tie) for pages, all that the interval of keys meets for rules."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ties = batch.column("key").to_pylist(), batch.column("tie").to_pylist()
            first = [bisect_right(cuts, (k, t)) if t is not None else bisect_left(cuts, (k,)) for k, t in zip(keys, ties, strict=True)]
            # Keys that begin with k end before k with its closing dot raised; the empty key covers all.
            last = [
                f if t is not None else bisect_left(cuts, (k[:-1] + "/",)) if k else len(cuts)
                for f, k, t in zip(first, keys, ties, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first, pa.int32()), pa.array(last, pa.int32())], names=[*batch.schema.names, "first", "last"])

    return run


class _Host:
    """A host's rules: paths in order, each with the place of the longest other one that it begins with."""

    def __init__(self, key: str):
        self.key, self.paths, self.rules, self.outer, self._open = key, [], [], [], []

    def add(self, path: str, rule: tuple[str, str]) -> None:
        """Rules come by path; of equal paths the first counts."""
        if self.paths and self.paths[-1] == path:
            return
        while self._open and not path.startswith(self.paths[self._open[-1]]):
            self._open.pop()
        self.outer.append(self._open[-1] if self._open else -1)
        self._open.append(len(self.paths))
        self.paths.append(path)
        self.rules.append(rule)

    def longest(self, path: str) -> int:
        at = bisect_right(self.paths, path) - 1
        while at >= 0 and not path.startswith(self.paths[at]):
            at = self.outer[at]
        return at


def _swept(default: str):
    """Rules and pages in order of range, key and path, rules first; gives the pages with their rule and verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, stack = None, []
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("range", "key", "path", "kind", "host", "verdict"))
            for place, (n, key, path, kind, host, verdict) in enumerate(zip(*columns, strict=True)):
                if n != now:
                    now, stack = n, []
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1].key != key:
                        stack.append(_Host(key))
                    stack[-1].add(path, (host + path, verdict))
                    continue
                best, size = (None, default), -1
                for own in reversed(stack):  # inner hosts first, so that they win ties of length
                    at = own.longest(path)
                    if at >= 0 and len(own.rules[at][0]) > size:
                        best, size = own.rules[at], len(own.rules[at][0])
                out.append((place, *best))
            if out:
                places, rules, verdicts = zip(*out, strict=True)
                pages = batch.select(["id", "host", "path"]).take(pa.array(places))
                yield pa.RecordBatch.from_arrays([*pages.columns, pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], names=["id", "host", "path", "rule", "verdict"])

    return run


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """id_col, host, path, rule (its host and path) and verdict of every row of pages.

    rules has host, path and verdict. A rule fits its host and all subdomains
    where the url's path begins with the rule's; the one with the longest host
    and path together wins, of equal lengths the one with the longest host; where
    none fits, rule is null and verdict the default. Of rules equal in host and
    path, the greatest verdict counts (block before allow). A rule's null host
    fits nothing, its null path is empty, its empty host fits every page. Urls
    that are null or without :// have an empty host and path. Rows are judged one
    by one, so null and repeated ids each give their row; other columns are
    ignored, an empty table gives no rows.

    Pages are dealt to ranges by key and a hash of id and url, which splits a hot
    host, at cuts from a bounded sample; the sample moves work only, never a
    verdict. A rule goes to the ranges that its host's interval meets.
    """
    kind = dict(pages.dtypes)[id_col]
    host, path = url_host(F.col(url_col)), url_path(F.col(url_col))
    keyed = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), F.xxhash64(id_col, url_col).alias("tie"))
    keyed = keyed.withColumn("key", host_key(F.col("host")))
    total = pages.count()
    ranges = max(1, min(RANGES, -(-total // RANGE_ROWS)))
    cuts: list[tuple[str, int]] = []
    if ranges > 1:
        share = min(1.0, SAMPLED * ranges / total)
        sample = keyed.where(F.pmod(F.xxhash64("tie", F.lit(11)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("key", "tie")
        found = sorted((r.key, r.tie) for r in sample.limit(2 * SAMPLED * RANGES).collect())
        cuts = [found[i * len(found) // ranges] for i in range(1, ranges)] if found else []
    known = rules.where("host is not null").select(
        F.lit(None).cast(kind).alias("id"), F.translate("host", _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
        F.lit(None).cast("long").alias("tie"), host_key(F.translate("host", _UPPER, _LOWER)).alias("key"), "verdict", F.lit(0).alias("kind")
    )
    both = keyed.withColumns({"verdict": F.lit(None).cast("string"), "kind": F.lit(1)}).unionByName(known)
    dealt = both.mapInArrow(_ranged(cuts), f"id {kind}, host string, path string, tie long, key string, verdict string, kind int, first int, last int")
    spread = dealt.select(F.explode(F.sequence("first", "last")).alias("range"), "id", "host", "path", "key", "verdict", "kind")
    ordered = spread.repartition(ranges, "range").sortWithinPartitions("range", "key", "kind", "path", F.desc("verdict"))
    out = ordered.mapInArrow(_swept(default), f"id {kind}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("id", id_col)


#: The rules that the registered query judges pages by (host, path, verdict).
PAGE_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def filter_sql(rules: list[tuple[str, str, str]] = PAGE_RULES, default: str = "allow") -> str:
    """DuckDB SQL of filter_urls over the table pages."""
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    return f"""WITH r(rhost, rpath, v) AS (VALUES {values}),
u AS (SELECT row_number() OVER () AS n, page_id,
translate(coalesce(regexp_extract(url, '{_PARTS}', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
coalesce(regexp_extract(url, '{_PARTS}', 2), '') AS path FROM pages)
SELECT page_id, host, path, rhost || rpath AS rule, coalesce(v, '{default}') AS verdict
FROM u LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
QUALIFY row_number() OVER (PARTITION BY n ORDER BY length(rhost || rpath) DESC NULLS LAST, length(rhost) DESC) = 1"""
