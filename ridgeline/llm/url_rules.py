"""URL allow and block rules by a sorted sweep over host intervals.

A host turned round and closed with a dot (``moc.elpmaxe.www.``) makes "this host and its
subdomains" a prefix, so every rule host is an interval [key, key with its last dot replaced by
the next character).  Such intervals nest or are disjoint.  Sorted hosts and sorted rule hosts are
swept together; a stack holds the rule hosts whose intervals are open.  Within a rule host, paths
are sorted with a pointer to the longest rule path that is a prefix of them, so that the longest
rule for a url's path is found by one binary search and a few steps along the pointers.

Urls aren't shuffled: each task sorts the hosts of its own batch and sweeps them against the
rules.  The rules are broadcast in blocks of at most ``RULES_AT_ONCE``; with more rules than that
the urls pass one block after another and keep the best rule so far.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RULES_AT_ONCE = 500_000
#: (verdict, host, path) of the production rules.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: str) -> str:
    return host[::-1] + "."


class RuleSweep:
    """Rules as nested host intervals; finds the longest rule of each url."""

    def __init__(self, rules: Sequence[tuple[str, str, str]]):
        by_host: dict[str, dict[str, str]] = {}
        for verdict, host, path in rules:
            paths = by_host.setdefault(host.translate(str.maketrans(UPPER, LOWER)), {})
            # The same host and path twice: block wins, whatever the order.
            paths[path] = min(verdict, paths.get(path, verdict), key=lambda v: (v != "block", v))
        self.hosts = sorted((host_key(h), h, self._nested(p)) for h, p in by_host.items())

    @staticmethod
    def _nested(paths: dict[str, str]) -> tuple[list[str], list[int], list[str]]:
        ordered = sorted(paths)
        above, stack = [], []
        for i, path in enumerate(ordered):
            while stack and not path.startswith(ordered[stack[-1]]):
                stack.pop()
            above.append(stack[-1] if stack else -1)
            stack.append(i)
        return ordered, above, [paths[p] for p in ordered]

    @staticmethod
    def _longest(node, path: str) -> int:
        ordered, above, _ = node
        i = bisect.bisect_right(ordered, path) - 1
        while i >= 0 and not path.startswith(ordered[i]):
            i = above[i]
        return i

    def match(self, hosts: list[str], paths: list[str]) -> list[tuple[str, str, str] | None]:
        """(host, path, verdict) of each url's longest rule."""
        found: list = [None] * len(hosts)
        keys = [host_key(h) for h in hosts]
        stack: list[tuple[str, str, tuple]] = []
        at = 0
        for i in sorted(range(len(keys)), key=keys.__getitem__):
            key = keys[i]
            while at < len(self.hosts) and self.hosts[at][0] <= key:
                opened = self.hosts[at]
                while stack and not opened[0].startswith(stack[-1][0]):
                    stack.pop()
                stack.append(opened)
                at += 1
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            best = None
            for _, host, node in stack:
                j = self._longest(node, paths[i])
                if j >= 0 and (best is None or (len(host) + len(node[0][j]), len(host)) > (len(best[0]) + len(best[1]), len(best[0]))):
                    best = (host, node[0][j], node[2][j])
            found[i] = best
        return found


def _pass(df: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Sets rule_host, rule_path and rule_verdict wherever these rules have a longer one."""
    shared = df.sparkSession.sparkContext.broadcast(list(rules))
    names = df.columns

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        swept = RuleSweep(shared.value)
        for batch in batches:
            columns = {n: batch.column(n) for n in names}
            old = list(zip(*(columns[n].to_pylist() for n in ("rule_host", "rule_path", "rule_verdict")), strict=True))
            new = swept.match(columns["host"].to_pylist(), columns["path"].to_pylist())
            best = [b if b and (a[0] is None or (len(b[0]) + len(b[1]), len(b[0])) > (len(a[0]) + len(a[1]), len(a[0]))) else a for a, b in zip(old, new, strict=True)]
            for k, n in enumerate(("rule_host", "rule_path", "rule_verdict")):
                columns[n] = pa.array([b[k] for b in best], pa.string())
            yield pa.record_batch(list(columns.values()), names=names)

    return df.mapInArrow(sweep, df.schema)


def rule_blocks(rules: DataFrame | Sequence[tuple[str, str, str]]) -> Iterator[list[tuple[str, str, str]]]:
    """The rules in blocks of a bounded size.  Rows with a null host, path or verdict are no rules."""
    if isinstance(rules, DataFrame):
        clean = rules.select("verdict", "host", "path").dropna().distinct()
        n = -(-clean.count() // (RULES_AT_ONCE // 2)) or 1
        # The rules of a host and path stay together, so that a block decides between verdicts.
        for i in range(n):
            yield [tuple(r) for r in clean.where(F.pmod(F.xxhash64("host", "path"), F.lit(n)) == i).toLocalIterator()]
    else:
        for i in range(0, max(1, len(rules)), RULES_AT_ONCE):
            yield list(rules[i : i + RULES_AT_ONCE])


def judge_urls(df: DataFrame, rules: DataFrame | Sequence[tuple[str, str, str]] = RULES, *, id_col: str = "page_id", url_col: str = "url", otherwise: str = "allow") -> DataFrame:
    """One row per row of df: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``.

    A rule fits its host and all subdomains if the url's path starts with the rule's.  The rule
    with the longest host and path together wins, of equally long ones the longer host; the same
    host and path under both verdicts blocks.  No rule fits: ``rule`` is null and the verdict is
    ``otherwise``.  A null url or one without ``://`` has an empty host and path, which no rule
    fits.  Rows with null or repeated ids are judged like any other; further columns are left behind.
    """
    url = df[url_col]
    found = df.select(
        df[id_col].alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
        *[F.lit(None).cast("string").alias(n) for n in ("rule_host", "rule_path", "rule_verdict")],
    )
    for block in rule_blocks(rules):
        found = _pass(found, block)
    return found.select(
        "page_id", "host", "path", F.concat("rule_host", "rule_path").alias("rule"),
        F.coalesce("rule_verdict", F.lit(otherwise)).alias("verdict"),
    )


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


ORACLE = r"""
WITH rules(verdict, host, path) AS (VALUES ('allow','com','/'), ('block','example.com','/en/'),
  ('allow','www.example.com','/en/'), ('block','net','/es/'), ('block','net','/fr/')),
cut AS (
  SELECT page_id, row_number() OVER () AS rid,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, rid,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
ranked AS (
  SELECT p.*, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY p.rid ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS rk
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.host OR p.host LIKE '%.' || r.host) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM ranked WHERE rk = 1
"""
