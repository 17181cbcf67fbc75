"""URL rules as intervals of reversed-host keys, matched by a sorted sweep with a stack."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stored

#: Rules that may be sent to every task; more are sorted and swept with the URLs, by ranges.
MAX_SENT_RULES = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @staticmethod
    def parse(line: str) -> Rule:
        verdict, place = line.split(maxsplit=1)
        host, slash, path = place.partition("/")
        return Rule(verdict, host, slash + path)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return _lower(_part(url, 1))


def _lower(host: Column) -> Column:
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return _part(url, 2)


def _part(url: Column, group: int) -> Column:
    # the first "://": what stands before it must not hold another
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)([^?#]*)", group), F.lit(""))


def reversed_key(host: str) -> str:
    """``www.example.org`` as ``org.example.www.``; a host's subdomains start with its key."""
    return ".".join(reversed(host.split("."))) + "."


class Sweep:
    """Nested host intervals in key order; the path rules of each in path order."""

    def __init__(self, rules: list[Rule]) -> None:
        by: dict[str, list[Rule]] = {}
        for r in rules:
            by.setdefault(reversed_key(r.host), []).append(r)
        self.keys = sorted(by)
        self.rules = [_Paths(by[k]) for k in self.keys]

    def run(self, points: list[tuple[str, str]]) -> list[Rule | None]:
        """The longest fitting rule of each (host, path); one merge of sorted points and intervals."""
        keyed = sorted((reversed_key(h), i) for i, (h, _) in enumerate(points))
        out: list[Rule | None] = [None] * len(points)
        stack: list[int] = []  # active intervals, outermost first
        nxt = 0
        for key, i in keyed:
            while nxt < len(self.keys) and self.keys[nxt] <= key:
                while stack and not self.keys[nxt].startswith(self.keys[stack[-1]]):
                    stack.pop()
                stack.append(nxt)
                nxt += 1
            while stack and not key.startswith(self.keys[stack[-1]]):
                stack.pop()
            best: Rule | None = None
            for k in stack:
                r = self.rules[k].longest(points[i][1])
                if r is not None and (best is None or (len(r.text), len(r.host)) > (len(best.text), len(best.host))):
                    best = r
            out[i] = best
        return out


class _Paths:
    """The path prefixes of one host as nested intervals; each knows the one around it."""

    def __init__(self, rules: list[Rule]) -> None:
        first: dict[str, Rule] = {}
        for r in sorted(rules, key=lambda r: (r.path, r.verdict != "block")):
            first.setdefault(r.path, r)  # of equal rules, block counts
        self.paths = sorted(first)
        self.rules = [first[p] for p in self.paths]
        self.around: list[int] = []
        stack: list[int] = []
        for i, p in enumerate(self.paths):
            while stack and not p.startswith(self.paths[stack[-1]]):
                stack.pop()
            self.around.append(stack[-1] if stack else -1)
            stack.append(i)

    def longest(self, path: str) -> Rule | None:
        i = bisect_right(self.paths, path) - 1
        while i >= 0 and not path.startswith(self.paths[i]):
            i = self.around[i]
        return self.rules[i] if i >= 0 else None


def match_urls(pages: DataFrame, rules: list[Rule] | DataFrame, url_col: str = "url", default: str = "allow", prefix: str = "") -> DataFrame:
    """``pages`` with host, path, rule (``host/path`` or null) and verdict added.

    The four names get ``prefix``; a column of ``pages`` with the same name is replaced. A null
    URL and one without ``://`` have an empty host and path and fit no rule, so they get
    ``default``. Of the fitting rules the longest ``host/path`` wins, then the longer host; of
    equal rules, block. Rows repeat as they do in ``pages``.

    ``rules``: a list, or a DataFrame (verdict, host, path); A-Z in hosts are lower-cased as in
    those of pages, and rows with a null are left out. Up to MAX_SENT_RULES are sent to every
    task, where each batch is sorted by its reversed-host keys and swept against the intervals.
    More are put in one order with the URLs and swept range by range (see ``_ranged``).
    """
    names = {n: f"{prefix}{n}" for n in ("host", "path", "rule", "verdict")}
    pages = pages.drop(*names.values()).withColumns({names["host"]: host_of(F.col(url_col)), names["path"]: path_of(F.col(url_col))})
    if isinstance(rules, DataFrame):
        rules = rules.select("verdict", _lower(F.col("host")).alias("host"), "path").dropna()
        if rules.count() > MAX_SENT_RULES:
            return _ranged(pages, rules, names, default)
        rules = [Rule(*r) for r in rules.collect()]
    rules = [Rule(r.verdict, r.host.translate(str.maketrans(_UPPER, _LOWER)), r.path) for r in rules]
    ship(pages.sparkSession)
    if len(rules) > MAX_SENT_RULES:
        table = pages.sparkSession.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "verdict string, host string, path string")
        return _ranged(pages, table, names, default)
    sweep, host, path = Sweep(rules), names["host"], names["path"]

    @F.pandas_udf("struct<rule string, verdict string>")
    def swept(hosts, paths):  # noqa: ANN001, ANN202
        import pandas as pd

        found = sweep.run(list(zip(hosts, paths, strict=True)))
        return pd.DataFrame({"rule": [r and r.text for r in found], "verdict": [r.verdict if r else default for r in found]}, dtype=object)

    return pages.withColumn("__found", swept(F.col(host), F.col(path))).withColumns(
        {names["rule"]: F.col("__found.rule"), names["verdict"]: F.col("__found.verdict")}
    ).drop("__found")


def _ranged(pages: DataFrame, rules: DataFrame, names: dict[str, str], default: str) -> DataFrame:
    """The sort-merge range join for any number of rules.

    A rule is the interval of keys that start with its own: its reversed host, a zero byte, its
    path. A URL is one point for its host and one for each domain around it. Intervals nest, so
    one sweep over both in key order keeps a stack of the active rules, whose last one is the
    longest for the point. Tasks take ranges of keys; a rule that is still active at the first
    key of a later range (found from these first keys, one per task) is sent there as well.
    """
    host, path = names["host"], names["path"]
    zero = F.lit("\0")
    reverse = lambda labels: F.concat(F.array_join(F.reverse(labels), "."), F.lit("."))
    labels = F.split(F.col(host), r"\.")
    around = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(reverse(F.slice(labels, i, F.size(labels))), zero, F.col(path)))
    points = pages.select(host, path).distinct().select(F.explode(around).alias("key"), F.col(host).alias("host"), F.col(path).alias("path"), F.lit(None).cast("string").alias("verdict"))
    # of equal rules, block counts
    own = rules.groupBy("host", "path").agg(F.max(F.struct((F.col("verdict") == "block").alias("b"), "verdict")).alias("x"))
    own = own.select(F.concat(reverse(F.split("host", r"\.")), zero, F.col("path")).alias("key"), "host", "path", F.col("x.verdict").alias("verdict"))
    binary = F.col("key").cast("binary")
    both = own.unionByName(points).withColumn("key", binary).withColumn("point", F.col("verdict").isNull())
    ordered = stored(both.repartitionByRange("key", "point").sortWithinPartitions("key", "point").withColumn("part", F.spark_partition_id()), "ranges")
    firsts = sorted((bytes(r.key), r.part) for r in ordered.groupBy("part").agg(F.min("key").alias("key")).collect())
    keys = [k for k, _ in firsts]

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, parts = [], []
            for i, (key, part) in enumerate(zip(b.column("key").to_pylist(), b.column("part").to_pylist(), strict=True)):
                at = bisect_left(keys, key)
                while at < len(keys) and keys[at].startswith(key):
                    if firsts[at][1] != part:
                        rows.append(i)
                        parts.append(firsts[at][1])
                    at += 1
            out = b.take(pa.array(rows, pa.int64()))
            yield out.set_column(out.schema.get_field_index("part"), "part", pa.array(parts, pa.int32()))

    active = ordered.where("not point").mapInArrow(spans, ordered.schema)
    all_rows = ordered.unionByName(active).repartition(max(1, len(firsts)), "part").sortWithinPartitions("part", "key", "point")

    def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple] = []
        now = None
        for b in batches:
            out: list[tuple] = []
            for key, h, p, verdict, point, part in zip(*(b.column(c).to_pylist() for c in ("key", "host", "path", "verdict", "point", "part")), strict=True):
                if part != now:
                    stack, now = [], part
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if not point:
                    stack.append((key, h + p, len(h), verdict))
                elif stack:
                    _, rule, n, verdict = stack[-1]
                    out.append((h, p, len(rule), n, rule, verdict))
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], names=["h", "p", "n", "hn", "rule", "verdict"])

    found = all_rows.mapInArrow(swept, "h string, p string, n long, hn long, rule string, verdict string")
    best = found.groupBy("h", "p").agg(F.max(F.struct("n", "hn", "rule", "verdict")).alias("__best"))
    best = best.select(F.col("h").alias("__h"), F.col("p").alias("__p"), "__best")
    joined = pages.join(best, (pages[host] == best["__h"]) & (pages[path] == best["__p"]), "left")
    return joined.withColumns({names["rule"]: F.col("__best.rule"), names["verdict"]: F.coalesce("__best.verdict", F.lit(default))}).drop("__best", "__h", "__p")
