"""Mixing overlapping sources to target weights by a min-cost flow over membership patterns."""

from __future__ import annotations

import functools
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import Words, chunks, ship, stored, utf8

#: Patterns up to which their plan is sent to every task; a larger plan meets the rows by a join.
SENT_PATTERNS = 100_000
#: Bits of the seeded hash that name a slice of a pattern; only one slice is ever sorted.
SLICE_BITS = 12
#: Rounds that fill what is left of a pattern's quota with the best fitting documents.
FILL_ROUNDS = 3

WEIGHTS = (3, 1, 2)


# --------------------------------------------------------------------------- quotas and flow


def water_fill(sizes: list[int], weights: list[float], total: float, cap: float = 2.0) -> list[float]:
    """Shares of ``total`` by weight, none above ``cap`` times its size.

    What a capped share leaves is dealt anew among the others by weight until none is above;
    if all are capped, the rest of ``total`` is not dealt.
    """
    out = [0.0] * len(sizes)
    live = [i for i in range(len(sizes)) if weights[i] > 0]
    left = float(total)
    while live:
        by = sum(weights[i] for i in live)
        full = [i for i in live if left * weights[i] / by >= cap * sizes[i]]
        if not full:
            for i in live:
                out[i] = left * weights[i] / by
            break
        for i in full:
            out[i] = float(cap * sizes[i])
        left -= sum(out[i] for i in full)
        live = [i for i in live if i not in set(full)]
    return out


def cycled_targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> dict[str | None, float]:
    """Targets of sources by code point, null last, whose weights repeat ``weights``."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    got = water_fill([sizes[n] for n in names], [weights[i % len(weights)] for i in range(len(names))], share * sum(sizes.values()), cap)
    return dict(zip(names, got, strict=True))


def route(patterns: list[tuple[tuple, int]], quotas: dict, max_repeat: int = 2) -> list[dict]:
    """Tokens from each pattern to each of its sources: a maximum flow of least cost.

    ``patterns``: (sources, capacity). The n-th repetition of a pattern's tokens costs n, which
    is convex, so the levels are opened one by one and each is filled by augmenting paths; a
    path's cost is that of its first edge, and so the flow after each level has least cost.
    """
    flow: list[dict] = [dict.fromkeys((s for s in members if s in quotas), 0) for members, _ in patterns]
    into: dict = {s: 0 for s in quotas}
    users: dict = {s: [] for s in quotas}
    for p, f in enumerate(flow):
        for s in f:
            users[s].append(p)
    for _ in range(max_repeat):
        free = [size for _, size in patterns]
        for p, f in enumerate(flow):  # straight paths first
            for s in f:
                x = min(free[p], quotas[s] - into[s])
                if x > 0:
                    f[s] += x
                    into[s] += x
                    free[p] -= x
        if all(len(f) < 2 for f in flow):
            continue
        for p in range(len(patterns)):
            while free[p] > 0 and (path := _augment(p, flow, into, users, quotas)):
                x = min(free[p], quotas[path[-1]] - into[path[-1]], *(flow[path[i + 1]][path[i]] for i in range(1, len(path) - 1, 2)))
                for i in range(0, len(path), 2):
                    flow[path[i]][path[i + 1]] += x
                    if i:
                        flow[path[i]][path[i - 1]] -= x
                into[path[-1]] += x
                free[p] -= x
    return flow


def _augment(start: int, flow: list[dict], into: dict, users: dict, quotas: dict) -> list | None:
    """Shortest path pattern, source, pattern, source, ... to a source with room."""
    came: dict = {}
    via: dict = {}
    todo, seen = deque([start]), {start}
    while todo:
        p = todo.popleft()
        for s in flow[p]:
            if s in came:
                continue
            came[s] = p
            if into[s] < quotas[s]:
                path = [s]
                while True:
                    path.append(q := came[path[-1]])
                    if q == start:
                        return path[::-1]
                    path.append(via[q])
            for q in users[s]:
                if q not in seen and flow[q][s] > 0:
                    seen.add(q)
                    via[q] = s
                    todo.append(q)
    return None


# --------------------------------------------------------------------------- documents


def word_sizes(docs: DataFrame, id_col: str, members: Column, text_col: str, seed: int) -> DataFrame:
    """One row per document: id, members (array of sources), size in words, a seeded hash h."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("members", T.ArrayType(T.StringType())), T.StructField("h", T.LongType()), T.StructField("size", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            n = Words(*utf8(b.column("text"))).counts
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("members"), b.column("h"), pa.array(n, pa.int64())], names=["id", "members", "h", "size"])

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), members.alias("members"), F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("h"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, schema)


def mix(
    docs: DataFrame,
    targets: Callable[[dict], dict],
    members: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_repeat: int = 2,
    seed: int = 17,
) -> DataFrame:
    """How often the mix takes each document: id, members, size, repeats, taken, source_sizes, targets.

    ``members``: array of the sources that a document belongs to; ``targets`` turns the sources'
    sizes in words into targets in words. Documents are aggregated by membership pattern; the
    flow gives each pattern its words; within a pattern, documents in the order of a seeded hash
    are taken until its words are reached, the documents that fit best fill what is left, and of
    one more only as many words are taken as are still missing (``taken`` counts them, ``repeats``
    doesn't).
    Every document of a pattern is taken n times before one is taken n + 1 times, and none more
    than ``max_repeat`` times. The result does not depend on partitions; reruns agree.

    A null text has size 0; documents of size 0 are never taken. Null is a source like others.
    Repeated rows (equal id and text) are one row with a count until the end, and as many of
    them are taken as fit. An empty table gives an empty result. Sums by pattern and by slice of
    a pattern are made before rows move; only one slice in 2**SLICE_BITS of a pattern is sorted
    in one task. The driver holds one row per pattern, not per document.
    """
    plan = planned(docs, targets, members, id_col, text_col, max_repeat, seed)
    spark = docs.sparkSession
    part_df = _sent(spark, plan.parts, "pattern string, h long, part long")
    sizes = _sent(spark, [(p, ss, ts) for p, _, _, ss, ts in plan.patterns], "pattern string, source_sizes array<long>, targets array<double>")
    out = plan.marked.drop("rest").join(part_df, ["pattern", "h"], "left").join(sizes, "pattern").withColumn("turn", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    out = out.withColumn("part", F.when(F.expr("turn = more + 1"), F.coalesce("part", F.lit(0))).otherwise(0))
    out = out.withColumn("repeats", F.when(F.col("size") > 0, F.col("whole") + F.expr("turn <= more").cast("long")).otherwise(0))
    return out.select("id", "members", "size", "repeats", (F.col("size") * F.col("repeats") + F.col("part")).alias("taken"), "source_sizes", "targets", "h", "part")


@dataclass
class Plan:
    """What the mix takes, by pattern.

    ``patterns``: pattern, times that each document is taken, words missing then, sizes and
    targets of its sources. ``limits``: pattern, whole, rest, and the slice and hash up to which
    documents are taken once more. ``extra``: pattern, hash and number of the other rows that are
    taken once more. ``parts``: pattern, hash and words of the row taken in part. ``marked``: the
    sized rows with ``more``, how many of a row's copies are taken once more.
    """

    patterns: list[tuple]
    limits: list[tuple]
    extra: list[tuple]
    parts: list[tuple]
    marked: DataFrame


_LIMITS = "pattern string, whole long, rest long, edge long, cut long"


def _is_first(slice_: Column) -> Column:
    """Whether a row comes before its pattern's limit."""
    inside = (slice_ < F.col("edge")) | ((slice_ == F.col("edge")) & F.coalesce(F.col("h") <= F.col("cut"), F.lit(False)))
    return inside & (F.col("rest") > 0)


def planned(docs: DataFrame, targets: Callable[[dict], dict], members: Column, id_col: str = "doc_id", text_col: str = "text", max_repeat: int = 2, seed: int = 17) -> Plan:
    """The plan of ``mix``, which holds few rows per pattern."""
    spark = docs.sparkSession
    sized = word_sizes(docs, id_col, F.sort_array(F.array_distinct(members)), text_col, seed).withColumn("pattern", F.to_json("members"))
    rows = stored(sized.groupBy("pattern", "id", "h", "size").agg(F.first("members").alias("members"), F.count("*").alias("copies")), "sizes")
    all_words = (F.col("size") * F.col("copies")).alias("size")
    found = rows.groupBy("pattern").agg(F.first("members").alias("members"), F.sum(all_words).alias("size")).collect()
    found.sort(key=lambda r: r.pattern)
    sizes: dict = {}
    for r in found:
        for s in r.members:
            sizes[s] = sizes.get(s, 0) + r.size
    wanted = targets(sizes)
    flow = route([(tuple(r.members), r.size) for r in found], {s: round(t) for s, t in wanted.items()}, max_repeat)
    plan = []
    for r, f in zip(found, flow, strict=True):
        words = min(sum(f.values()), max_repeat * r.size)
        whole = words // r.size if r.size else 0
        plan.append((r.pattern, int(whole), int(words - whole * r.size), [sizes[s] for s in r.members], [float(wanted[s]) for s in r.members]))
    plan_df = _sent(spark, [(p, r) for p, _, r, _, _ in plan], "pattern string, rest long")

    slice_ = F.shiftrightunsigned("h", 64 - SLICE_BITS)
    sums = rows.groupBy("pattern", slice_.alias("slice")).agg(F.sum(all_words).alias("size"))
    upto = F.sum("size").over(Window.partitionBy("pattern").orderBy("slice"))
    edges = (
        sums.withColumn("upto", upto).join(plan_df, "pattern").where("upto > rest").groupBy("pattern", "rest").agg(F.min(F.struct("slice", F.expr("upto - size").alias("before"))).alias("x"))
        .select("pattern", "rest", "x.slice", "x.before").collect()
    )
    edge_df = _sent(spark, [tuple(e) for e in edges], "pattern string, rest long, slice long, before long")
    inside = rows.withColumn("slice", slice_).join(edge_df, ["pattern", "slice"])
    upto = F.col("before") + F.sum(all_words).over(Window.partitionBy("pattern").orderBy("h"))
    cuts = {r.pattern: r.cut for r in inside.select("pattern", "h", "rest", upto.alias("upto")).where("upto <= rest").groupBy("pattern").agg(F.max("h").alias("cut")).collect()}
    edge = {e.pattern: e.slice for e in edges}
    limits = [(p, w, r, edge.get(p, 1 << SLICE_BITS), cuts.get(p)) for p, w, r, _, _ in plan]
    marked = rows.join(_sent(spark, limits, _LIMITS), "pattern").withColumn("more", F.when(_is_first(slice_), F.col("copies")).otherwise(0))

    extra: list[tuple[str, int, int]] = []
    for _ in range(FILL_ROUNDS):
        now = _with_extra(spark, marked, extra)
        left = _left(now)
        fits = now.where("more < copies and size > 0").join(left, "pattern").where("size <= left")
        best = fits.groupBy("pattern").agg(F.max(F.struct("size", "h", F.least(F.expr("copies - more"), F.expr("left div size")).alias("n"))).alias("x")).select("pattern", "x.h", "x.n").collect()
        if not best:
            break
        extra += [tuple(r) for r in best]
    now = _with_extra(spark, marked, extra)
    best = now.where("more < copies and size > 0").groupBy("pattern").agg(F.max(F.struct("size", "id", "h")).alias("x"))
    parts = [tuple(r) for r in best.join(_left(now), "pattern").select("pattern", "x.h", F.least("x.size", "left").alias("part")).collect()]
    return Plan(plan, limits, extra, parts, now)


def _sent(spark, rows: list[tuple], schema: str) -> DataFrame:  # noqa: ANN001
    """A table of one row per pattern, sent to every task if it is small."""
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= SENT_PATTERNS else df


def _few(rows: DataFrame) -> DataFrame:
    """``rows``, a few for each pattern, sent to every task if they are few indeed."""
    return F.broadcast(rows) if rows.count() <= SENT_PATTERNS else rows


def _left(now: DataFrame) -> DataFrame:
    """Words that each pattern still misses."""
    return now.groupBy("pattern").agg((F.first("rest") - F.sum(F.col("more") * F.col("size"))).alias("left")).where("left > 0")


def _with_extra(spark, marked: DataFrame, extra: list[tuple[str, int, int]]) -> DataFrame:  # noqa: ANN001
    if not extra:
        return marked
    sums: dict = {}
    for p, h, n in extra:
        sums[p, h] = sums.get((p, h), 0) + n
    added = _sent(spark, [(p, h, n) for (p, h), n in sums.items()], "pattern string, h long, added long")
    return marked.join(added, ["pattern", "h"], "left").withColumn("more", F.col("more") + F.coalesce("added", F.lit(0))).drop("added")


def mixed(docs: DataFrame, targets: Callable[[dict], dict], members: Column, id_col: str = "doc_id", text_col: str = "text", max_repeat: int = 2, seed: int = 17) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as ``mix`` takes them, with all their columns.

    How often a row is taken follows from its pattern's limits and its hash, so rows don't move;
    the few rows of a pattern that are taken besides are named one by one. Of repeated rows that
    are taken in part of their number, copies are written and numbered within each task, after
    the copies of earlier tasks. The document that a pattern takes in part, one at most, is cut
    after that many words. Null and empty texts are never taken.
    """
    plan = planned(docs, targets, members, id_col, text_col, max_repeat, seed)
    spark = docs.sparkSession
    names = {"__id": F.col(id_col), "h": F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)), "pattern": F.to_json(F.sort_array(F.array_distinct(members)))}
    own = docs.select(F.struct("*").alias("doc"), *[c.alias(n) for n, c in names.items()]).where(F.rlike(F.col("doc")[text_col], F.lit(r"[^\x20\x09-\x0D]")))
    sums: dict = {}
    for p, h, n in plan.extra:
        sums[p, h] = sums.get((p, h), 0) + n
    extra = _sent(spark, [(p, h, n) for (p, h), n in sums.items()], "pattern string, h long, added long")
    slice_ = F.shiftrightunsigned("h", 64 - SLICE_BITS)
    rows = own.join(_sent(spark, plan.limits, _LIMITS), "pattern").join(extra, ["pattern", "h"], "left").withColumn("times", F.col("whole") + _is_first(slice_).cast("long"))
    # the rows that are named: number each key's copies, then the first ``added`` count once more
    key = ["pattern", "h", "__id"]
    few = stored(rows.where("added IS NOT NULL").select("doc", *key, "whole", "added"), "named")
    few = few.withColumn("task", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id())  # the same in each reading of the files
    here = few.groupBy(*key, "task").agg(F.count("*").alias("here"))
    before = here.withColumn("before", F.sum("here").over(Window.partitionBy(*key).orderBy("task")) - F.col("here"))
    place = F.row_number().over(Window.partitionBy(*key, "task").orderBy("row"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*key, "task")]
    few = few.withColumn("place", place).alias("a").join(before.alias("b"), functools.reduce(lambda x, y: x & y, same))
    few = few.select("a.doc", F.expr("a.whole + if(b.before + a.place <= a.added, 1, 0)").alias("times"))
    out = rows.where("added IS NULL").select("doc", "times").unionByName(few).where("times > 0")
    out = out.withColumn("turn", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select("doc.*")
    parts = _sent(spark, plan.parts, "pattern string, h long, part long")

    @F.udf("string")
    def first_words(text, n):  # noqa: ANN001, ANN202
        data, offsets = utf8(pa.array([text]))
        return data.tobytes()[: int(Words(data, offsets).ends[n - 1])].decode()

    cut = own.join(parts, ["pattern", "h"]).dropDuplicates(key).select("doc.*", "part")
    return out.unionByName(cut.withColumn(text_col, first_words(F.col(text_col), F.col("part"))).select(*docs.columns))


def _keyed(docs: DataFrame, id_col: str, text_col: str, seed: int) -> DataFrame:
    return docs.withColumns({"__id": F.col(id_col), "__h": F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))})


def _same(a: DataFrame, b: DataFrame) -> Column:
    return (a["__h"] == b["__key"]) & a["__id"].eqNullSafe(b["__of"])


def repeated(docs: DataFrame, mixed_rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 17) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as ``mixed_rows`` takes them whole, with all their columns.

    Repeated rows of which only some are taken (few such rows in a pattern, but each may have
    many copies) are written and numbered: within each task, after the copies of earlier tasks.
    """
    times = mixed_rows.groupBy(F.col("id").alias("__of"), F.col("h").alias("__key")).agg(F.min("repeats").alias("__lo"), F.max("repeats").alias("__hi"), F.count_if(F.col("part") > 0).alias("__cut"), F.sum("repeats").alias("__sum"), F.count("*").alias("__copies"))
    times = stored(times.where("__hi > 0").withColumn("__more", F.expr("__sum - __copies * __lo")), "times")
    own = _keyed(docs, id_col, text_col, seed)
    even = times.where("__lo = __hi").select("__of", "__key", "__lo", "__hi", "__more")
    odd = _few(times.where("__lo < __hi").select("__of", "__key", "__lo", "__hi", "__more"))
    rows = own.join(even, _same(own, even)).withColumn("__n", F.col("__lo"))
    some = stored(own.join(odd, _same(own, odd)), "named")
    some = some.withColumn("__task", F.spark_partition_id()).withColumn("__row", F.monotonically_increasing_id())  # the same in each reading of the files
    before = some.groupBy("__key", "__of", "__task").agg(F.count("*").alias("__here"))
    before = before.withColumn("__before", F.sum("__here").over(Window.partitionBy("__key", "__of").orderBy("__task")) - F.col("__here"))
    before = before.select(F.col("__key").alias("__k"), F.col("__of").alias("__o"), F.col("__task").alias("__t"), "__before")
    place = F.row_number().over(Window.partitionBy("__key", "__of", "__task").orderBy("__row"))
    some = some.withColumn("__place", place)
    some = some.join(before, (some["__key"] == before["__k"]) & some["__of"].eqNullSafe(before["__o"]) & (some["__task"] == before["__t"]))
    some = some.withColumn("__n", F.expr("if(__before + __place <= __more, __hi, __lo)"))
    both = rows.select(*docs.columns, "__n").unionByName(some.select(*docs.columns, "__n")).where("__n > 0")
    return both.withColumn("__turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n")))).select(*docs.columns)
