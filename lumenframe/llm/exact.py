"""Exact deduplication by a tree-merge of sorted digest runs (DataFrame operations only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

#: Runs that one merge takes in at most.
FAN_IN = 8


def normalised(text: Column) -> Column:
    """``text`` without space and U+0009 to U+000D; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for c in " \t\n\x0b\f\r":
        out = F.replace(out, F.lit(c))
    return out


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, digest, a second independent digest, code points, its run.

    A run is what one partition of ``docs`` holds. Extra columns are not read.
    """
    norm = normalised(F.col(text_col))
    return docs.select(
        F.col(id_col).alias("id"), norm.alias("norm"), F.coalesce(F.length(text_col), F.lit(0)).cast("long").alias("chars")
    ).select(
        "id",
        F.unhex(F.sha2("norm", 256)).alias("digest"),
        F.xxhash64("norm").alias("proof"),
        "chars",
        F.spark_partition_id().alias("run"),
    )


def rounds_of(runs: int, fan_in: int = FAN_IN) -> tuple[int, int]:
    """(rounds, radix): the fewest rounds of at most ``fan_in`` runs each, then the smallest radix."""
    rounds = 1
    while fan_in**rounds < runs:
        rounds += 1
    radix = 1
    while radix**rounds < runs:
        radix += 1
    return rounds, radix


def merge_runs(rows: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """The winner of each digest: most code points, then smallest id (null last).

    A tree of binomial rounds. Runs are numbered in base ``radix``; in round k, the runs whose
    numbers differ in digit k alone exchange rows: each takes the digests that have its own digit
    there. What a run has got is sorted by digest, and equal digests are merged into the better
    one, so only one row per digest and run moves on; after the last round a digest is in one
    run. In the first round rows are merged before they move as well, so copies within a task
    are one row. A digest counts as equal only together with ``proof``, at each level. Runs hold
    equal shares of the digests, whatever the groups' sizes. Returns digest, proof, best, copies.
    """
    best = F.struct((-F.col("chars")).alias("less"), F.col("id").isNull().alias("none"), F.col("id").alias("id"))
    rounds, radix = rounds_of((rows.agg(F.max("run")).first()[0] or 0) + 1, fan_in)
    level = rows.select("run", "digest", "proof", best.alias("best"), F.lit(1).cast("long").alias("copies"))
    for k in range(rounds):
        target = F.pmod(F.xxhash64("digest"), F.lit(radix**rounds))
        digit = lambda x, k=k: F.floor(x / radix**k) % radix
        level = level.withColumn("run", (F.col("run") + (digit(target) - digit(F.col("run"))) * radix**k).cast("int"))
        if k:
            level = level.repartitionById(radix**rounds, F.col("run"))
        level = level.groupBy("run", "digest", "proof").agg(F.min("best").alias("best"), F.sum("copies").alias("copies"))
    return level.drop("run")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, keep_id, group_size, kept, digest (binary).

    Null text equals empty text. Empty texts are one group. A null id loses against any other.
    Repeated rows (same id, text length and digest) count each; one of them is kept. An empty
    table gives an empty result. Hot groups: copies shrink to one row per run before they move,
    and the last join's large side is one that Spark splits when a key is skewed.
    """
    rows = checkpointed(digests(docs, id_col, text_col))
    best = merge_runs(rows).select("digest", "proof", F.col("best.id").alias("keep_id"), (-F.col("best.less")).alias("keep_chars"), "copies")
    same = rows.groupBy("digest", "proof", "chars", "id").agg(F.count("*").alias("times"))
    won = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
    return same.join(best, ["digest", "proof"]).select(
        "id", "keep_id", F.col("copies").alias("group_size"), won.alias("won"), "digest", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("turn")
    ).select("id", "keep_id", "group_size", (F.col("won") & (F.col("turn") == 1)).alias("kept"), "digest")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that exact deduplication keeps, with all their columns."""
    rows = checkpointed(digests(docs, id_col, text_col))
    row = lambda id_, chars: F.xxhash64("__digest", "__proof", chars, id_)  # noqa: E731  tells the rows of a digest apart
    best = merge_runs(rows).select(F.col("digest").alias("__digest"), F.col("proof").alias("__proof"), "best.*")
    winners = best.select("__digest", row(F.col("id"), -F.col("less")).alias("__row"))
    norm = normalised(F.col(text_col))
    # never null, so that the join adds no test that would digest each text once more
    own = docs.withColumns({"__digest": F.coalesce(F.unhex(F.sha2(norm, 256)), F.lit(b"")), "__proof": F.xxhash64(norm)})
    own = own.withColumn("__row", row(F.col(id_col), F.coalesce(F.length(text_col), F.lit(0)).cast("long")))
    return own.join(winners, ["__digest", "__row"]).dropDuplicates(["__digest", "__row"]).select(*docs.columns)
