"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored, tasks_for

#: Rounds allowed; paths shrink geometrically, so this is never reached in practice.
MAX_ROUNDS = 60


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node with a link; ``root`` is the smallest node of its component.

    Null ends and links of a node with itself are ignored; links may repeat. Each round joins
    every node's links with the smallest neighbour (an aggregate with one row per node), so a
    node with very many links is the skewed, splittable side of its join. Links never grow in
    number, so each round runs in as many tasks as their count at the start deserves; the files
    of a round go when the next one is written.
    """
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u is not null and v is not null and u <> v").distinct(), "links")
    state = _state(edges)
    tasks = tasks_for(2 * state[0])
    for _ in range(MAX_ROUNDS):
        if state[0] == 0:
            break
        # large star: each node's greater neighbours link to its smallest one (or itself)
        own = edges.coalesce(tasks)
        both = own.unionByName(own.select(F.col("v").alias("u"), F.col("u").alias("v"))).coalesce(tasks)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").coalesce(tasks).distinct()
        # small star: each node and its smaller neighbours link to the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v")
        before, edges = edges, stored(small.coalesce(tasks).distinct(), "links", tasks)
        discard(before)
        now = _state(edges)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"links were not contracted in {MAX_ROUNDS} rounds")
    # now each node but the roots has one link, to its root
    out = edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    out.__dict__["_stored_at"] = edges.__dict__["_stored_at"]
    return out


class Classes:
    """Classes of nodes that links join; each batch of links is contracted to roots first."""

    def __init__(self) -> None:
        self.roots: DataFrame | None = None

    def of(self, rows: DataFrame, node: str) -> DataFrame:
        """``rows`` with ``root``, the smallest node of the class of ``node``."""
        if self.roots is None:
            return rows.withColumn("root", F.col(node))
        return rows.join(self.roots.withColumnRenamed("node", node), node, "left").withColumn("root", F.coalesce("root", node))

    def add(self, links: DataFrame) -> None:
        """Joins the classes of the ends of ``links`` (a, b), a stored table that is then removed."""
        n = links.count()
        if n:
            ends = links.select("a", "b")
            for x in "ab" if self.roots is not None else "":
                ends = self.of(ends, x).drop(x).withColumnRenamed("root", x)
            new, old = connected(ends), self.roots
            if old is None:
                out, most = new, 2 * n
            else:
                out = old.join(new.toDF("old", "new"), F.col("root") == F.col("old"), "full_outer")
                out, most = out.select(F.coalesce("node", "old").alias("node"), F.coalesce("new", "root").alias("root")), old.count() + 2 * n
            self.roots = stored(out, "roots", tasks_for(most))
            discard(new, *([old] if old is not None else []))
        discard(links)

    def files(self) -> list[DataFrame]:
        """The stored tables that ``of`` reads."""
        return [] if self.roots is None else [self.roots]


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]
