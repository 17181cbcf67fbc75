"""Similarity join on word n-grams: rare-first prefix filtering, then exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, chunks, discard, ship, stored, tasks_for, utf8
from .components import Classes

#: Buckets of the frequency sketch that orders n-grams from rare to common. Its size is fixed;
#: collisions change only how well the order separates rare from common, never the result.
SKETCH_BITS = 22
_SLICE = 1 << 14
#: Bits of the fixed-size filters that stand for sets of keys; false hits are removed by a join.
FILTER_BITS = 26
#: Digests and keys that a task remembers so that it handles copies once; the exact step is later.
SEEN = 100_000
#: Sets of each prefix n-gram that all the others are compared with first.
CENTERS = 2
#: Documents of a large group that are connected among themselves in one task, and from how many
#: on a group is large.
HOME, LARGE = 256, 64
#: Rows of a prefix n-gram that one task compares with as many others.
BLOCK = 1024
#: Sets, and pairs of sets to verify, that one task takes.
SET_ROWS, PAIR_ROWS = 20_000, 2_000
#: The suffix filter counts a set's n-grams by parts of the hash range, about two to a part,
#: with as many parts as these limits allow.
_LEAST_PARTS, _MOST_PARTS = 32, 1 << 15


@dataclass(frozen=True)
class Likeness:
    """Sets link when ``per * intersection >= least * union``, in whole numbers."""

    least: int
    per: int = 100

    def prefix(self, n):  # noqa: ANN001, ANN201
        """Of ``n`` n-grams, the rarest ones of which a link must share one."""
        return n - -(-self.least * n // self.per) + 1

    def overlap(self, n, m):  # noqa: ANN001, ANN201
        """The smallest intersection that links sets of ``n`` and ``m``."""
        return -(-self.least * (n + m) // (self.per + self.least))


# --------------------------------------------------------------------------- fixed-size sketches


def _classes_of_sums(df: DataFrame) -> np.ndarray:
    """Adds up rows (slice, counts as bytes) by slice; a class from 0 to 255 for each sum."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for s, x in zip(b.column("slice").to_pylist(), b.column("counts").to_pylist(), strict=True):
                if s in sums:
                    sums[s] += np.frombuffer(x, np.uint8)
                else:
                    sums[s] = np.frombuffer(x, np.uint8).astype(np.uint32)
        for s, x in sums.items():
            ranks = np.minimum(255, 8 * np.log2(1 + x.astype(np.float32))).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([ranks.tobytes()], pa.binary())], names=["slice", "counts"])

    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    n = min(out.size // _SLICE, 64)
    for r in df.repartition(n, "slice").mapInArrow(add, df.schema).collect():  # 2**SKETCH_BITS bytes at most
        out[r.slice * _SLICE : (r.slice + 1) * _SLICE] = np.frombuffer(r.counts, np.uint8)
    return out


def rarity(docs: DataFrame, k: int, text_col: str) -> np.ndarray:
    """A class from 0 (rare) to 255 for each bucket of n-gram hashes, from counts over all texts.

    A task counts up to 255 in a bucket, which is enough to tell it from a rare one.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for b in chunks(batches, "text"):
            own = np.zeros(1 << SKETCH_BITS, np.uint32) if own is None else own
            grams, _ = Words(*utf8(b.column("text"))).shingles(k, lower=True, whole_if_short=True)
            np.add.at(own, (grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
        if own is not None:
            slices = np.minimum(own, 255).astype(np.uint8).reshape(-1, _SLICE)
            some = np.flatnonzero(slices.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([slices[i].tobytes() for i in some], pa.binary())], names=["slice", "counts"])

    return _classes_of_sums(docs.select(F.col(text_col).alias("text")).mapInArrow(count, "slice int, counts binary"))


def key_filter(keys: DataFrame, col: str) -> bytes:
    """A bit for each of ``keys`` (64-bit integers) among 2**FILTER_BITS."""
    at = F.pmod(F.col(col), F.lit(1 << FILTER_BITS))
    rows = keys.select(F.floor(at / 32768).cast("int").alias("slice"), F.pmod(at, F.lit(32768)).alias("bit"))
    out = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for r in rows.groupBy("slice").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        out[r.slice * 4096 : (r.slice + 1) * 4096] = np.frombuffer(r.bits, np.uint8)
    return out.tobytes()


def _passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys.astype(np.uint64) & np.uint64((1 << FILTER_BITS) - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def among_digests(digests: DataFrame) -> Column:
    """Whether the column digest is among ``digests``, true for a few others by chance: a filter
    of fixed size, which spares most rows the way to an exact join."""
    bits = digests.sparkSession.sparkContext.broadcast(key_filter(digests.select(F.xxhash64("digest").alias("key")), "key"))

    @F.arrow_udf("boolean")
    def hit(x: pa.Array) -> pa.Array:
        return pa.array(_passes(np.frombuffer(bits.value, np.uint8), x.to_numpy(zero_copy_only=False)))

    return hit(F.xxhash64("digest"))


# --------------------------------------------------------------------------- sets


def _sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    grams, at = Words(*utf8(texts)).shingles(k, lower=True, whole_if_short=True)
    return [np.unique(grams[at[i] : at[i + 1]]) for i in range(len(at) - 1)]


def _digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def profiles(docs: DataFrame, k: int, like: Likeness, ranks: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """One row per document: id, text_key, row_key and row_proof (hashes of id and text), n (size
    of its set), digest of the set; and, at a set's first document in a task, prefix (its rarest
    n-grams, in order) and parts (their counts by part of the hash range)."""
    keys = ["text_key", "row_key", "row_proof"]
    schema = T.StructType(
        [T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(k, T.LongType()) for k in [*keys, "n"]), T.StructField("digest", T.BinaryType())]
        + [T.StructField("prefix", T.ArrayType(T.LongType())), T.StructField("parts", T.BinaryType())]
    )

    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in chunks(batches, "text"):
            n, digest, prefix, parts = [], [], [], []
            for s in _sets(b.column("text"), k):
                d = _digest(s)
                n.append(len(s))
                digest.append(d)
                if len(s) == 0 or d in seen:
                    prefix.append(None)
                    parts.append(None)
                    continue
                if len(seen) < SEEN:
                    seen.add(d)
                order = np.argsort(sent.value[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")
                prefix.append(s[order[: like.prefix(len(s))]].view(np.int64))
                parts.append(_counts(s))
            made = [pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(prefix, pa.list_(pa.int64())), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ["id", *keys]] + made, names=schema.names)

    text = F.col(text_col)
    return docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), *row_keys(id_col, text_col, *keys[1:]), text.alias("text")
    ).mapInArrow(run, schema)


def row_keys(id_col: str, text_col: str, key: str, proof: str) -> list[Column]:
    """Two hashes that tell rows apart by id and text."""
    return [F.xxhash64(id_col, text_col).alias(key), F.xxhash64(text_col, F.lit(1), id_col).alias(proof)]


def distinct_sets(rows: DataFrame) -> DataFrame:
    """One row per set (digest, n, prefix, parts, text_key) of the rows of ``profiles``.

    Only the rows of sets that several tasks have seen move; the others are found by counting
    digests, and stay where they are.
    """
    sets = rows.where("prefix is not null").select("digest", "n", "prefix", "parts", "text_key")
    again = sets.groupBy("digest").agg(F.count("*").alias("times")).where("times > 1")
    marked = sets.withColumn("again", among_digests(again))
    first = [F.first(c).alias(c) for c in ("n", "prefix", "parts")]
    few = marked.where("again").groupBy("digest").agg(*first, F.min("text_key").alias("text_key"))
    return marked.where("not again").drop("again").unionByName(few)


def shared_prefixes(sets: DataFrame) -> DataFrame:
    """(token, size, digest, text_key, n, pos, lo, hi) of the prefix n-grams that two sets or more
    have; size is how many, lo and hi are the first and the last of them by digest.

    Most prefix n-grams are found once. They are counted, the few shared ones become a filter of
    fixed size, and only rows that pass it move on to the exact count and join.
    """
    again = sets.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count("*").alias("size")).where("size > 1")
    bits = sets.sparkSession.sparkContext.broadcast(key_filter(again, "token"))
    schema = "token long, digest binary, text_key long, n long, pos long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.frombuffer(bits.value, np.uint8)
        for b in batches:
            col = b.column("prefix")
            tokens, at = col.flatten().to_numpy(zero_copy_only=False), np.diff(col.offsets.to_numpy())
            row = np.repeat(np.arange(len(at)), at)
            pos = np.arange(len(tokens)) - np.repeat(np.cumsum(at) - at, at)
            hit = _passes(own, tokens) if len(tokens) else np.zeros(0, bool)
            take = pa.array(row[hit])
            made = [pa.array(tokens[hit], pa.int64()), *(b.column(c).take(take) for c in ("digest", "text_key", "n")), pa.array(pos[hit], pa.int64())]
            yield pa.RecordBatch.from_arrays(made, names=["token", "digest", "text_key", "n", "pos"])

    found = stored(sets.select("digest", "text_key", "n", "prefix").mapInArrow(run, schema), "found", tasks_for(sets.count(), SET_ROWS))
    one = F.struct("digest", "text_key", "n", "pos")
    centers = found.groupBy("token").agg(F.count("*").alias("size"), F.min(one).alias("lo"), F.max(one).alias("hi")).where("size > 1")
    out = stored(found.join(centers, "token").select("token", "size", "digest", "text_key", "n", "pos", "lo", "hi"), "shared", tasks_for(found.count()))
    discard(found)
    return out


def wanted_sets(docs: DataFrame, keys: DataFrame, k: int, text_col: str) -> DataFrame:
    """(digest, grams) of the texts whose key is among ``keys``: grams as sorted 64-bit integers.

    The keys are sent as a filter of fixed size; what passes it by chance does no harm.
    """
    bits = docs.sparkSession.sparkContext.broadcast(key_filter(keys, "text_key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = np.frombuffer(bits.value, np.uint8), set()
        for b in batches:
            hit = _passes(own, b.column("text_key").to_numpy())
            take = []
            for i, x in zip(np.flatnonzero(hit), b.column("text_key").to_numpy()[hit].tolist(), strict=True):
                if x not in seen:
                    if len(seen) < SEEN:
                        seen.add(x)
                    take.append(i)
            for c in chunks(iter([b.take(pa.array(take, pa.int64()))]), "text"):
                sets = _sets(c.column("text"), k)
                yield pa.RecordBatch.from_arrays([pa.array([_digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["digest", "grams"])

    rows = docs.select(F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text")).mapInArrow(run, "digest binary, grams binary")
    return rows.dropDuplicates(["digest"])


# --------------------------------------------------------------------------- verification


def _counts(s: np.ndarray) -> bytes:
    """Counts of n-grams by part of the hash range, a byte each; 255 stands for any greater one."""
    size = 1 << max((len(s) - 1) // 2, 1).bit_length()
    size = min(max(size, _LEAST_PARTS), _MOST_PARTS)
    at = (s >> np.uint64(65 - size.bit_length())).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=size), 255).astype(np.uint8).tobytes()


def _most(a: np.ndarray, b: np.ndarray) -> int:
    """The largest intersection that the counts of two sets allow; the finer ones are added up."""
    if len(a) == len(b):
        low = np.minimum(a, b)
        return int(low.sum(dtype=np.int64)) + (1 << 40) * int((low == 255).any())
    n = min(len(a), len(b))
    if a.max() == 255 or b.max() == 255:
        return 1 << 40
    return int(np.minimum(*(x.reshape(n, -1).sum(axis=1, dtype=np.int64) for x in (a, b))).sum())


def _intersection(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def suffix_filtered(pairs: DataFrame, sets: DataFrame, like: Likeness, tasks: int) -> DataFrame:
    """The pairs (a, ka, b, kb) of digests and text keys whose counts by part allow a link."""
    used = stored(sets.select("digest", "n", "parts").where(among_digests(_ends(pairs))), "parts")  # so that no task has two workers
    a, b = (used.select(F.col("digest").alias(x), F.col("n").alias(f"n{x}"), F.col("parts").alias(f"p{x}")) for x in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            need = like.overlap(batch.column("na").to_numpy(), batch.column("nb").to_numpy())
            sides = zip(batch.column("pa").to_pylist(), batch.column("pb").to_pylist(), need, strict=True)
            ok = [_most(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)) >= m for x, y, m in sides]
            yield batch.select(["a", "ka", "b", "kb"]).filter(pa.array(ok, pa.bool_()))

    out = stored(pairs.join(a, "a").join(b, "b").mapInArrow(run, "a binary, ka long, b binary, kb long"), "pairs", tasks)
    discard(used)
    return out


def _ends(pairs: DataFrame) -> DataFrame:
    """(digest, text_key) of both sides of pairs; repeats stay."""
    return pairs.select(F.explode(F.array(F.struct(F.col("a").alias("digest"), F.col("ka").alias("text_key")), F.struct(F.col("b").alias("digest"), F.col("kb").alias("text_key")))).alias("x")).select("x.*")


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, k: int, text_col: str, like: Likeness) -> DataFrame:
    """The pairs (a, b) of digests whose sets link; only the texts of these pairs are read anew.

    ``pairs`` is a stored table, which is removed."""
    left_over = suffix_filtered(pairs, sets, like, tasks_for(pairs.count(), SET_ROWS))
    grams = wanted_sets(docs, _ends(left_over), k, text_col)
    left, right = grams.select(F.col("digest").alias("a"), F.col("grams").alias("ga")), grams.select(F.col("digest").alias("b"), F.col("grams").alias("gb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                b = whole.slice(i, 512)
                sides = [(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(b.column("ga").to_pylist(), b.column("gb").to_pylist(), strict=True)]
                ok = [_intersection(x, y) >= like.overlap(len(x), len(y)) for x, y in sides]
                yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    out = stored(left_over.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "ga", "gb").mapInArrow(run, "a binary, b binary"), "links", tasks_for(left_over.count(), PAIR_ROWS))
    discard(pairs, left_over)
    return out


def _home_links(shared: DataFrame, docs: DataFrame, k: int, text_col: str, like: Likeness) -> DataFrame:
    """Links that connect large groups: each set goes once to the group of its commonest prefix
    n-gram, dealt into blocks of about HOME sets, and a task connects what links inside a block."""
    first = F.max(F.struct("size", "token", "text_key")).alias("h")
    home = shared.where(F.col("size") >= LARGE).groupBy("digest").agg(first).select("digest", "h.*")
    home = home.select("digest", "text_key", "token", F.pmod(F.xxhash64("digest"), F.ceil(F.col("size") / HOME)).alias("block"))
    home = stored(home, "home", tasks_for(shared.count()))
    grams = wanted_sets(docs, home, k, text_col)

    def run(table):  # noqa: ANN001, ANN202
        sets_ = [np.frombuffer(x, np.uint64) for x in table["grams"].to_pylist()]
        digests = table["digest"].to_pylist()
        a, b = _forest(sets_, like)
        return pa.table({"a": pa.array([digests[i] for i in a], pa.binary()), "b": pa.array([digests[i] for i in b], pa.binary())})

    out = stored(home.select("digest", "token", "block").join(grams, "digest").groupBy("token", "block").applyInArrow(run, "a binary, b binary"), "links", tasks_for(home.count(), PAIR_ROWS))
    discard(home)
    return out


def _forest(sets: list[np.ndarray], like: Likeness) -> tuple[list[int], list[int]]:
    """Links that connect all sets which links connect; no pair is compared once it is connected."""
    a, b = [], []
    classes: list[list[int]] = []
    for x in sorted(range(len(sets)), key=lambda i: len(sets[i])):
        own, rest = [x], []
        for members in classes:
            for y in members:
                need = like.overlap(len(sets[x]), len(sets[y]))
                if min(len(sets[x]), len(sets[y])) >= need and _intersection(sets[x], sets[y]) >= need:
                    a.append(x)
                    b.append(y)
                    own = [y, *(m for m in members if m != y), *own]  # who linked is asked first next time
                    break
            else:
                rest.append(members)
        classes = sorted([own, *rest], key=len, reverse=True)
    return a, b


def _star_pairs(rows: DataFrame, like: Likeness) -> DataFrame:
    """Each row of a token against CENTERS of the token's sets, the first and the last by digest;
    filtered by length and position. Distinct pairs a < b."""
    both = rows.select("*", F.explode(F.array("lo", "hi")).alias("c")).where(F.col("digest") != F.col("c.digest"))
    need = F.ceil(F.lit(like.least) * (F.col("n") + F.col("c.n")) / F.lit(like.per + like.least) - F.lit(1e-9))
    most = F.least("pos", "c.pos") + 1 + F.least(F.expr("n - pos - 1"), F.expr("c.n - c.pos - 1"))
    near = both.where((F.least("n", "c.n") * like.per >= F.greatest("n", "c.n") * like.least) & (most >= need))
    a, b = F.struct("digest", "text_key"), F.struct("c.digest", "c.text_key")
    return _pairs(near.select(F.least(a, b).alias("x"), F.greatest(a, b).alias("y")))


def _unlike(pairs: DataFrame, classes: Classes) -> DataFrame:
    """The pairs whose sets are in different classes."""
    ends = pairs
    for x in "ab":
        ends = classes.of(ends, x).withColumnRenamed("root", f"root_{x}")
    return ends.where("root_a <> root_b").select("a", "ka", "b", "kb")


def _pairs(xy: DataFrame) -> DataFrame:
    return xy.select(F.col("x.digest").alias("a"), F.col("x.text_key").alias("ka"), F.col("y.digest").alias("b"), F.col("y.text_key").alias("kb")).distinct()


def _block_pairs(rows: DataFrame, done: DataFrame, sets: DataFrame, like: Likeness, tasks: int) -> DataFrame:
    """Distinct pairs of sets of one token but different classes that pass all filters, without
    the pairs ``done`` that another token has had compared.

    ``rows``: the sets of tokens but their centers; only tokens are taken whose sets are not all
    in one class. A token's rows are dealt into blocks of about BLOCK rows, and each pair
    of blocks is a group; a row goes to as many groups as its token has blocks.
    """
    open_ = rows.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where(F.col("lo") != F.col("hi")).select("token")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = rows.join(open_, "token").withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("digest"), "blocks").cast("int"))
    open_rows = stored(dealt, "open", tasks)
    here = open_rows.join(sets.select("digest", "parts").where(among_digests(open_rows)), "digest")
    dealt = here.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "digest", "text_key", "n", "pos", "root", "parts"
    )

    def run(key, table):  # noqa: ANN001, ANN202
        i, j = key[1].as_py(), key[2].as_py()
        table = table.sort_by("n")
        n, pos, own = (table[c].to_numpy() for c in ("n", "pos", "own"))
        digests, keys, roots = (table[c].to_pylist() for c in ("digest", "text_key", "root"))
        parts = [np.frombuffer(x, np.uint8) for x in table["parts"].to_pylist()]
        label = {r: x for x, r in enumerate(dict.fromkeys(roots))}
        group = np.array([label[r] for r in roots])
        after = n - pos
        ends = np.searchsorted(n * like.least, n * like.per, "right")  # longer ones are too long
        out: list[tuple] = []
        for x in range(len(n)):
            y = slice(x + 1, int(ends[x]))
            need = like.overlap(n[x], n[y])
            ok = (group[y] != group[x]) & (np.minimum(pos[y], pos[x]) + np.minimum(after[y], after[x]) >= need)
            if i != j:
                ok &= own[y] != own[x]
            for at in np.flatnonzero(ok):
                z = x + 1 + int(at)
                if _most(parts[x], parts[z]) >= need[at]:
                    out.append(min((digests[x], keys[x], digests[z], keys[z]), (digests[z], keys[z], digests[x], keys[x])))
        a, ka, b, kb = zip(*out, strict=True) if out else ((), (), (), ())
        return pa.table({"a": pa.array(a, pa.binary()), "ka": pa.array(ka, pa.int64()), "b": pa.array(b, pa.binary()), "kb": pa.array(kb, pa.int64())})

    found = dealt.groupBy("token", "i", "j").applyInArrow(run, "a binary, ka long, b binary, kb long").distinct()
    out = stored(found.join(done.select("a", "b"), ["a", "b"], "left_anti").select("a", "ka", "b", "kb"), "pairs", tasks)
    discard(open_rows)
    return out


def near_duplicates(docs: DataFrame, k: int = 5, least_percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, row_key, row_proof, n (size of its n-gram set), root, component_id.

    Two sets link when 100 * intersection >= least_percent * union; component_id is the smallest
    id that links reach, the document itself included. Words are runs of other characters than
    space and U+0009 to U+000D, A-Z lower-cased; a text with fewer than ``k`` words is one
    n-gram; one without words, and null, has an empty set, links with nothing and is its own
    component. n-grams are compared by 64-bit hashes. Repeated rows are in one component. Null
    ids count last. An empty table gives an empty result.

    Documents with equal sets are one set. Each set's rarest n-grams (prefix) are its keys; sets
    that share a key are compared after length, position and suffix filters, each pair once and
    never inside a class that is connected already. Hot keys: first the sets of a large group are
    connected in blocks, then every set of a key is compared with one of them (rows grow with the
    key's size, not its square), and then what is still unconnected block by block.
    """
    ship(docs.sparkSession)
    like = Likeness(least_percent)
    rows = stored(profiles(docs, k, like, rarity(docs, k, text_col), id_col, text_col), "profiles")
    total = rows.count()
    sets = stored(distinct_sets(rows), "sets", tasks_for(total, SET_ROWS))
    plain = stored(rows.select("id", "row_key", "row_proof", "n", "digest"), "plain", tasks_for(total))
    discard(rows)
    shared = shared_prefixes(sets)
    tasks = tasks_for(CENTERS * shared.count())
    classes = Classes()
    classes.add(_home_links(shared, docs, k, text_col, like))
    pairs = stored(_star_pairs(shared, like), "pairs", tasks)
    open_pairs = stored(_unlike(pairs, classes), "pairs", tasks)
    classes.add(verified(open_pairs, sets, docs, k, text_col, like))
    # the centers of a token have been compared with all its sets
    center = (F.col("digest") == F.col("lo.digest")) | (F.col("digest") == F.col("hi.digest"))
    others = shared.where((F.col("size") > CENTERS + 1) & ~center).select("token", "size", "digest", "text_key", "n", "pos")
    classes.add(verified(_block_pairs(classes.of(others, "digest"), pairs, sets, like, tasks), sets, docs, k, text_col, like))
    discard(pairs)
    out = classes.of(plain, "digest")
    # a class of one set has a link with nothing, but its copies share a component all the same
    smallest = stored(out.where("n > 0").groupBy("root").agg(F.min("id").alias("component_id")), "smallest", tasks_for(total))
    out = out.join(smallest, "root", "left").select("id", "row_key", "row_proof", "n", "root", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
    out = stored(out, "components", tasks_for(total, 2 * SET_ROWS))
    discard(plain, sets, shared, smallest, *classes.files())
    return out


def keep_smallest(docs: DataFrame, k: int = 5, least_percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of each component, with all their columns.

    Of rows that repeat with that id, one stays; documents without words all stay. Rows are told
    apart by two hashes of id and text.
    """
    keys = ["row_key", "row_proof"]
    found = near_duplicates(docs, k, least_percent, id_col, text_col).where("n > 0")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", *keys)).alias("x")
    best = stored(found.groupBy("root").agg(first).select("x.row_key", "x.row_proof"), "best")
    # most rows are the only one of their component: those outside this filter of fixed size stay
    # without moving; the others are looked up among the best
    gone = found.join(best, keys, "left_anti").select("row_key").unionByName(found.groupBy(*keys).count().where("count > 1").select("row_key"))
    bits = docs.sparkSession.sparkContext.broadcast(key_filter(gone.distinct(), "row_key"))

    @F.arrow_udf("boolean")
    def suspect(x: pa.Array) -> pa.Array:
        return pa.array(_passes(np.frombuffer(bits.value, np.uint8), x.to_numpy(zero_copy_only=False)))

    worded = F.coalesce(F.rlike(text_col, F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    own = docs.withColumns(dict(zip(("__row_key", "__row_proof"), row_keys(id_col, text_col, *keys), strict=True))).withColumn("__look", worded & suspect("__row_key"))
    looked = own.where("__look").join(best.toDF("__row_key", "__row_proof"), ["__row_key", "__row_proof"]).dropDuplicates(["__row_key", "__row_proof"])
    return own.where("not __look").select(*docs.columns).unionByName(looked.select(*docs.columns))
