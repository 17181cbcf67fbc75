"""Packing documents into training sequences by minimum bin slack over length counts."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import chunks, ship, stored

#: Pieces of text whose ids a worker remembers; it starts anew beyond that.
MAX_PIECES = 400_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LETTERS = "a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
_LATIN = re.compile(rf"[{_LETTERS}]+")
_MARKS = r"!-&(-/:-@\[-`{-~"
#: Where white space, runs of Latin letters, of ASCII marks without the apostrophe and of digits
#: meet, this tokenizer always ends a token. Anything else stays whole up to white space.
_PIECE = re.compile(
    rf"[{_LETTERS}]+(?=[\x20\x09-\x0D0-9{_MARKS}]|\Z)|[{_MARKS}]+(?=[\x20\x09-\x0D0-9{_LETTERS}]|\Z)|[0-9]+(?=[\x20\x09-\x0D{_MARKS}{_LETTERS}]|\Z)|[^\x20\x09-\x0D]+"
)


# --------------------------------------------------------------------------- the plan


@dataclass(frozen=True)
class Pattern:
    """``times`` windows that each hold ``counts`` (length, pieces of it)."""

    counts: tuple[tuple[int, int], ...]
    times: int

    @property
    def total(self) -> int:
        return sum(n * k for n, k in self.counts)


def closest_fill(counts: dict[int, int], must: int, capacity: int) -> dict[int, int]:
    """The multiset of lengths with one ``must`` whose sum is closest to ``capacity``, not above.

    A bitset (a Python integer) holds the sums that can be reached; each length is added in
    binary portions of its count. The portions are then walked back from the best sum.
    """
    room = capacity - must
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for n in sorted(counts, reverse=True):
        left = min(counts[n] - (n == must), room // n)
        portion = 1
        while left > 0 and not reach >> room & 1:
            k = min(portion, left)
            grown = reach | reach << n * k & mask
            if grown != reach:
                steps.append((n, k, reach))
                reach = grown
            left -= k
            portion *= 2
    at = reach.bit_length() - 1
    out = {must: 1}
    for n, k, before in reversed(steps):
        if not before >> at & 1:
            out[n] = out.get(n, 0) + k
            at -= n * k
    return out


def plan_windows(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Windows for all pieces: the longest piece left opens a window, the closest fill joins it.

    A fill repeats for as long as its lengths last, so the number of patterns follows the number
    of distinct lengths and not the number of pieces.
    """
    left = {n: k for n, k in counts.items() if k > 0}
    out = []
    while left:
        must = max(left)
        fill = closest_fill(left, must, capacity)
        times = min(left[n] // k for n, k in fill.items())
        out.append(Pattern(tuple(sorted(fill.items(), reverse=True)), times))
        for n, k in fill.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return out


class Layout:
    """Where the piece of a length with a given rank lies.

    Windows of full patterns come first, one sequence each. What short windows hold is laid end
    to end and cut every ``capacity`` tokens; the last stretch is cut into powers of two, which
    need no padding. So a piece lies whole in one sequence unless its window had slack.
    """

    def __init__(self, patterns: list[Pattern], capacity: int) -> None:
        self.capacity = capacity
        full = [p for p in patterns if p.total == capacity]
        short = [p for p in patterns if p.total < capacity]
        #: Lengths in windows with slack, which may be cut; no others are.
        self.cut_lengths = sorted({n for p in short for n, _ in p.counts})
        self.full_windows = sum(p.times for p in full)
        rows: dict[int, list[tuple[int, int, int, int, int, int]]] = {}
        used: dict[int, int] = {}
        window, stream = 0, 0
        for p in full + short:
            whole, at = p.total == capacity, 0
            for n, k in p.counts:
                rows.setdefault(n, []).append((used.get(n, 0), k, at, int(whole), window if whole else stream, p.total))
                used[n] = used.get(n, 0) + k * p.times
                at += n * k
            if whole:
                window += p.times
            else:
                stream += p.total * p.times
        self.stream = stream
        self.rows = {n: np.array(r, dtype=np.int64) for n, r in rows.items()}
        tail = stream % capacity
        ends, at = [], stream - tail
        for bit in range(capacity.bit_length(), -1, -1):
            if tail >> bit & 1:
                at += 1 << bit
                ends.append(at)
        self.tail_ends = np.array(ends, dtype=np.int64)

    def places(self, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Stream position (or -1) and window * capacity + offset (or -1) of each rank."""
        t = self.rows[length]
        i = np.searchsorted(t[:, 0], ranks, side="right") - 1
        first, k, at, whole, base, total = t[i].T
        turn, slot = np.divmod(ranks - first, k)
        inside = at + slot * length
        return np.where(whole == 1, -1, base + turn * total + inside), np.where(whole == 1, (base + turn) * self.capacity + inside, -1)

    def cut(self, at: int, length: int) -> list[tuple[int, int, int, int]]:
        """(from, length, sequence, offset) of the parts of a piece at stream position ``at``."""
        out, done = [], 0
        while done < length:
            pos = at + done
            body = self.stream - self.stream % self.capacity
            if pos < body:
                seq, off = divmod(pos, self.capacity)
                room = self.capacity - off
            else:
                j = int(np.searchsorted(self.tail_ends, pos, side="right"))
                begin = int(self.tail_ends[j - 1]) if j else body
                seq, off, room = body // self.capacity + j, pos - begin, int(self.tail_ends[j]) - pos
            part = min(room, length - done)
            out.append((done, part, self.full_windows + seq, off))
            done += part
        return out


# --------------------------------------------------------------------------- tokens


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level model: itself if it can be printed."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + rest.index(b)) for b in range(256)]


class _Learned(dict):
    """A dict that asks ``made`` for what it doesn't hold, and keeps it."""

    def __init__(self, made: Callable[[str], bytes]) -> None:
        super().__init__()
        self.made = made

    def __missing__(self, key: str) -> bytes:
        out = self[key] = self.made(key)
        return out


class TokenBytes:
    """``ids``: piece -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.ids = _Learned(self._ids)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.digits = {c: self._whole(c) for c in "0123456789"}

    def _whole(self, piece: str) -> bytes:
        return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    def _ids(self, piece: str) -> bytes:
        if piece.isascii():
            if piece.isdigit():
                return b"".join(map(self.digits.__getitem__, piece))
            if piece.isalpha() and piece.islower():  # one word, as the model itself sees it
                return array("I", [x.id for x in self.model.tokenize(piece)]).tobytes()
        elif _LATIN.fullmatch(piece):
            word = "".join(map(self.letters.__getitem__, piece.lower().encode()))
            return array("I", [x.id for x in self.model.tokenize(word)]).tobytes()
        return self._whole(piece)


_LOADED: dict[str, TokenBytes] = {}


def pieces_of(text: str) -> list[str]:
    """Parts of a text whose ids, put together, are the text's; A-Z as a-z."""
    if "<|" in text:  # may name a special token
        return _WORD.findall(text)
    return _PIECE.findall(text.lower() if text.isascii() else text.encode().lower().decode())


def encode(texts: list[str | None], path: str, end_id: int) -> Iterator[bytes]:
    """The ids of each text, then ``end_id``, as little-endian unsigned 32-bit integers."""
    known = _LOADED.get(path) or _LOADED.setdefault(path, TokenBytes(path))
    end = np.array([end_id], dtype="<u4").tobytes()
    if len(known.ids) > MAX_PIECES:
        known.ids.clear()
    for t in texts:
        yield b"".join(map(known.ids.__getitem__, pieces_of(t))) + end if t else end


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids (then ``end_id``) give full pieces of ``capacity`` and one rest. The counts
    of all lengths (at most ``capacity`` numbers, whatever the input's size) go to the driver,
    which plans the windows; each piece then finds its place from its rank among pieces of its
    length. Ranks come from counts by (input partition, length), so no group of equal lengths
    meets in one task. Only pieces in windows with slack are cut again; their ids are kept in
    the stored pieces.

    Null text and empty text are one piece with ``end_id`` alone. Repeated rows are packed each.
    An empty table gives an empty result. ``tokenizer_path`` must exist on the executors.
    ``capacity`` must be a power of two up to 2**16 and ids must be under 2**16, else ValueError.
    """
    if capacity < 1 or capacity & (capacity - 1) or capacity > 1 << 16:
        raise ValueError("capacity must be a power of two up to 2**16")
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [T.StructField("id", kind)]
        + [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "part", "nth")]
        + [T.StructField("ids", T.BinaryType())]
    )

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for b in chunks(batches, "text"):
            rows: list[list] = [[] for _ in range(7)]
            for i, ids in enumerate(encode(b.column("text").to_pylist(), tokenizer_path, end_id)):
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    length = min(capacity, n - start)
                    piece = ids[4 * start : 4 * (start + length)]
                    kept = None if length == capacity else _narrow(piece)
                    for col, x in zip(rows, (i, start, length, zlib.crc32(piece), n, seen[length], kept), strict=True):
                        col.append(x)
                    seen[length] += 1
            ids_of = b.column("id").take(pa.array(rows[0], pa.int64()))
            cols = [pa.array(c, pa.int64()) for c in rows[1:6]]
            yield pa.RecordBatch.from_arrays([ids_of, *cols[:4], pa.array([part] * len(rows[0]), pa.int64()), cols[4], pa.array(rows[6], pa.binary())], names=schema.names)

    pieces = stored(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(tokens, schema), "pieces")
    by_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = {r.length: r.n for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    layout = Layout(plan_windows(counts, capacity), capacity)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranked = by_part.select("part", "length", F.coalesce(before, F.lit(0)).alias("before"))
    small = pieces.drop("ids").join(ranked, ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    out_schema = T.StructType(schema.fields[:7] + [T.StructField(n, T.LongType()) for n in ("from", "size", "sequence_id", "offset")])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths, ranks = b.column("length").to_numpy(), b.column("rank").to_numpy()
            stream, window = np.full(len(ranks), -1), np.full(len(ranks), -1)
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                stream[at], window[at] = layout.places(int(n), ranks[at])
            take, parts = [], []
            for i in np.flatnonzero(window >= 0):
                take.append(i)
                parts.append((0, lengths[i], window[i] // capacity, window[i] % capacity))
            for i in np.flatnonzero(stream >= 0):
                cut = layout.cut(int(stream[i]), int(lengths[i]))
                take += [i] * len(cut)
                parts += cut
            b = b.select(schema.names[:7]).take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(np.array(c, dtype=np.int64)) for c in (zip(*parts, strict=True) if parts else [[]] * 4))], names=out_schema.names)

    placed = small.select(*schema.names[:7], "rank").mapInArrow(place, out_schema)
    whole = placed.where("size = length")
    names = ["id", "start", F.col("size").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if not layout.cut_lengths:
        return whole.select(*names)
    kept = pieces.where(F.col("length").isin(layout.cut_lengths)).select("part", "nth", "length", "ids")
    crc = F.crc32(_wide(F.expr("substring(ids, cast(2 * from + 1 as int), cast(2 * size as int))")))
    cut = (
        placed.where("size < length").drop("ids_crc32").join(kept, ["part", "nth", "length"])
        .withColumn("ids_crc32", crc).withColumn("start", F.col("start") + F.col("from"))
    )
    return whole.select(*names).unionByName(cut.select(*names))


def _narrow(piece: bytes) -> bytes:
    """Little-endian 32-bit integers as 16-bit ones."""
    ids = np.frombuffer(piece, "<u4")
    if len(ids) and ids.max() >= 1 << 16:
        raise ValueError("an id of 2**16 or more")
    return ids.astype("<u2").tobytes()


def _wide(ids):  # noqa: ANN001, ANN202
    """Little-endian 16-bit integers as 32-bit ones."""
    return F.unhex(F.regexp_replace(F.hex(ids), "(.{4})", "$10000"))
