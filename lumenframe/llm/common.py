"""Shared helpers: word scanning on Arrow buffers, stored intermediates, chunked batches."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one numpy pass handles; a longer single text is one pass of its own, whose
#: words are hashed in blocks of BLOCK_BYTES.
CHUNK_BYTES = 1 << 19
BLOCK_BYTES = 1 << 18
#: Rows of a small table that one task takes.
TASK_ROWS = 200_000

#: The white space of all word counts here: space and U+0009 to U+000D.
WHITE = np.zeros(256, dtype=bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True

#: The same characters as a regex class.
WHITE_CLASS = r"[\x20\x09-\x0D]"

_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C55  # odd, so that it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)


# --------------------------------------------------------------------------- stored results


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediates: ``spark.checkpoint.dir``; in local mode one of our own where
    that is unset. Elsewhere it must be set: executors don't see a folder of the driver."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if not given:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        given = "file://" + tempfile.mkdtemp(prefix="lumenframe-")
        spark.conf.set("spark.checkpoint.dir", given)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(given)
    return given


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder; for narrow rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str, tasks: int | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: columns can be pruned.

    ``tasks``: as many tasks at most compute the last stage and write a file each; for tables
    whose size is known, so that small ones don't become many tiny files. The files are removed
    when the Python process ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lumenframe-{name}-{uuid.uuid4().hex}"
    (df if tasks is None else df.coalesce(tasks)).write.parquet(path)
    atexit.register(_remove, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["_stored_at"] = path
    return out


def discard(*dfs: DataFrame) -> None:
    """Removes the files of results of ``stored`` that nothing reads any more."""
    for df in dfs:
        _remove(df.sparkSession, df.__dict__["_stored_at"])


def tasks_for(rows: int, each: int = TASK_ROWS) -> int:
    """How many tasks a table of so many rows deserves."""
    return max(1, -(-rows // each))


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone already; the cluster clears the folder then
        pass


_SHIPPED: set[str] = set()


#: Bytes of an Arrow batch between Spark and a Python worker, unless the session says otherwise:
#: ten thousand long texts or sets in one batch would fill a worker.
BATCH_BYTES = 2 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, which may run where it isn't installed, and
    bounds the batches that they get."""
    if not spark.conf._jconf.contains(_BATCH):
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="lumenframe-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


# --------------------------------------------------------------------------- Arrow batches


def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches``; after the last one the worker gives memory it has freed back to the system.

    Workers are kept for later tasks, and several of them share an executor's memory.
    """
    yield from batches
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts hold about ``limit`` bytes each, so memory stays bounded."""
    for batch in trimmed(batches):
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(sizes) // limit
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(int(a), int(b - a))


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null counts as empty."""
    array = pc.fill_null(array, "").cast(pa.large_string())
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """The words of many texts: maximal runs of bytes that aren't white space."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        n = len(data)
        self.data, self.offsets = data, offsets
        solid = ~WHITE[data]
        first = np.zeros(n + 1, dtype=bool)
        first[offsets] = True
        before = np.empty(n, dtype=bool)
        if n:
            before[0] = False
            before[1:] = solid[:-1]
        self.solid = solid
        self.starts = np.flatnonzero(solid & (~before | first[:n]))
        after = np.zeros(n, dtype=bool)
        after[: n - 1] = solid[1:]
        self.ends = np.flatnonzero(solid & (~after | first[1 : n + 1])) + 1
        #: Words before each text, and the number of each text's words.
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word's bytes; ``lower``: with A-Z as a-z."""
        out = np.empty(len(self.starts), dtype=np.uint64)
        i = 0
        while i < len(out):
            first = int(self.starts[i])
            j = int(np.searchsorted(self.ends, first + BLOCK_BYTES, "right"))
            if j <= i:  # one word longer than a block
                out[i] = self._long(first, int(self.ends[i]), lower)
                i += 1
                continue
            sums = self._sums(first, int(self.ends[j - 1]), lower)
            starts = self.starts[i:j] - first
            out[i:j] = (sums[self.ends[i:j] - first] - sums[starts]) * _powers()[1][starts]
            i = j
        return mixed(out)

    def _sums(self, first: int, last: int, lower: bool) -> np.ndarray:
        """Running sums of the bytes' terms, from 0; at most a block."""
        part = self.data[first:last]
        letters = (_ASCII_LOWER[part] if lower else part).astype(np.uint64)
        letters += np.uint64(1)
        letters *= _powers()[0][: len(part)]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(letters, out=sums[1:])
        return sums

    def _long(self, first: int, last: int, lower: bool) -> np.uint64:
        h, at = 0, 0
        for a in range(first, last, BLOCK_BYTES):
            b = min(last, a + BLOCK_BYTES)
            h += int(self._sums(a, b, lower)[-1]) * pow(_BASE, at, 1 << 64)
            at += b - a
        return np.uint64(h & 0xFFFFFFFFFFFFFFFF)

    def shingles(self, k: int, lower: bool = False, whole_if_short: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of each text's windows of ``k`` words in order, and offsets by text.

        ``whole_if_short``: a text of fewer words, one at least, is one window.
        """
        words, counts = self.hashes(lower), self.counts
        w = len(words)
        out = np.zeros(max(0, w - k + 1), dtype=np.uint64)
        for j in range(k if len(out) else 0):
            out += mixed(words[j : w - k + 1 + j] + np.uint64(_salt(k, j))) * np.uint64(2 * j + 1)
        out = mixed(out)
        own = np.maximum(counts - k + 1, 0)
        offsets = np.zeros(len(counts) + 1, dtype=np.int64)
        np.cumsum(own, out=offsets[1:])
        total = int(offsets[-1])
        at = np.arange(total) + np.repeat(self.bounds[:-1] - offsets[:-1], own)
        out = out[at]
        if whole_if_short:
            short = np.flatnonzero((counts > 0) & (counts < k))
            if len(short):
                extra = np.zeros(len(short), dtype=np.uint64)
                for i, d in enumerate(short):
                    h = 0
                    for x in words[self.bounds[d] : self.bounds[d + 1]]:
                        h = (h * _BASE + int(x) + 1) & 0xFFFFFFFFFFFFFFFF
                    extra[i] = h ^ 0x5DEECE66D
                out = np.insert(out, offsets[short], mixed(extra))
                own[short] = 1
                np.cumsum(own, out=offsets[1:])
        return out, offsets


def _salt(k: int, j: int) -> int:
    return ((j + 1) * 0xD6E8FEB86659FD93 + k * 0xA0761D6478BD642F) & 0xFFFFFFFFFFFFFFFF


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit integers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_TABLES: list[np.ndarray] = []


def _powers() -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for the bytes of a block."""
    if not _TABLES:
        _TABLES[:] = [_power_table(_BASE, BLOCK_BYTES + 1), _power_table(_BASE_INV, BLOCK_BYTES + 1)]
    return _TABLES


def _power_table(base: int, size: int) -> np.ndarray:
    out = np.ones(size, dtype=np.uint64)
    done = 1
    while done < size:
        step = np.uint64(pow(base, done, 1 << 64))
        more = min(done, size - done)
        out[done : done + more] = out[:more] * step
        done += more
    return out
