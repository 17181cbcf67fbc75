"""HTML main-text extraction by differencing each page with its nearest URL."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, chunks, ship
from .urlrules import host_of, path_of

# --------------------------------------------------------------------------- blocks of a page

_TAG = re.compile(
    r"""(?s)<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"""
)
_ATTRIBUTE = re.compile(r"""(?s)\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
_PART = re.compile(r"[a-z0-9]+")

#: Elements whose content is not markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that begin and end a block.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are never part of the main text.
NOISE = frozenset("aside button dialog footer form head iframe menu nav noscript script select style svg template textarea title object canvas audio video map".split())
MAIN = frozenset(("article", "main"))
#: Words in a class, id or role that mark what is not the main text.
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies disqus footer menu modal nav navbar navigation newsletter notice notices pagination popup promo related search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
_TRACKED = (BLOCK | NOISE | MAIN | {"span", "td", "th"}) - {"p", "li", "dd", "dt", "hr", "option", "tr", "td", "th", "h1", "h2", "h3", "h4", "h5", "h6"}
_SPACED = frozenset(("br", "td", "th", "img", "hr"))


@dataclass
class Line:
    """One block's text; in the article element; in an element that marks noise."""

    text: str
    main: bool
    noise: bool


def _is_noise(tag: str, attributes: str, inside_main: bool) -> bool:
    if tag in NOISE:
        return True
    if tag == "header" and not inside_main:
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" and m.start() and attributes[m.start() - 1].isspace():
            return True
        if name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if name in ("class", "id", "role"):
            words = set(_PART.findall(value))
            if words & NOISE_WORDS or "header" in words and not inside_main and tag not in MAIN:
                return True
    return False


def lines_of(html: str | None) -> list[Line]:
    """The blocks of a page in order: references decoded, white space as one space, none empty."""
    out: list[Line] = []
    if not html:
        return out
    buffer: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # open element, it is noise, it is main
    noise = main = 0

    def flush() -> None:
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                out.append(Line(text, main > 0, noise > 0))

    at, size = 0, len(html)
    while at < size:
        m = _TAG.search(html, at)
        if m is None:
            buffer.append(html[at:])
            break
        if m.start() > at:
            buffer.append(html[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        close, attributes = (m[1] or m[4]) == "/", m[3] or m[6] or ""
        if tag in BLOCK:
            flush()
        elif tag in _SPACED:
            buffer.append(" ")
        if not close and tag in RAW:
            end = re.compile(rf"(?i)</{re.escape(tag)}[^>]*(?:>|\Z)").search(html, at)
            at = end.end() if end else size
            continue
        if tag in VOID or tag not in _TRACKED:
            continue
        if not close:
            if attributes.endswith("/") and tag not in BLOCK:
                continue
            bad = _is_noise(tag, attributes, main > 0)
            if bad or tag in BLOCK or tag in NOISE:
                if bad:
                    flush()
                stack.append((tag, bad, tag in MAIN and not bad))
                noise += bad
                main += tag in MAIN and not bad
            elif tag == "span":
                stack.append((tag, False, False))
        elif any(x[0] == tag for x in stack):
            while True:
                name, bad, is_main = stack.pop()
                if bad:
                    flush()
                noise -= bad
                main -= is_main
                if name == tag:
                    break
    flush()
    return out


# --------------------------------------------------------------------------- differencing

#: Two pages are near copies if so many tenths of the text that may be main text are common.
NEAR = 8
_LENGTH = (1 << 19) - 1

#: Bits of the table of one alignment that are held at once; longer pages are halved.
ALIGN_BITS = 1 << 29


def shared_lines(a: list[int], b: list[int]) -> set[int]:
    """Places in ``a`` of a longest common subsequence of ``a`` and ``b``.

    A row of the table is one whole number with a bit for each line of ``b``, so equal lines cost
    no more than others; where the table is large, ``a`` is halved as often as needed.
    """
    lo, hi = 0, 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    out = {*range(lo), *range(len(a) - hi, len(a))}
    here, there = set(a[lo : len(a) - hi]), set(b[lo : len(b) - hi])
    own = [i for i in range(lo, len(a) - hi) if a[i] in there]  # others are in no common subsequence
    other = [x for x in b[lo : len(b) - hi] if x in here]
    todo = [(own, other)]
    while todo:
        own, other = todo.pop()
        if not own or not other:
            continue
        values = [a[i] for i in own]
        if len(own) * len(other) <= ALIGN_BITS or len(own) == 1:
            out.update(own[i] for i in _aligned(values, other))
            continue
        half = len(own) // 2
        left, right = _lengths(values[:half], other), _lengths(values[half:][::-1], other[::-1])[::-1]
        j = int(np.argmax(left + right))
        todo += [(own[:half], other[:j]), (own[half:], other[j:])]
    return out


def _rows(a: list[int], b: list[int]) -> Iterator[int]:
    """After each of ``a``, a number whose bit j is 0 where b[j] lengthens the common subsequence."""
    full, at = (1 << len(b)) - 1, {}
    for j, x in enumerate(b):
        at.setdefault(x, []).append(j)
    masks = {x: sum(1 << j for j in places) if len(places) < 64 else _bits(places, len(b)) for x, places in at.items()}
    row = full
    for x in a:
        hit = row & masks.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def _bits(places: list[int], n: int) -> int:
    marks = np.zeros(n, np.uint8)
    marks[places] = 1
    return int.from_bytes(np.packbits(marks, bitorder="little").tobytes(), "little")


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Lengths of longest common subsequences of ``a`` and each beginning of ``b``."""
    row = (1 << len(b)) - 1
    for row in _rows(a, b):
        pass
    marks = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(1 - marks.astype(np.int64))])


def _aligned(a: list[int], b: list[int]) -> list[int]:
    rows = [(1 << len(b)) - 1, *_rows(a, b)]
    j, out = len(b), []
    length = j - rows[-1].bit_count()
    for i in range(len(a), 0, -1):
        if not length:
            break
        below = (1 << j) - 1
        if j - (rows[i - 1] & below).bit_count() < length:  # without a[i - 1] it would be shorter
            out.append(i - 1)
            j = (~rows[i] & below).bit_length() - 1
            length -= 1
    return out


def _near(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def candidates(lines: list[Line]) -> list[bool]:
    """Which lines may be main text: the article's if there is one, else all; never noise."""
    own = [x.main and not x.noise for x in lines]
    return own if any(own) else [not x.noise for x in lines]


def codes(lines: list[Line]) -> np.ndarray:
    """Each line as 44 bits of its text's hash, 19 of its length and one: it may be main text."""
    out = [xxhash.xxh64_intdigest(x.text) >> 20 << 20 | min(len(x.text), _LENGTH) << 1 | c for x, c in zip(lines, candidates(lines), strict=True)]
    return np.array(out, np.uint64)


def _texts(page: list[int]) -> list[int]:
    return [x >> 1 for x in page]


def near_copies(a: tuple | None, b: tuple | None) -> bool:
    """Whether two pages (host, path, codes) of a host have the same lines, or nearly."""
    if a is None or b is None or a[0] != b[0] or not a[0]:
        return False
    if _texts(a[2]) == _texts(b[2]):
        return True
    own, other = (Counter(x >> 1 for x in p[2] if x & 1) for p in (a, b))
    size = max(sum((x & _LENGTH) * n for x, n in c.items()) for c in (own, other))
    return size > 0 and 10 * sum((x & _LENGTH) * min(n, other[x]) for x, n in own.items() if x in other) >= NEAR * size


def shared_of_run(run: list[tuple], before: tuple | None, after: tuple | None) -> Iterator[list[int]]:
    """Per page (host, path, codes as bytes) of ``run``: lines that its nearest other page shares.

    ``run``: near copies that follow each other in the order of paths. Of the pages ``before``
    and ``after`` it on the host, the one whose path agrees longer; near copies say nothing.
    """
    last, others, known = None, [], {}
    for host, path, data in run:
        if data != last:
            last, own, known = data, (host, path, decoded(data)), {}
            others = [p for p in (before, after) if p is not None and host and p[0] == host and not near_copies(own, p)]
        if not others:
            yield []
            continue
        best = max(others, key=lambda p: _near(path, p[1]))
        if id(best) not in known:
            known[id(best)] = sorted(shared_lines(_texts(own[2]), _texts(best[2])))
        yield known[id(best)]


def decoded(data: bytes) -> list[int]:
    return np.frombuffer(data, np.uint64).tolist()


def around(ends: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """Per task: the page before its first and the one before that page's run; the same after it.

    ``ends``: per task, in order, its first and last page, the page before its last run and the
    page after its first run (None if it has one run).
    """
    left, right = [], []
    state: tuple = (None, None)
    for first, last, pre, _ in ends:
        left.append(state)
        state = (last, pre if pre is not None else state[1] if near_copies(state[0], first) else state[0])
    state = (None, None)
    for first, last, _, post in reversed(ends):
        right.append(state)
        state = (first, post if post is not None else state[1] if near_copies(last, state[0]) else state[0])
    return left, right[::-1]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: id, url, text (blocks joined by an empty line), n_chars, n_shared.

    Pages of a host are put in the order of their paths, and the lines of each are aligned with
    those of its nearest neighbour; shared lines are deleted, inside an article too, and so are
    lines of elements that mark menus, adverts, forms and the like. Copies and near copies must
    not delete each other: pages in a row that have ``NEAR`` tenths of their text in common with
    the one before are a run, and each is aligned with the nearer page before or after the run.
    Pages without lines are passed over. If a page has an article or main element, its lines alone may be main text. A null
    or empty page has no text. A URL without host has no neighbour.
    Repeated rows give the same text each. Extra columns are not read.

    Only line hashes are sorted, by range, so a hot host is spread over tasks; the rows at the
    ends of each task's range and of the runs there (four a task) are sent to the other tasks,
    as a run may span several. The pages then meet
    their list of shared lines by an equality join on a hash of the row.
    """
    ship(pages.sparkSession)
    kind = pages.schema[id_col].dataType
    key = F.xxhash64(id_col, url_col, html_col)
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), key.alias("key"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "html"):
            rows = [codes(lines_of(t)).tobytes() for t in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("host"), b.column("path"), pa.array(rows, pa.binary())], names=["key", "host", "path", "hashes"])

    keyed = src.select("key", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    lines = checkpointed(keyed.mapInArrow(hashed, "key long, host string, path string, hashes binary"))
    ordered = checkpointed(
        lines.dropDuplicates(["key"]).repartitionByRange("host", "path", "key").sortWithinPartitions("host", "path", "key").withColumn("part", F.spark_partition_id())
    )
    columns = ("key", "host", "path", "hashes", "part")

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = pre = post = part = None
        for b in batches:
            for _, h, p, x, part in zip(*(b.column(c).to_pylist() for c in columns), strict=True):
                if not x:
                    continue
                page = (h, p, decoded(x))
                if last is not None and not near_copies(last, page):
                    pre, post = last, post or page
                first, last = first or page, page
        found = [(k, *p) for k, p in enumerate((first, last, pre, post)) if p is not None]
        rows = [(part, k, h, p, np.array(x, np.uint64).tobytes()) for k, h, p, x in found]
        yield pa.RecordBatch.from_pylist([dict(zip(("part", "k", "host", "path", "hashes"), r, strict=True)) for r in rows], pa.schema([("part", pa.int32()), ("k", pa.int32()), ("host", pa.string()), ("path", pa.string()), ("hashes", pa.binary())]))

    ends: dict[int, list] = {}
    for r in ordered.mapInArrow(bounds, "part int, k int, host string, path string, hashes binary").collect():
        ends.setdefault(r.part, [None] * 4)[r.k] = (r.host, r.path, decoded(r.hashes))
    parts = sorted(ends)
    edge = dict(zip(parts, zip(*around([tuple(ends[p]) for p in parts]), strict=True), strict=True))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: list[tuple] = []
        run_keys: list[int] = []
        before = last = part = None
        keys, shared = [], []

        def close(after: tuple | None) -> None:
            keys.extend(run_keys)
            shared.extend(shared_of_run(run, before, after))
            run.clear()
            run_keys.clear()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(shared, pa.list_(pa.int32()))], names=["key", "shared"])
            keys.clear()
            shared.clear()
            return batch

        for b in batches:
            for k, h, p, x, part in zip(*(b.column(c).to_pylist() for c in columns), strict=True):
                if not x:
                    keys.append(k)
                    shared.append([])
                    continue
                page = (h, p, decoded(x))
                if last is None:
                    last, pre = edge[part][0]
                    before = pre if near_copies(last, page) else last
                elif not near_copies(last, page):
                    close(page)
                    before = last
                last = page
                run.append((h, p, x))
                run_keys.append(k)
            yield out()
        if run:
            after, post = edge[part][1]
            close(post if near_copies(last, after) else after)
            yield out()

    marks = ordered.mapInArrow(compared, "key long, shared array<int>")
    joined = src.join(marks.hint("shuffle_hash"), "key", "left")
    schema = T.StructType([T.StructField("id", kind), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("n_shared", T.LongType())])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "html"):
            out = [main_text(lines_of(t), s or ()) for t, s in zip(b.column("html").to_pylist(), b.column("shared").to_pylist(), strict=True)]
            n = [len(t) for t in out]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), pa.array(out, pa.string()), pa.array(n, pa.int64()), pa.array([len(s or ()) for s in b.column("shared").to_pylist()], pa.int64())], names=schema.names)

    return joined.select("id", "url", "html", "shared").mapInArrow(texts, schema)


def main_text(lines: list[Line], shared) -> str:  # noqa: ANN001
    """The lines that may be main text and are not ``shared``."""
    gone = set(shared)
    return "\n\n".join(x.text for i, (x, c) in enumerate(zip(lines, candidates(lines), strict=True)) if c and i not in gone)
