"""Secret scans with a trigram inverted index (DataFrame operations only)."""

from __future__ import annotations

import re._parser as sre
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Alternatives that a rule's trigram query may have; beyond that, literal runs are cut.
MAX_CLAUSES = 64
#: Bits of the fixed-size filter that stands for the candidates' keys.
FILTER_BITS = 24


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose group ``group`` has ``least`` code points or more.

    Matches are leftmost and don't overlap; one that is too short is dropped after matching.
    The pattern must mean the same in Java and Python. ``base``: counted in the base digest.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


#: The three base kinds. A run of 16 or 18 characters and more is matched as such: a shorter
#: maximal run can't hold one, so this equals matching any run and dropping short ones.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]{14,}", base=True),
    Rule("hex", r"[0-9a-f]{16,}", base=True),
)

#: Fixed token formats that issuers publish.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)


# --------------------------------------------------------------------------- trigram queries


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """What a match's folded text must hold: any of these sets of trigrams, in full.

    None: the regex can match without some trigram, so its rule scans every text.
    """
    clauses = set()
    for need, run in _walk(sre.parse(pattern), {(frozenset(), "")}):
        clauses.add(need | _trigrams(run))
    least = [c for c in clauses if not any(o < c for o in clauses)]
    return None if not all(least) else sorted(least, key=sorted)


def _trigrams(run: str) -> frozenset[str]:
    return frozenset(run[i : i + 3] for i in range(len(run) - 2))


def _cut(states: set) -> set:
    return {(need | _trigrams(run), "") for need, run in states}


def _walk(nodes, states: set) -> set:  # noqa: ANN001
    for op, arg in nodes:
        name = str(op)
        if name == "LITERAL":
            states = {(need, run + chr(arg).lower()) for need, run in states}
        elif name == "IN" and (chars := _few(arg)):
            states = {(need, run + c) for need, run in states for c in chars}
        elif name == "SUBPATTERN":
            states = _walk(arg[-1], states)
        elif name == "BRANCH":
            states = set().union(*(_walk(b, states) for b in arg[1]))
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, item = arg
            if low == 0:
                states = states | _walk(item, states) if high == 1 else _cut(states)
            else:
                for _ in range(min(low, 3)):
                    states = _walk(item, states)
                if low > 3 or high != low:
                    states = _cut(states)
        elif name != "AT":
            states = _cut(states)
        if len(states) > MAX_CLAUSES:
            states = _cut(states)
    return states


def _few(items) -> list[str]:  # noqa: ANN001
    """The folded characters of a small class, or none."""
    out = set()
    for op, arg in items:
        if str(op) == "LITERAL":
            out.add(chr(arg).lower())
        elif str(op) == "RANGE" and arg[1] - arg[0] < 4:
            out |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return []
    return sorted(out) if len(out) <= 5 else []


# --------------------------------------------------------------------------- the index


def build_index(docs: DataFrame, trigrams: list[str], text_col: str = "text") -> DataFrame:
    """Postings (trigram, key): key is a hash of the text, so equal texts are one posting.

    Only trigrams that some rule asks for are indexed. A hash shared by unlike texts can only
    add candidates, which are verified.
    """
    folded = docs.select(F.xxhash64(text_col).alias("key"), F.lower(text_col).alias("folded")).where(F.col("folded").isNotNull())
    present = F.array(*[F.when(F.contains("folded", F.lit(t)), F.lit(t)) for t in trigrams]) if trigrams else F.array().cast("array<string>")
    return folded.select("key", F.explode(F.array_compact(present)).alias("trigram")).distinct()


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(key, kinds): postings intersected by key, and the kinds whose trigram query they meet."""
    met = index.groupBy("key").agg(F.collect_set("trigram").alias("have"))
    kinds = [
        F.when(_any([F.size(F.array_intersect("have", F.array(*map(F.lit, sorted(c))))) == len(c) for c in clauses]), F.lit(kind))
        for kind, clauses in queries.items()
    ]
    return met.select("key", F.array_compact(F.array(*kinds)).alias("kinds")).where(F.size("kinds") > 0)


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def _key_filter(keys: DataFrame) -> DataFrame:
    """(slice, bits): a bit for each key among 2**FILTER_BITS, in slices of 4096 bytes."""
    at = F.pmod("key", F.lit(1 << FILTER_BITS))
    rows = keys.select(F.floor(at / 32768).cast("int").alias("slice"), F.pmod(at, F.lit(32768)).alias("bit"))
    return rows.groupBy("slice").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _bit_set(bits: Column, key: Column) -> Column:
    at = F.pmod(key, F.lit(32768))
    byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.expr("shiftleft(1, cast(pmod(key, 8) as int))")) > 0


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, spans (array of start, rule, end), in the order of start, rule, end.

    ``rule`` is the index in ``rules``; offsets are code points, the end exclusive. Rules with
    a trigram query are verified only on the index's candidates; the others scan every text.
    Null text is empty and has no spans. Repeated rows each get their spans. Extra columns are
    not read. The candidates' keys become a filter of fixed size (2**FILTER_BITS bits, sent to
    every task); only texts that pass it move, to the exact join with the candidates, whose
    small side has one row per key, so that Spark splits a hot key's large side.
    """
    asked = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    none = F.lit(None).cast("array<string>")
    if not asked:
        return _found(rows.withColumn("kinds", none), rules, asked)
    index = build_index(rows, sorted(set().union(*(c for q in asked.values() for c in q))))
    found = stored(candidates(index, asked), "candidates")
    keyed = rows.withColumn("key", F.xxhash64("text"))
    keyed = keyed.withColumn("slice", F.floor(F.pmod("key", F.lit(1 << FILTER_BITS)) / 32768).cast("int"))
    keyed = keyed.join(F.broadcast(_key_filter(found)), "slice", "left").withColumn("maybe", F.coalesce(_bit_set(F.col("bits"), F.col("key")), F.lit(False)))
    keyed = keyed.select("id", "text", "key", "maybe")
    some = keyed.where("maybe").join(found.hint("shuffle_hash"), "key", "left").select("id", "text", "kinds")
    return _found(some, rules, asked).unionByName(_found(keyed.where("not maybe").select("id", "text", none.alias("kinds")), rules, {}, skip=set(asked)))


def _found(rows: DataFrame, rules: tuple[Rule, ...], asked: dict, skip: set | frozenset = frozenset()) -> DataFrame:
    """(id, spans) of rows (id, text, kinds); ``skip``: kinds that these texts can't hold."""
    used = [(k, r) for k, r in enumerate(rules) if r.kind not in skip]
    for k, r in used:
        every = F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0))
        test = F.coalesce(F.array_contains("kinds", r.kind), F.lit(False)) if r.kind in asked else F.rlike("text", F.lit(r.pattern))
        rows = rows.withColumn(f"m{k}", F.when(test, every))
    spans = F.concat(*[_spans(k, r) for k, r in used]) if used else F.array().cast(_SPAN)
    return rows.select("id", F.array_sort(spans).alias("spans"))


_SPAN = "array<struct<start:int,rule:int,end:int>>"


#: Hits whose spans are summed up one after the other; arrays grow by copying, so many hits are
#: summed by blocks, and then the blocks.
BLOCK = 128


def _spans(k: int, rule: Rule) -> Column:
    """Spans of the matches in column m<k>: each begins after the texts between and before."""
    found = F.col(f"m{k}")
    between = F.split("text", rule.pattern)
    values = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    parts = F.arrays_zip(F.slice(between, F.lit(1), F.size(found)).alias("gap"), found.alias("hit"), values.alias("value"))
    parts = F.transform(parts, lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"), (F.length(x["value"]) >= rule.least).alias("ok")))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / BLOCK).cast("int")), lambda i: F.slice(parts, i * BLOCK + 1, BLOCK))
    total = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda n, x: n + x["gap"] + x["hit"]))
    begin = F.aggregate(
        total, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"],
    )

    def step(acc: Column, x: Column) -> Column:
        first = acc["at"] + x["gap"]
        end = first + x["hit"]
        span = F.array(F.struct(first.alias("start"), F.lit(k).alias("rule"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["ok"], F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    none = F.array().cast(_SPAN)
    each = F.transform(F.arrays_zip(blocks.alias("b"), begin.alias("at")), lambda x: F.aggregate(x["b"], F.struct(x["at"].alias("at"), none.alias("out")), step, lambda acc: acc["out"]))
    return F.when(F.size(found) > 0, F.flatten(each)).otherwise(none)


def joined_spans(spans: Column, rules: tuple[Rule, ...]) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rule"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
