"""Secrets in documents: an inverted trigram index picks candidates for each rule, regular expressions verify them.

From every rule's pattern a Boolean query over lower-case trigrams is derived that each match satisfies. Postings of
those trigrams are kept by blocks of documents, intersected and united per rule, and only the documents that remain
are searched for that rule. A rule without mandatory trigrams searches all documents. Everything runs as column
expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product
from re import _constants as sre  # the names in the standard library's parse trees
from re import _parser as sre_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.frames import text_or_empty


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters. Patterns use what Java, Python and
    RE2 share, without flags."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token")) + f"|{either_case('api')}_?{either_case('key')}"

#: The kinds that are counted. Runs shorter than the least length are cut in the pattern where that finds the same.
BASE_RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
#: After the header of a private key: what stands before its footer, else lines of base64, else all up to its last long
#: run. No group is repeated, as Java would take a stack frame each time.
_KEY_INFO = r"(?:[\x09-\x0D\x20]*Proc-Type:[^\r\n]*)?(?:[\x09-\x0D\x20]*DEK-Info:[^\r\n]*)?"
_KEY_BODY = "|".join((
    r"[^-]*-----END [A-Z ]*PRIVATE KEY-----",
    r"[\x09\x20]*\r?\n[A-Za-z0-9+/=\r\n]*[A-Za-z0-9+/=](?:\r?\n|$)",
    r"[\x09-\x0D\x20\\][A-Za-z0-9+/=\\\x09-\x0D\x20]*[A-Za-z0-9+/]{32,}={0,2}",
))
MORE_RULES = (
    Rule("private_key", rf"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:{_KEY_INFO}(?:{_KEY_BODY}))?"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)

#: Documents of a block of postings, and strings a pattern's part may stand for before it is cut.
BLOCK_DOCUMENTS, MOST_STRINGS = 4096, 64

Query = frozenset  # of clauses; a clause is a frozenset of trigrams that occur together
ANY = Query([frozenset()])


def _both(a: Query, b: Query) -> Query:
    return _shortest(x | y for x, y in product(a, b))


def _shortest(clauses) -> Query:
    clauses = set(clauses)
    return Query(c for c in clauses if not any(d < c for d in clauses))


def _strings(op, value) -> set[str] | None:
    """All lower-case strings that a node can match, None if unbounded or too many."""
    if op is sre.LITERAL:
        return {chr(value).lower()}
    if op is sre.IN:
        found = set()
        for kind, v in value:
            if kind is sre.LITERAL:
                found.add(chr(v).lower())
            elif kind is sre.RANGE and v[1] - v[0] < MOST_STRINGS:
                found |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return None
        return found if len(found) <= 8 else None
    if op is sre.SUBPATTERN:
        return _all_strings(value[-1])
    if op is sre.BRANCH:
        each = [_all_strings(b) for b in value[1]]
        return None if None in each else set().union(*each)
    if op is sre.MAX_REPEAT and value[1] is not sre.MAXREPEAT and value[1] <= 2:
        once = _all_strings(value[2])
        if once is None:
            return None
        found, power = set(), {""}
        for times in range(value[1] + 1):
            found |= power if times >= value[0] else set()
            power = {a + b for a, b in product(power, once)}
        return found if len(found) <= MOST_STRINGS else None
    return None


def _all_strings(nodes) -> set[str] | None:
    found = {""}
    for op, value in nodes:
        own = _strings(op, value)
        if own is None or len(own) * len(found) > MOST_STRINGS:
            return None
        found = {a + b for a, b in product(found, own)}
    return found


def _of_strings(strings: set[str]) -> Query:
    return _shortest(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _of_nodes(nodes) -> Query:
    query, run = ANY, {""}
    for op, value in nodes:
        own = _strings(op, value)
        if own is not None and len(own) * len(run) <= MOST_STRINGS:
            run = {a + b for a, b in product(run, own)}
            continue
        query, run = _both(query, _of_strings(run)), {""}
        if op is sre.SUBPATTERN:
            query = _both(query, _of_nodes(value[-1]))
        elif op is sre.BRANCH:
            query = _both(query, _shortest(c for b in value[1] for c in _of_nodes(b)))
        elif op is sre.MAX_REPEAT and value[0] > 0:
            query = _both(query, _of_nodes(value[2]))
    return _both(query, _of_strings(run))


def trigram_query(pattern: str) -> Query:
    """Clauses of lower-case trigrams: a text that holds a match holds all trigrams of some clause. ``ANY`` if none
    is mandatory."""
    return _of_nodes(sre_parser.parse(pattern))


def postings(docs: DataFrame, key: str, text: str, trigrams: Sequence[str], blocks: int) -> DataFrame:
    """Inverted index ``block, trigram, keys`` of the trigrams that occur in the lower-case texts.

    A list has at most the keys of one block, so a frequent trigram is many short lists.
    """
    wanted = F.array(*map(F.lit, trigrams))
    # The lower-case text is bound to a variable, else it would be made anew for every trigram.
    found = F.transform(F.array(F.lower(text)), lambda low: F.filter(wanted, lambda t: F.contains(low, t)))[0]
    held = docs.select(key, found.alias("_held"))
    return (
        held.select(F.pmod(key, F.lit(blocks)).alias("block"), F.explode("_held").alias("trigram"), key)
        .groupBy("block", "trigram").agg(F.collect_list(key).alias("keys"))
    )


def candidates(index: DataFrame, queries: Sequence[tuple[str, Query]]) -> DataFrame:
    """``key, kinds``: the rules whose query each document satisfies, by intersecting and uniting postings per block."""
    blocks = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "keys"))).alias("lists"))
    none = F.array().cast("array<bigint>")

    def met(query: Query) -> Column:
        united = none
        for clause in sorted(map(sorted, query)):
            lists = [F.coalesce(F.col("lists")[t], none) for t in clause]
            both = lists[0]
            for other in lists[1:]:
                both = F.array_intersect(both, other)
            united = F.array_union(united, both)
        return united

    per_rule = F.array(*[F.struct(F.lit(kind).alias("kind"), met(query).alias("keys")) for kind, query in queries])
    return (
        blocks.select(F.explode(per_rule).alias("r")).select("r.kind", F.explode("r.keys").alias("key"))
        .groupBy("key").agg(F.collect_set("kind").alias("kinds"))
    )


SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def spans_of(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of a rule in one text, leftmost first, not overlapping: code points, end exclusive.

    Between the pieces that ``split`` leaves stand the matches in order, so lengths add up to positions.
    """
    pattern = F.lit(rule.pattern)
    zipped = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("piece"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("part"),
    )
    zipped = F.transform(zipped, lambda x: F.struct(
        F.length(x["piece"]).alias("gap"), F.coalesce(F.length(x["match"]), F.lit(0)).alias("size"),
        F.coalesce(F.length(x["part"]), F.lit(0)).alias("part"),
    ))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        span = F.struct(
            begin.alias("start"), F.lit(rank).alias("rank"), (begin + x["size"]).alias("end"), F.lit(rule.kind).alias("kind")
        )
        kept = (x["size"] > 0) & (x["part"] >= rule.least)
        return F.struct((begin + x["size"]).alias("at"), F.when(kept, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return F.when(text.rlike(rule.pattern), F.aggregate(zipped, start, step)["spans"]).otherwise(F.array().cast(SPANS))


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = BASE_RULES + MORE_RULES, name: str = "secrets") -> DataFrame:
    """All columns of ``docs`` with ``name``: spans ``start, rank, end, kind`` of whole texts, by start, then rule.

    Null and empty texts have no spans. Repeated rows are searched alike; a null doc_id is an id like any other. Rules
    do not see each other: spans of different kinds may overlap.
    """
    queries = [(r.kind, trigram_query(r.pattern)) for r in rules]
    indexed = [(kind, q) for kind, q in queries if q != ANY]
    columns = [F.col(f"`{c}`") for c in docs.columns if c not in (name, "_key", "_kinds")]
    marked = docs.select(*columns, F.xxhash64(F.col("doc_id"), F.col("text")).alias("_key"))
    if indexed:
        trigrams = sorted({t for _, q in indexed for clause in q for t in clause})
        blocks = docs.count() // BLOCK_DOCUMENTS + 1
        own = docs.select(F.xxhash64(F.col("doc_id"), F.col("text")).alias("key"), text_or_empty().alias("text"))
        found = candidates(postings(own, "key", "text", trigrams, blocks), indexed)
        found = found.select(F.col("key").alias("_key"), F.col("kinds").alias("_kinds"))
        marked = marked.join(found, "_key", "left")
    else:
        marked = marked.withColumn("_kinds", F.lit(None).cast("array<string>"))
    text, empty = text_or_empty(), F.array().cast(SPANS)
    parts = []
    for rank, (rule, (_, query)) in enumerate(zip(rules, queries)):
        spans = spans_of(text, rule, rank)
        parts.append(spans if query == ANY else F.when(F.array_contains("_kinds", rule.kind), spans).otherwise(empty))
    return marked.withColumn(name, F.array_sort(F.concat(*parts))).drop("_key", "_kinds")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by ``mark``."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        apart = s["start"] >= acc["at"]
        out = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(apart, out).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def secrets_sql(rules: Sequence[Rule] = BASE_RULES + MORE_RULES, base: int = len(BASE_RULES)) -> str:
    """DuckDB: the contract's columns over ``documents``."""
    quoted = [r.pattern.replace("'", "''") for r in rules]
    found = ", ".join(
        f"string_split_regex(t, '{p}') AS p{i}, regexp_extract_all(t, '{p}') AS m{i}, regexp_extract_all(t, '{p}', {r.group}) AS g{i}"
        for i, (r, p) in enumerate(zip(rules, quoted))
    )
    spans = " || ".join(
        f"list_filter(list_transform(range(1, len(m{i}) + 1), lambda i: {{'s': CAST(coalesce(list_sum(list_transform(p{i}[1:i], lambda x: length(x))), 0) "
        f"+ coalesce(list_sum(list_transform(m{i}[1:i-1], lambda x: length(x))), 0) AS BIGINT), 'r': {i}, 'n': length(m{i}[i]), 'g': length(g{i}[i]), "
        f"'k': '{r.kind}'}}), lambda x: x.g >= {r.least})"
        for i, r in enumerate(rules)
    )
    text = "array_to_string(list_transform({0}, lambda x: x.k || ':' || x.s || ':' || (x.s + x.n)), ',')"
    counts = ", ".join(f"CAST(len(list_filter(spans, lambda x: x.r = {i})) AS BIGINT) AS n_{rules[i].kind}" for i in range(base))
    return (
        f"WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS (SELECT doc_id, {found} FROM d), "
        f"a AS (SELECT doc_id, list_sort({spans}) AS spans FROM f) SELECT doc_id, {counts}, "
        f"sha256({text.format(f'list_filter(spans, lambda x: x.r < {base})')}) AS base_sha256, {text.format('spans')} AS spans FROM a"
    )
