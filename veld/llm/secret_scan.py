"""Secret scans through a trigram inverted index, in DataFrame operations only.

A rule's regex is turned into a Boolean query over trigrams that every match must contain
(over text with letters in lower case).  The index holds, for each trigram that some query
asks for, the ids of the documents that contain it, in blocks of about ``BLOCK_DOCS``
documents; a query intersects and unites a block's lists, and only the documents that come
out are searched with the regex.  A rule whose regex has no mandatory trigram is searched in
all documents.

Spans are places in code points, end exclusive.  Per rule they are the regex's leftmost
non-overlapping matches; those whose checked group is too short are dropped afterwards.
"""

from __future__ import annotations

import re._constants as node
import re._parser as regex_parser
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written

#: Documents in a block of the index, on average.
BLOCK_DOCS = 8192
#: Most strings that a part of a regex is spelled out to.
MAX_STRINGS = 64
#: Least matches of a text that are placed one after the other in one run.
RUN = 64


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str
    group: int = 0
    least: int = 0     #: least length of that group

    def query(self):
        return trigram_query(self.regex)


#: The base kinds.  A run of one character class is the same whether its least
#: length is part of the regex or checked after it.
BASE = (Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        Rule("access", r"AKIA[A-Z0-9]{16,}"), Rule("hex", r"[0-9a-f]{24,}"))
MORE = (Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
        Rule("code_host", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
        Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
        Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
        Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
        Rule("payment", r"sk_live_[A-Za-z0-9]{16,}"))

# Queries: True (anything), a trigram, ("and", parts) or ("or", parts).


def _join(op: str, parts: list):
    flat = []
    for p in parts:
        flat += p[1] if isinstance(p, tuple) and p[0] == op else [p]
    if op == "and":
        flat = [p for p in flat if p is not True]
        if not flat:
            return True
    elif any(p is True for p in flat):
        return True
    flat = list(dict.fromkeys(flat))
    return flat[0] if len(flat) == 1 else (op, tuple(flat))


def _of_strings(strings: set[str]):
    return _join("or", [_join("and", [s[i:i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _strings(parsed) -> set[str] | None:
    """All strings, in lower case, that a piece of a regex matches, if they are few."""
    out = {""}
    for op, value in parsed:
        if op is node.LITERAL:
            own = {chr(value).lower()}
        elif op is node.IN:
            own = set()
            for kind, v in value:
                if kind is node.LITERAL:
                    own.add(chr(v).lower())
                elif kind is node.RANGE and v[1] - v[0] < MAX_STRINGS:
                    own |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
                else:
                    return None
        elif op is node.SUBPATTERN:
            own = _strings(value[3])
        elif op is node.BRANCH:
            parts = [_strings(p) for p in value[1]]
            own = None if None in parts else set().union(*parts)
        elif op in (node.MAX_REPEAT, node.MIN_REPEAT) and value[1] is not node.MAXREPEAT and value[1] <= 3:
            one = _strings(value[2])
            own = None if one is None else {"".join(p) for n in range(value[0], value[1] + 1) for p in product(one, repeat=n)}
        else:
            return None
        if own is None or len(out) * len(own) > MAX_STRINGS:
            return None
        out = {a + b for a in out for b in own}
    return out


def _query(parsed):
    parts, run = [], {""}
    for item in parsed:
        own = _strings([item])
        if own is not None and len(own) * len(run) <= MAX_STRINGS:
            run = {a + b for a in run for b in own}
            continue
        parts.append(_of_strings(run))
        run = own if own is not None else {""}
        if own is None:
            op, value = item
            if op is node.SUBPATTERN:
                parts.append(_query(value[3]))
            elif op is node.BRANCH:
                parts.append(_join("or", [_query(p) for p in value[1]]))
            elif op in (node.MAX_REPEAT, node.MIN_REPEAT) and value[0] > 0:
                parts.append(_query(value[2]))
    return _join("and", [*parts, _of_strings(run)])


def trigram_query(regex: str):
    """The trigrams that every match of ``regex`` contains, as a Boolean query; True if none
    are mandatory."""
    return _query(list(regex_parser.parse(regex)))


def trigrams(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def build_index(docs: DataFrame, wanted: list[str], text: str = "text", id: str = "doc_id") -> DataFrame:
    """``block``, ``trigram`` and ``ids`` (distinct) of the documents that contain it, written
    and read back.  Null ids are not indexed."""
    blocks = max(1, -(-docs.count() // BLOCK_DOCS))
    low = F.lower(F.col(text))
    present = F.array_compact(F.array(*[F.when(F.contains(F.col("low"), F.lit(t)), F.lit(t)) for t in wanted]))
    return written(docs.filter(F.col(id).isNotNull()).select(F.col(id).alias("id"), low.alias("low"))
                   .select("id", F.explode(present).alias("trigram"))
                   .groupBy(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), "trigram")
                   .agg(F.collect_set("id").alias("ids")), "trigram-index")


def candidates(index: DataFrame, queries: dict[str, object], wanted: list[str]) -> DataFrame:
    """``id`` and ``kinds``: the rules whose query the document's trigrams satisfy."""
    nothing = F.array().cast(index.schema["ids"].dataType)
    lists = index.groupBy("block").agg(*[F.first(F.when(F.col("trigram") == t, F.col("ids")), ignorenulls=True).alias(f"t{k}")
                                         for k, t in enumerate(wanted)])
    place = {t: F.coalesce(f"t{k}", nothing) for k, t in enumerate(wanted)}

    def ids(query) -> Column:
        if isinstance(query, str):
            return place[query]
        join = F.array_intersect if query[0] == "and" else F.array_union
        return reduce(join, map(ids, query[1]))

    def tagged(kind: str, query) -> Column:
        return F.transform(ids(query), lambda i: F.struct(i.alias("id"), F.lit(kind).alias("kind")))

    found = F.explode(F.flatten(F.array(*[tagged(k, q) for k, q in queries.items()])))
    return lists.select(found.alias("x")).groupBy("x.id").agg(F.collect_set("x.kind").alias("kinds"))


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """The rule's spans in a text as structs of start, number of the rule, end and kind."""
    pattern = F.lit(rule.regex)
    empty = F.array().cast("array<struct<start:int,number:int,end:int,kind:string>>")
    sizes = lambda strings: F.transform(strings, lambda s: F.length(s))
    matches = F.zip_with(sizes(F.regexp_extract_all(text, pattern, F.lit(0))),
                         sizes(F.regexp_extract_all(text, pattern, F.lit(rule.group))),
                         lambda own, checked: F.struct(own.alias("own"), checked.alias("checked")))
    found = F.zip_with(sizes(F.split(text, rule.regex, -1)), matches, lambda gap, m: F.struct(
        gap.alias("gap"), m["own"].alias("own"), m["checked"].alias("checked")))

    def of_run(run, begin):
        return F.aggregate(
            run, F.struct(begin.alias("at"), empty.alias("spans")),
            lambda acc, x: F.struct(
                (acc["at"] + _length(x)).alias("at"),
                F.when(x["own"].isNull() | (x["checked"] < rule.least), acc["spans"]).otherwise(F.array_append(
                    acc["spans"], F.struct((acc["at"] + x["gap"]).alias("start"), F.lit(number).alias("number"),
                                           (acc["at"] + x["gap"] + x["own"]).alias("end"), F.lit(rule.kind).alias("kind")))).alias("spans")),
            lambda acc: acc["spans"])

    placed = _let(_let(found, _runs), lambda runs: F.flatten(F.zip_with(runs, _begins(runs), of_run)))
    return F.when(text.rlike(rule.regex), placed).otherwise(empty)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def _length(x: Column) -> Column:
    return x["gap"] + F.coalesce(x["own"], F.lit(0))


def _runs(found: Column) -> Column:
    """``found`` cut into runs of about the root of its size, so that spans are appended to short
    arrays however many a text has."""
    size = F.greatest(F.lit(RUN), F.ceil(F.sqrt(F.size(found))).cast("int"))
    last = F.floor((F.size(found) - 1) / size).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(found, k * size + 1, size))


def _begins(runs: Column) -> Column:
    """Where each run begins in the text."""
    none = F.array().cast("array<int>")
    return F.aggregate(
        runs, F.struct(F.lit(0).alias("at"), none.alias("begins")),
        lambda acc, run: F.struct(F.aggregate(run, acc["at"], lambda at, x: at + _length(x)).alias("at"),
                                  F.array_append(acc["begins"], acc["at"]).alias("begins")),
        lambda acc: acc["begins"])


def scan(docs: DataFrame, rules=BASE + MORE, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Every row's id and ``found``: the spans of all rules by start, then in the rules' order.

    Null and empty texts have none.  Rows with a null id are searched with every rule; rows
    with equal ids are searched with the rules that any of them may match.  Other columns are
    ignored; an empty table gives no rows."""
    docs = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    queries = {r.kind: q for r in rules if (q := r.query()) is not True}
    wanted = sorted(set().union(*map(trigrams, queries.values())))
    if queries:
        possible = written(candidates(build_index(docs, wanted, "text", "id"), queries, wanted), "secret-candidates")
        docs = docs.join(possible.withColumnRenamed("id", "candidate"), F.col("id") == F.col("candidate"), "left")
    empty = F.array().cast("array<struct<start:int,number:int,end:int,kind:string>>")
    spans = [F.when(F.col("id").isNull() | F.array_contains("kinds", r.kind), _spans(F.col("text"), r, k)).otherwise(empty)
             if r.kind in queries else _spans(F.col("text"), r, k) for k, r in enumerate(rules)]
    return docs.select(F.col("id").alias(id), F.sort_array(F.concat(*spans)).alias("found"))


def span_list(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
