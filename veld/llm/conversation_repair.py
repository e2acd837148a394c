"""Conversation structure repair by Knuth's lightest-derivation agenda.

A conversation is well formed when the initials of its roles read ``(s?(ua)+)?``.  Four edits
lead there: keep a row (cost 0), rerole it to user or assistant (3), delete it (4), insert an
empty row of user or assistant (3); a truncated row that stays costs 3 more, a blank or
repeated row must go.  The *audit* is the edits' initials in order.  Among the cheapest
repairs the one with the ASCII-least audit is taken.

Partial repairs are items of a weighted hypergraph: ``(i, p, q)`` says that the first ``i`` rows
of a block lead from state ``p`` of the grammar's automaton to ``q``, and two spans that meet
in a state derive the span of both.  ``lightest`` pops items by (cost, audit) and an item is
final when it is popped.  Cost and audit only grow by a deduction, and an audit decides its
own cost, so of two derivations of one item with equal cost neither audit begins with the
other: appending the same edits keeps their order, which makes every deduction monotone and
superior, as the agenda needs.

Rows are numbered by one sort over all conversations and cut into blocks of ``2**BLOCK_BITS``
rows, so a conversation of any length is many small blocks: spans of blocks are derived
apart, then joined ``2**FAN_BITS`` at a time.  Only the edits (one letter a row) of a conversation
ever come together, as the audit itself must; texts stream past them in order.

Defined results.  Rows are in order of (turn, role, hash of the text), null turns first.  Null
role or text is one space; null conversation ids are one conversation.  Equal rows stay as
often as they come and are duplicates of the first.  A role that begins with none of s, u, a
fits nowhere as it is.  An empty table gives no rows.  Other columns are never looked at,
whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written

#: Rows of a block, and spans joined at once, as powers of two.
BLOCK_BITS, FAN_BITS = 8, 6

#: White space, ends of a sentence, and the costs of the edits.
BLANKS = " \t\n\x0b\x0c\r"
STOPS = (".", "!", "?")
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

#: The automaton of (s?(ua)+)?: 0 nothing yet, 1 after s, 2 after u, 3 after a; it ends in 0 or 3.
STATES = range(4)
MOVES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The role a rerole or an insert gives in each state.
FREE = ("u", "u", "a", "u")
FULL = {"u": "user", "a": "assistant"}
FINE, BLANK, DUPLICATE, CUT = range(4)
LEGAL_PAIRS = {"su", "ua", "au"}

ITEMS = "array<struct<p:int,q:int,cost:bigint,audit:string>>"


def lightest(axioms: Iterable[tuple], consequences: Callable, goals: set | None = None) -> dict:
    """The lightest (cost, audit) of every item that can be derived, or of ``goals`` alone.

    ``axioms`` are (item, cost, audit); ``consequences(item, weight, final)`` yields the heads that
    follow from an item just finalised together with items that are final already."""
    agenda = [(cost, audit, item) for item, cost, audit in axioms]
    heapq.heapify(agenda)
    final: dict = {}
    open_goals = set(goals) if goals is not None else None
    while agenda:
        cost, audit, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = cost, audit
        if open_goals is not None:
            open_goals.discard(item)
            if not open_goals:
                break
        for head, c, a in consequences(item, (cost, audit), final):
            if head not in final:
                heapq.heappush(agenda, (c, a, head))
    return final


def decode(letter: str) -> tuple[str, int]:
    """Initial (s, u, a, other) and fault of a row from its letter in a pattern."""
    fault, initial = divmod(ord(letter) - 65, 4)
    return "sua?"[initial], fault


@lru_cache(maxsize=50_000)
def block_items(pattern: str) -> tuple:
    """The lightest repairs of a block of rows from every state to every state."""
    rows = [decode(letter) for letter in pattern]
    n = len(rows)

    def consequences(item, weight, final):
        i, p, q = item
        cost, audit = weight
        to = MOVES[q][FREE[q]]
        yield (i, p, to), cost + INSERT, audit + "I"
        if i < n:
            initial, fault = rows[i]
            yield (i + 1, p, q), cost + DELETE, audit + "D"
            if fault in (FINE, CUT):
                stays = TRUNCATED if fault == CUT else 0
                yield (i + 1, p, to), cost + REROLE + stays, audit + "R"
                if initial in MOVES[q]:
                    yield (i + 1, p, MOVES[q][initial]), cost + stays, audit + "K"

    final = lightest([((0, p, p), 0, "") for p in STATES], consequences)
    return tuple((p, q, *final[n, p, q]) for p in STATES for q in STATES if (n, p, q) in final)


def joined_items(spans: list[list[tuple]]) -> list[tuple]:
    """The lightest repairs of spans in a row, from those of each: a span item and a path item
    that meet in a state are the two antecedents of a longer path."""
    leaving: dict = {}

    def consequences(item, weight, final):
        kind, k, p, q = item
        if kind == "span":
            pairs = [(("path", k, s, p), item) for s in STATES]
            leaving.setdefault((k, p), []).append(item)
        else:
            pairs = [(item, span) for span in leaving.get((k, q), ())]
        for path, span in pairs:
            if path in final and span in final:
                (c, a), (d, b) = final[path], final[span]
                yield ("path", k + 1, path[2], span[3]), c + d, a + b

    axioms = [(("path", 0, p, p), 0, "") for p in STATES]
    axioms += [(("span", k, p, q), cost, audit) for k, items in enumerate(spans) for p, q, cost, audit in items]
    final = lightest(axioms, consequences)
    n = len(spans)
    return [(p, q, *final["path", n, p, q]) for p in STATES for q in STATES if ("path", n, p, q) in final]


def _span_schema(turn: str) -> str:
    return (f"struct<first:string,last:string,lo:{turn},hi:{turn},turns:bigint,blank:bigint,duplicate:bigint,"
            f"truncated:bigint,illegal:bigint,items:{ITEMS}>")


def _illegal(initials: str) -> int:
    return sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:]))


@lru_cache(maxsize=50_000)
def _block_counts(pattern: str) -> tuple:
    rows = [decode(letter) for letter in pattern]
    initials = "".join(initial for initial, _ in rows)
    return (initials[0], initials[-1], *[sum(f == kind for _, f in rows) for kind in (BLANK, DUPLICATE, CUT)],
            _illegal(initials))


def _block_span(row: dict) -> dict:
    first, last, blank, duplicate, truncated, illegal = _block_counts(row["pattern"])
    return {"first": first, "last": last, "lo": row["lo"], "hi": row["hi"], "turns": row["turns"], "blank": blank,
            "duplicate": duplicate, "truncated": truncated, "illegal": illegal,
            "items": [dict(zip(("p", "q", "cost", "audit"), item)) for item in block_items(row["pattern"])]}


def _joined_span(spans: list[dict]) -> dict:
    if len(spans) == 1:
        return spans[0]
    out = dict(spans[0])
    for s in spans[1:]:
        # turns ascend, nulls first: a turn can only come in two spans as the last of one, the first of the next
        out["turns"] += s["turns"] - (out["hi"] is not None and out["hi"] == s["lo"])
        out["lo"] = s["lo"] if out["lo"] is None else out["lo"]
        out["hi"] = out["hi"] if s["hi"] is None else s["hi"]
        out["illegal"] += s["illegal"] + _illegal(out["last"] + s["first"])
        out["last"] = s["last"]
        for name in ("blank", "duplicate", "truncated"):
            out[name] += s[name]
    items = [[(i["p"], i["q"], i["cost"], i["audit"]) for i in s["items"]] for s in spans]
    out["items"] = [dict(zip(("p", "q", "cost", "audit"), item)) for item in joined_items(items)]
    return out


def _map_spans(df: DataFrame, span: Callable[[dict], dict], kinds: tuple[str, str]) -> DataFrame:
    """``conv``, ``at`` and the span that ``span`` makes of each row."""
    schema = f"conv {kinds[0]}, at bigint, span {_span_schema(kinds[1])}"
    arrow = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [{"conv": r["conv"], "at": r["at"], "span": span(r)} for r in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return df.mapInArrow(run, schema)


def _arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    return to_arrow_schema(_parse_datatype_string(ddl))


def _rows(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    rows = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                       F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def repair_plans(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """One row per conversation: ``conv``, its faults (``gaps``, ``blank``, ``duplicate``, ``truncated``,
    ``illegal``) and the lightest repair (``cost``, ``audit``)."""
    rows = _rows(rows, conv, turn, role, text)
    order = ["conv", "turn", "role", "digest"]
    seen = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(seen == "", BLANK).when(~F.right(seen, F.lit(1)).isin(*STOPS), CUT).otherwise(FINE)
    # the number of a row orders all rows; written, so that no later stage can number them anew
    numbered = written(rows.select(*order, fault.alias("fault")).repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumn("no", F.monotonically_increasing_id()), "conversation-rows")
    # joined by number, not by (conversation, role, text): no key is frequent
    firsts = numbered.groupBy("conv", "role", "digest").agg(F.min("no").alias("no")).select("no", F.lit(True).alias("new"))
    marked = numbered.join(firsts.hint("merge"), "no", "left")
    kind = F.when(F.col("fault") == BLANK, BLANK).when(F.col("new").isNull(), DUPLICATE).otherwise(F.col("fault"))
    initial = F.left("role", F.lit(1))
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    blocks = marked.select("conv", F.shiftright("no", BLOCK_BITS).alias("at"),
                           F.struct("no", F.char((65 + 4 * kind + place).cast("long")).alias("code"), "turn").alias("row")) \
        .groupBy("conv", "at").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    turns = F.array_compact(F.array_distinct(F.col("rows.turn")))
    blocks = blocks.select("conv", "at", F.array_join("rows.code", "").alias("pattern"), F.array_min(turns).alias("lo"),
                           F.array_max(turns).alias("hi"), F.size(turns).cast("long").alias("turns"))
    kinds = tuple(numbered.schema[c].dataType.simpleString() for c in ("conv", "turn"))
    spans = _whole(written(_map_spans(blocks, _block_span, kinds), "spans"), kinds)
    ends = F.filter("span.items", lambda i: (i["p"] == 0) & i["q"].isin(0, 3))
    best = F.array_min(F.transform(ends, lambda i: F.struct(i["cost"], i["audit"])))
    gaps = F.coalesce(F.col("span.hi") - F.col("span.lo") + 1 - F.col("span.turns"), F.lit(0)).cast("long")
    return spans.select("conv", gaps.alias("gaps"), *[f"span.{c}" for c in ("blank", "duplicate", "truncated", "illegal")],
                        best["cost"].alias("cost"), best["audit"].alias("audit"))


def _whole(spans: DataFrame, kinds: tuple[str, str]) -> DataFrame:
    """Spans joined until each conversation has one.  A round joins at most ``2**FAN_BITS`` of a
    conversation in one task."""
    while True:
        most = spans.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return spans
        at = F.lit(0).cast("long") if most <= 2 ** FAN_BITS else F.shiftright("at", FAN_BITS)
        groups = spans.groupBy("conv", at.alias("to")).agg(F.array_sort(F.collect_list(F.struct("at", "span"))).alias("parts"))
        spans = written(_map_spans(groups.select("conv", F.col("to").alias("at"), F.col("parts.span").alias("spans")),
                                   lambda r: _joined_span(r["spans"]), kinds), "spans")


def _stream(rows: DataFrame, plans: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Each conversation's plan, then its rows in order, in one task's sorted stream."""
    facts = [c for c in plans.columns if c != "conv"]
    plan = plans.select("conv", F.struct(*facts).alias("plan"))
    return _rows(rows, conv, turn, role, text).unionByName(plan, allowMissingColumns=True).repartition("conv") \
        .sortWithinPartitions("conv", F.col("plan").isNull(), "turn", "role", "digest")


class _Editor:
    """Applies an audit to rows that come one by one."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0

    def _free(self) -> str:
        initial = FREE[self.state]
        self.state = MOVES[self.state][initial]
        return FULL[initial]

    def inserts(self) -> Iterator[tuple]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield "I", self._free(), ""

    def row(self, role: str, text: str) -> Iterator[tuple]:
        """The repaired rows up to and with this one, as (edit, role, text)."""
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            yield "R", self._free(), text
        elif edit == "K":
            self.state = MOVES[self.state][role[0]]
            yield "K", role, text


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, plan, edit, role, text) of every repaired row; a conversation begins with a
    row without an edit."""
    editor = conv = plan = None
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            for r in batch.slice(start, 256).to_pylist():
                if r["plan"] is not None:
                    if editor:
                        yield from ((conv, plan, *row) for row in editor.inserts())
                    conv, plan = r["conv"], r["plan"]
                    editor = _Editor(plan["audit"])
                    yield conv, plan, None, None, None
                else:
                    yield from ((conv, plan, *row) for row in editor.row(r["role"], r["text"]))
    if editor:
        yield from ((conv, plan, *row) for row in editor.inserts())


def repaired_rows(rows: DataFrame, plans: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """The repaired conversations: ``conv``, ``position`` (from 0), ``edit`` (K, R or I), ``role``, ``text``."""
    stream = _stream(rows, plans, conv, turn, role, text)
    schema = f"conv {stream.schema['conv'].dataType.simpleString()}, position bigint, edit string, role string, text string"
    arrow = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, position = [], 0, 0
        for conv, _, edit, role, text in _repaired(batches):
            if edit is None:
                position = 0
                continue
            out.append({"conv": conv, "position": position, "edit": edit, "role": role, "text": text})
            position, size = position + 1, size + len(text)
            if len(out) >= 4096 or size > 4 << 20:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out, size = [], 0
        yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return stream.mapInArrow(run, schema)


def repair_digests(rows: DataFrame, plans: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """The plans with ``repaired_sha256``, the hash of each repaired conversation's ``role:text`` lines."""
    stream = _stream(rows, plans, conv, turn, role, text)
    kind = stream.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, plan {stream.schema['plan'].dataType.simpleString()}, repaired_sha256 string"
    arrow = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, current = [], None
        for conv, plan, edit, role, text in _repaired(batches):
            if edit is None:
                if current:
                    out.append(current | {"repaired_sha256": digest.hexdigest()})
                current, digest, between = {"conv": conv, "plan": plan}, hashlib.sha256(), b""
                if len(out) >= 4096:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
                    out = []
            else:
                digest.update(between + role.encode() + b":")
                digest.update(text.encode())
                between = b"\n"
        if current:
            out.append(current | {"repaired_sha256": digest.hexdigest()})
        yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return stream.mapInArrow(run, schema).select("conv", "plan.*", "repaired_sha256")


def damage(rows: DataFrame) -> DataFrame:
    """Conversations damaged by ``crc32(conv_id:turn) % 20`` (nulls are one space): 0 drops the row,
    1 empties its text, 2 removes the ends of sentences, 3 repeats the row, 4 makes the role user."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))), F.lit(20))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(part("text"), "".join(STOPS), "")).otherwise(part("text"))
    role = F.when(kind == 4, "user").otherwise(part("role"))
    return rows.filter(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"),
                                         F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def repair_report(conversations: DataFrame) -> DataFrame:
    """Every conversation id of the table with the faults of its damaged rows and their repair."""
    rows = damage(conversations)
    done = repair_digests(rows, repair_plans(rows))
    ids = conversations.select("conv_id").distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return ids.join(done.hint("merge"), F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
