"""Quality rules as a learned decision list, in DataFrame operations only.

Texts become a few interpretable statistics.  Sequential covering learns, from labelled rows,
an ordered list of conjunctions of thresholds that each mean "reject": a rule grows by the
condition of largest information gain (FOIL) over the grow fold until it covers no good row
or has ``MAX_CONDITIONS`` conditions, is pruned from its end on the prune fold, and is taken
if it is precise there; rows that it covers are set aside and the next rule grows on the rest.
The list is emitted as one Spark conditional expression, and everything else is accepted.

Learning never moves rows to the driver: labelled rows are put into bins at their statistics'
quantiles and counted, and each step asks for counts by statistic and bin (at most
statistics x ``BINS`` rows).
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written

BINS = 24
MAX_RULES = 8
MAX_CONDITIONS = 3
#: Least precision on the prune fold, and least share of the labelled bad rows, of a rule.
MIN_PRECISION = 0.9
MIN_SUPPORT = 0.01
#: Statistics that rules may use.
STATISTICS = ("n_words", "mean_word_chars", "symbol_share", "capital_share", "distinct_share",
              "repeat_share", "duplicate_line_share", "mark_share")

_WHITE = r"[ \t\n\x0B\f\r]"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _repeated(docs: DataFrame) -> DataFrame:
    """``n_repeat_words`` from ``words``: words inside 3-word windows that the text has twice.

    Windows are sorted by 32 bits of their hash, with their place in the low bits; only those
    that share a hash with a neighbour are compared as text."""
    n = F.size("words")
    high = F.lit(-(1 << 32))
    # one array per step, each in a column of its own, so that no step is evaluated twice
    docs = docs.withColumn("marked", F.when(n >= 3, F.sort_array(F.transform(
        F.slice("words", 1, F.greatest(n - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)).bitwiseAND(high) + i))))
    docs = docs.withColumn("suspects", F.filter("marked", lambda x, i: F.coalesce(
        (F.shiftright(x, 32) == F.shiftright(F.get("marked", i - 1), 32)), F.lit(False)) | F.coalesce(
        (F.shiftright(x, 32) == F.shiftright(F.get("marked", i + 1), 32)), F.lit(False))))

    def window(x):
        at = x.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
        return F.struct(F.concat_ws(" ", F.get("words", at), F.get("words", at + 1), F.get("words", at + 2)).alias("w"), at.alias("at"))

    docs = docs.withColumn("compared", F.when(F.size("suspects") > 0, F.sort_array(F.transform("suspects", window))))
    docs = docs.withColumn("places", F.sort_array(F.transform(F.filter("compared", lambda x, i: F.coalesce(
        x["w"] == F.get("compared", i - 1)["w"], F.lit(False)) | F.coalesce(
        x["w"] == F.get("compared", i + 1)["w"], F.lit(False))), lambda x: x["at"])))
    covered = F.aggregate(F.transform("places", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("places", i + 1) - p, F.lit(3)))),
                          F.lit(0).cast("long"), lambda acc, x: acc + x)
    return docs.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))) \
        .drop("marked", "suspects", "compared", "places")


def text_statistics(docs: DataFrame, text: str = "text", id: str = "doc_id", carry: bool = False) -> DataFrame:
    """The id, the base counts and the statistics of every row; a null text has no words.  With
    ``carry``, the whole row comes along as the struct ``row``."""
    t, words = F.col("t"), F.col("words")
    along = ["row"] if carry else []
    docs = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"),
                       *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []))
    docs = docs.withColumn("words", F.array_remove(F.split("t", _WHITE + "+"), ""))
    docs = docs.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike("[^ \\t\\n\\x0B\\f\\r]")))
    gone = lambda chars: (F.length(t) - F.length(F.translate(t, chars, ""))).cast("long")
    docs = _repeated(docs).select(
        "id", *along, F.size(words).cast("long").alias("n_words"), F.length(F.concat_ws("", words)).cast("long").alias("word_chars"),
        gone("#*$%&|<>").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), "n_repeat_words",
        F.size("lines").alias("n_lines"), F.size(F.array_distinct(words)).alias("n_distinct"),
        gone(_CAPITALS).alias("n_capitals"), gone("!?.,;:").alias("n_marks"))
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return docs.withColumns({
        "mean_word_chars": share("word_chars", "n_words"), "symbol_share": share("n_symbols", "n_words"),
        "capital_share": share("n_capitals", "word_chars"), "distinct_share": share("n_distinct", "n_words"),
        "repeat_share": share("n_repeat_words", "n_words"), "duplicate_line_share": share("n_dup_lines", "n_lines"),
        "mark_share": share("n_marks", "n_words")})


@dataclass(frozen=True)
class Condition:
    """``statistic > threshold`` or ``statistic <= threshold``; ``bin`` is the threshold's place."""

    statistic: str
    above: bool
    bin: int
    threshold: float

    def expression(self) -> Column:
        value = F.col(self.statistic)
        return value > self.threshold if self.above else value <= self.threshold

    def on_bins(self) -> Column:
        bin = F.col(f"bin_{self.statistic}")
        return bin > self.bin if self.above else bin <= self.bin

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _all(columns: list[Column]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & c
    return out


def _any(columns: list[Column]) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | c
    return out


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (log2(p / (p + n)) - log2(p0 / (p0 + n0))) if p else 0.0


def learn_rules(labelled: DataFrame, statistics=STATISTICS, max_rules: int = MAX_RULES,
                max_conditions: int = MAX_CONDITIONS, min_precision: float = MIN_PRECISION,
                min_support: float = MIN_SUPPORT) -> list[Rule]:
    """An ordered list of rules for rows with ``bad`` true.

    ``labelled`` has ``id``, ``bad`` (boolean) and the statistics.  A third of the rows, by the
    hash of their id, is for pruning.  Without bad or without good rows there are no rules."""
    steps = [k / BINS for k in range(1, BINS)]
    found = labelled.agg(*[F.percentile_approx(s, steps, 10_000).alias(s) for s in statistics]).first()
    thresholds = {s: sorted(set(map(float, found[s] or []))) for s in statistics}
    bins = [sum((F.when(F.col(s) > t, 1).otherwise(0) for t in cuts), F.lit(0)).alias(f"bin_{s}")
            for s, cuts in thresholds.items()]
    prune = (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).alias("prune")
    cells = written(labelled.select(*bins, "bad", prune).groupBy(*[f"bin_{s}" for s in statistics], "prune").agg(
        F.sum(F.col("bad").cast("long")).alias("p"), F.sum((~F.col("bad")).cast("long")).alias("n")), "rule-cells")
    all_bad = cells.agg(F.sum("p")).first()[0] or 0
    rules: list[Rule] = []
    while len(rules) < max_rules:
        left = cells.filter(~_any([_all([c.on_bins() for c in r]) for r in rules]))
        rule = _grow(left.filter("not prune"), statistics, thresholds, max_conditions)
        if not rule:
            break
        rule, p, n = _prune(left.filter("prune"), rule)
        if not rule or p < min_precision * (p + n) or 3 * p < min_support * all_bad:
            break
        rules.append(rule)
    return rules


def _grow(cells: DataFrame, statistics, thresholds, max_conditions: int) -> Rule:
    rule: list[Condition] = []
    while len(rule) < max_conditions:
        part = cells.filter(_all([c.on_bins() for c in rule]))
        tagged = F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.col(f"bin_{s}").alias("b")) for s in statistics]))
        counts: dict[str, dict[int, tuple[int, int]]] = {}
        for r in part.select(tagged.alias("x"), "p", "n").groupBy("x.s", "x.b").agg(F.sum("p").alias("p"), F.sum("n").alias("n")).collect():
            counts.setdefault(r.s, {})[r.b] = (r.p, r.n)
        if not counts:
            break
        some = next(iter(counts.values())).values()
        p0, n0 = sum(p for p, _ in some), sum(n for _, n in some)
        if not p0 or not n0:
            break
        best, best_gain, best_left = None, 1e-9, n0
        for s in statistics:
            low_p = low_n = 0
            for b, t in enumerate(thresholds[s]):
                p, n = counts.get(s, {}).get(b, (0, 0))
                low_p, low_n = low_p + p, low_n + n
                for above, cp, cn in ((False, low_p, low_n), (True, p0 - low_p, n0 - low_n)):
                    gain = _gain(cp, cn, p0, n0)
                    if gain > best_gain:
                        best, best_gain, best_left = Condition(s, above, b, t), gain, cn
        if best is None:
            break
        rule.append(best)
        if not best_left:
            break
    return tuple(rule)


def _prune(cells: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The best start of the rule on the prune fold, and the bad and good rows it covers."""
    starts = [rule[:k] for k in range(1, len(rule) + 1)]
    count = lambda column, r: F.sum(F.when(_all([c.on_bins() for c in r]), F.col(column)).otherwise(0))
    row = cells.agg(*[count("p", r).alias(f"p{k}") for k, r in enumerate(starts)],
                    *[count("n", r).alias(f"n{k}") for k, r in enumerate(starts)]).first()
    scored = []
    for k, r in enumerate(starts):
        p, n = row[f"p{k}"] or 0, row[f"n{k}"] or 0
        if p + n:
            scored.append(((p - n) / (p + n), p, r, n))
    if not scored:
        return (), 0, 0
    _, p, r, n = max(scored, key=lambda x: x[:2])
    return r, p, n


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that fires (from 1), or 0: an ordered conditional."""
    out = None
    for k, rule in enumerate(rules, 1):
        fires = _all([c.expression() for c in rule])
        out = F.when(fires, F.lit(k)) if out is None else out.when(fires, F.lit(k))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def learn(stats: DataFrame, labels: DataFrame, id: str = "doc_id") -> list[Rule]:
    """The rules from the statistics of all rows and the labels of some."""
    marks = labels.filter("quality IS NOT NULL").select(F.col(id).alias("id"), (F.col("quality") == 0).alias("bad"))
    return learn_rules(stats.filter(~base_failed()).join(marks, "id").select("id", "bad", *STATISTICS))


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Every row's id, base counts, ``base_failed``, ``rule`` (the rule that rejects it, from 1;
    0: none) and ``kept``.

    ``labels`` has the id and ``quality`` (0 is bad); labels without a quality or an id, or whose
    document fails the base checks, teach nothing; a document with several labels counts as
    often.  Null texts have no words and fail.  Rows with null or repeated ids stay; other
    columns are ignored; an empty table gives no rows."""
    stats = written(text_statistics(docs, text, id), "text-statistics")
    judged = stats.withColumn("base_failed", base_failed()).withColumn("rule", verdict(learn(stats, labels, id)))
    return judged.select(F.col("id").alias(id), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"), "rule")


def accepted(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, as they are, that ``judge`` keeps.  Texts are read and measured
    once: rows and statistics are written together, and the rules are learnt from those."""
    stats = written(text_statistics(docs, text, id, carry=True), "measured-texts")
    return stats.filter(~base_failed() & (verdict(learn(stats, labels, id)) == 0)).select("row.*")
