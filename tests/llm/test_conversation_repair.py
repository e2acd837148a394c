"""Conversation repair against a plain dynamic programme over every state and edit."""

import hashlib
import random
import re
import zlib

import pytest

from veld.llm import conversation_repair as C

SCHEMA = "conv_id long, turn long, role string, text string, conv string, plan string, digest string, span string"


def damaged(rows):
    out = {}
    for c, t, r, x in rows:
        kept = out.setdefault(c, [])
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        if kind:
            kept += [(t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    return out


def brute(rows):
    moves = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
    out = {}
    for c, rs in damaged(rows).items():
        rs.sort(key=lambda v: (v[0] is not None, v[0] or 0, v[1], hashlib.sha256(v[2].encode()).digest()))
        turns = [t for t, *_ in rs if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults = set(), []
        for _, r, x in rs:
            visible = re.findall("[^\x20\x09-\x0D]", x)
            faults.append("b" if not visible else "d" if (r, x) in seen else "t" if visible[-1] not in ".!?" else "")
            seen.add((r, x))
        initials = [r[:1] for _, r, _ in rs]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        best = [{} for _ in range(len(rs) + 1)]
        best[0][0] = (0, "", ())

        def reach(i, q, cost, audit, lines):
            if q not in best[i] or (cost, audit) < best[i][q][:2]:
                best[i][q] = cost, audit, lines

        for i in range(len(rs) + 1):
            for _ in range(6):
                for q, (cost, audit, lines) in list(best[i].items()):
                    free = "a" if q == 2 else "u"
                    reach(i, moves[q][free], cost + 3, audit + "I", lines + ((free, None, ""),))
            for q, (cost, audit, lines) in best[i].items() if i < len(rs) else ():
                free = "a" if q == 2 else "u"
                _, r, x = rs[i]
                reach(i + 1, q, cost + 4, audit + "D", lines)
                if faults[i] in ("", "t"):
                    stays = 3 * (faults[i] == "t")
                    reach(i + 1, moves[q][free], cost + 3 + stays, audit + "R", lines + ((free, None, x),))
                    if r[:1] in moves[q]:
                        reach(i + 1, moves[q][r[:1]], cost + stays, audit + "K", lines + ((None, r, x),))
        cost, audit, lines = min(best[-1][q] for q in (0, 3) if q in best[-1])
        full = {"u": "user", "a": "assistant"}
        lines = [(r if free is None else full[free], x) for free, r, x in lines]
        out[c] = (gaps, *[faults.count(f) for f in "bdt"], illegal, cost, audit,
                  hashlib.sha256("\n".join(f"{r}:{x}" for r, x in lines).encode()).hexdigest()), lines
    return out


def random_rows(n):
    rng = random.Random(n)
    roles = ["system", "user", "assistant"] * 4 + ["tool", None, "", "u", "user"]
    texts = ["a.", "b", "", " \n", "c! ", "é?", None, "no end", *[f"text {k}." for k in range(40)]]
    return [(rng.choice([None, *[1] * 6, *range(2, 30)]), rng.choice([None, *range(60)]), rng.choice(roles), rng.choice(texts))
            for _ in range(n)]


@pytest.mark.parametrize("bits, fan", [(8, 6), (1, 1), (3, 2)])
def test_faults_and_lightest_repair(spark, monkeypatch, bits, fan):
    """Blocks of any size, joined in any number of rounds, give the whole conversation's repair."""
    monkeypatch.setattr(C, "BLOCK_BITS", bits)
    monkeypatch.setattr(C, "FAN_BITS", fan)
    rows = random_rows(700)
    df = spark.createDataFrame([(*r, "c", "p", "d", "s") for r in rows], SCHEMA).repartition(4)
    want = {c: facts for c, (facts, _) in brute(rows).items()}
    assert {r[0]: tuple(r)[1:] for r in C.repair_report(df).collect()} == want


def test_repaired_rows_are_well_formed(spark):
    rows = random_rows(300)
    df = C.damage(spark.createDataFrame([(*r, "c", "p", "d", "s") for r in rows], SCHEMA))
    got = {}
    for r in sorted(C.repaired_rows(df, C.repair_plans(df)).collect(), key=lambda r: r["position"]):
        got.setdefault(r["conv"], []).append((r["role"], r["text"]))
    assert got == {c: lines for c, (_, lines) in brute(rows).items() if lines}
    assert all(re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in lines)) for lines in got.values())


def test_lost_and_empty_conversations(spark):
    keys = [(c, t) for c in range(40) for t in range(40) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:3]
    df = spark.createDataFrame([(c, t, "user", "x.") for c, t in keys], "conv_id long, turn long, role string, text string")
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(map(tuple, C.repair_report(df).collect())) == sorted({(c, 0, 0, 0, 0, 0, 0, "", empty) for c, _ in keys})
    assert C.repair_report(df.limit(0)).collect() == []


def test_agenda_pops_each_item_at_its_lightest():
    """Two antecedents: the span of both halves is derived once both are final."""
    spans = [[(0, 2, 3, "I"), (0, 2, 3, "K")], [(2, 3, 0, "K"), (2, 3, 0, "D")]]
    assert C.joined_items(spans) == [(0, 3, 3, "ID")]


def test_a_long_text_and_many_copies(spark):
    rows = [(1, 1, "user", "w " * 200_000 + "."), *[(1, 2, "assistant", "same.")] * 700, (1, None, "system", "s.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    plan = C.repair_plans(df).first()
    assert (plan["duplicate"], plan["cost"], plan["audit"]) == (699, 4 * 699, "KKK" + "D" * 699)
