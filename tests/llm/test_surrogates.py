"""Surrogates: formats, coreference, ranges kept, clashing columns, and a plain-Python check over whole texts."""

import ipaddress
import os
import re

import pytest
import regex
from pyspark.sql import functions as F

from veld.llm import surrogates

SF = "/root/testdata/sf0.01"


def replaced(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [r.text for r in surrogates.replace_entities(docs, "k").orderBy("doc_id").collect()]


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for k, c in enumerate(reversed(digits))) % 10 == 0


def mod97(iban):
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


FORMS = [
    ("+44 20 7946 0958", r"\+44 \d\d \d{4} \d{4}"), ("+33 1 23 45 67 89", r"\+33 \d \d\d \d\d \d\d \d\d"), ("2125550187", r"\d{10}"),
    ("Dr. Smith", r"Dr\. [A-Z][a-z]+"), ("Prof. Jones", r"Prof\. [A-Z][a-z]+"), ("Господин Петров", r"Господин [А-Я][а-я]+(ов|ин|ев)"),
    ("госпожа Петрова", r"госпожа [А-Я][а-я]+(ова|ина|ева)"), ("κυρία Παπαδοπούλου", r"κυρία [Α-Ω]\w+(οπούλου|άκη|ίδου)"),
    ("MR. JONES", r"MR\. [A-Z]+"), ("078-05-1120", r"\d{3}-\d{2}-\d{4}"), ("2001:db8:85a3::8a2e:370:7334", r"2\w{3}:\w+:\w+::\w+:\w+:\w+"),
    ("fe80::1ff:fe23:4567:890a", r"fe80::\w+:\w+:\w+:\w+"), ("GB29 NWBK 6016 1331 9268 19", r"GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d"),
    ("DE89370400440532013000", r"DE\d{20}"), ("10.0.0.1", r"10\.\d+\.\d+\.\d+"), ("192.168.7.9", r"192\.168\.\d+\.\d+"),
    ("172.16.0.5", r"172\.\d+\.\d+\.\d+"), ("8.8.4.4", r"\d+\.\d+\.\d+\.\d+"), ("4111 1111 1111 1111", r"\d{4} \d{4} \d{4} \d{4}"),
    ("3782 822463 10005", r"\d{4} \d{6} \d{5}"), ("a.b1@mail.example.com", r"[a-z]\.[a-z]\d@[a-z]{6}\.example\.com"),
    ("Mrs. Anna Jones-Smith", r"Mrs\. [A-Z][a-z]+ [A-Z][a-z]+"), ("212-555-0187", r"\d{3}-\d{3}-\d{4}"), ("(212) 555 0187", r"\(\d{3}\) \d{3} \d{4}")]


def test_formats(spark):
    for (old, form), text in zip(FORMS, replaced(spark, [f"so {v}, it is" for v, _ in FORMS])):
        new = re.fullmatch("so (.*), it is", text)[1]
        assert new != old and re.fullmatch(form, new), (old, new)
        if old.startswith(("GB", "DE")):
            assert mod97(new.replace(" ", "")) == 1
        if old.startswith(("4111", "3782")):
            assert luhn(re.sub(r"\D", "", new))
        if re.fullmatch(r"[\d.]+\.[\d.]+", old) or "::" in old:
            assert ipaddress.ip_address(new).is_private == ipaddress.ip_address(old).is_private or "db8" in old


def test_what_is_no_entity_stays(spark):
    clean = ["order 1234567890123456 of 2024", "GB30 NWBK 6016 1331 9268 19", "at 12:30:45, std::vector a::b", "I miss Paris; MS Word", "version 1.2.3",
             "1700000000 seconds", "AB12 CDEF GHIJ", "Mr. jones", "000-12-3456", "x+12", "3+1234", "", "\n\n", "é" * 1000]
    assert replaced(spark, clean) == clean
    assert replaced(spark, [None]) == [None]


def test_coreference(spark):
    got = replaced(spark, ["Mr. Jones", "Mrs. Jones", "MR. JONES", "Dr. Adam Jones", "Mr. Adam Jones", "212-555-0187", "+1 212-555-0187", "(212) 555-0187",
                           "2125550187", "ann@x.org", "bob@x.org", "ANN@X.ORG", "господин Петров", "госпожа Петрова", "2001:db8::1:2", "2001:0DB8:0:0:0:0:1:2",
                           "4111 1111 1111 1111", "4111111111111111", "GB29NWBK60161331926819", "GB29 NWBK 6016 1331 9268 19"])
    jones = got[0].split()[-1]
    assert got[1].split()[-1] == jones and got[2].split()[-1] == jones.upper() and got[3].split()[-1] == jones and got[3].split()[1:] == got[4].split()[1:]
    assert len({re.sub(r"\D", "", g)[-10:] for g in got[5:9]}) == 1 and got[6].startswith("+1 ")
    assert got[9] == got[11] and got[9].split("@")[1] == got[10].split("@")[1] and got[9] != got[10]
    assert got[13].split()[1] == got[12].split()[1] + "а"
    assert ipaddress.ip_address(got[14]) == ipaddress.ip_address(got[15])
    assert got[16].replace(" ", "") == got[17] and got[18] == got[19].replace(" ", "")


def test_small_ranges_stay_distinct(spark):
    """A whole private range, one-letter mailboxes of one domain, and near all of a small IPv6 range."""
    private = replaced(spark, [f"192.168.{i}.{j}" for i in range(40) for j in range(256)])
    assert len(set(private)) == 40 * 256 and all(p.startswith("192.168.") for p in private)
    boxes = replaced(spark, [f"{c}@x.org" for c in "abcdefghijklmnopqrstuvwxyz0123456789"])
    assert len(set(boxes)) == 36
    link = replaced(spark, [f"fe80::{i:x}" for i in range(1, 3000)])
    assert len({ipaddress.ip_address(x) for x in link}) == 2999 and all(x.startswith("fe80:") for x in link)


def test_clashing_columns_and_rows(spark):
    docs = spark.createDataFrame([(1, "Mr. Jones", "mine", 7, "a", "b", "c"), (1, "Mr. Jones", None, None, None, None, None), (None, None, "x", 1, "", "", "")],
                                 "doc_id int, text string, entities string, h int, draws string, found string, `row` string")
    out = surrogates.replace_entities(docs, "k")
    assert out.columns == [*docs.columns, "entities_1"]
    rows = out.collect()
    assert sorted((r.entities or "") for r in rows) == ["", "mine", "x"] and len({r.text for r in rows if r.text}) == 1
    assert surrogates.replace_entities(docs, "k", counts=None).columns == docs.columns
    assert surrogates.replace_entities(docs.limit(0), "k").count() == 0
    other = docs.withColumnRenamed("text", "body").withColumn("text", F.lit("Mr. Jones"))
    kept = surrogates.replace_entities(other, "k", text="body").collect()
    assert all(r.text == "Mr. Jones" and (r.body is None or "Jones" not in r.body) for r in kept)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_all_documents_against_plain_python(spark):
    """Found by the same patterns in Python: what lies between entities stays, each normalised value has
    one surrogate everywhere, and no two values share one."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    old = {r.doc_id: r.text or "" for r in docs.collect()}
    out = surrogates.replace_entities(docs, "k").collect()
    assert len(out) == len(old)
    python = {k: regex.compile(p.replace(r"\p{IsCyrillic}", r"\p{Cyrillic}")) for k, p in surrogates.PATTERNS.items()}
    entity = regex.compile(surrogates.ENTITY)

    def kind_of(m):
        kind = next(k for k, p in python.items() if p.fullmatch(m))
        bad = kind == "card" and not luhn(re.sub(r"\D", "", m)) or kind == "iban" and mod97(m.replace(" ", "")) != 1
        return "none" if bad else kind

    def value(kind, m):
        if kind in ("card", "ssn", "phone"):
            d = re.sub(r"\D", "", m)
            return d[1:] if kind == "phone" and len(d) == 11 and d[0] == "1" else d
        return m.lower() if kind == "email" else " ".join(m.lower().split()[1:]) if kind == "name" else m

    forward, total = {}, 0
    for r in out:
        text, new = old[r.doc_id], r.text or ""
        found = list(entity.finditer(text))
        kinds = [kind_of(m[0]) for m in found]
        assert r.entities.asDict() == {f"n_{k}": kinds.count(k) for k in surrogates.KINDS}
        total += len(kinds) - kinds.count("none")
        gaps = [text[a:b] for a, b in zip([0, *[m.end() for m in found]], [*[m.start() for m in found], len(text)])]
        at = 0
        for gap, m, kind in zip(gaps, [*found, None], [*kinds, None]):
            assert new.startswith(gap, at)
            at += len(gap)
            if m is None:
                break
            if kind == "none":
                assert new.startswith(m[0], at)
                at += len(m[0])
                continue
            length = python[kind].match(new, at)
            assert length, (kind, m[0], new[at:at + 40])
            made = length[0]
            assert made != m[0] or kind == "ip" and ipaddress.ip_address(m[0]).is_private
            at += len(made)
            assert forward.setdefault((kind, value(kind, m[0])), value(kind, made)) == value(kind, made)
        assert at == len(new)
    assert total > 0 and len({(k, v) for (k, _), v in forward.items()}) == len(forward)
