"""Two-pass shuffle: every record once, counts at most one apart, slots without gaps."""

import collections

import pytest
from pyspark.sql import functions as F

from veld.llm import shards

SCHEMA = "doc_id long, text string, shard string, slot string, bucket string, hash string, before string"


def make(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "s", "l", "b", "h", "x") for i, t in rows], SCHEMA).repartition(parts)


ROWS = [(i, f"text {i} " * (i % 7)) for i in range(300)] + [(None, "n"), (None, None), (7, None), (8, "")] + \
    [(5, "copy")] * 150 + [(9, "long " * 50_000)]


def law_holds(rows, n, count):
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[k]) for k in range(count)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(count))


@pytest.mark.parametrize("bucket_bytes", [1 << 25, 4000, 300])
def test_records_are_whole_and_counts_even(spark, bucket_bytes):
    got = shards.write_shards(make(spark, ROWS), 7, 3, bucket_bytes=bucket_bytes).collect()
    law_holds(got, len(ROWS), 7)
    assert collections.Counter((r["record"]["doc_id"], r["record"]["text"]) for r in got) == collections.Counter(ROWS)
    assert {tuple(r["record"])[2:] for r in got} == {("s", "l", "b", "h", "x")}


def test_copies_of_one_record_are_scattered(spark):
    """A third of the rows and more are one record; no bucket holds them all."""
    scattered, buckets, rows = shards.scatter(make(spark, ROWS), 3, bucket_bytes=300)
    assert rows == len(ROWS) and buckets > 100
    largest = scattered.filter("record.text = 'copy'").groupBy("bucket").count().agg(F.max("count")).first()[0]
    assert largest < 15


def test_the_seed_decides_whatever_the_order(spark):
    rows = [(i, f"text {i}") for i in range(500)]
    run = lambda seed, parts: [r["record"]["doc_id"] for r in sorted(
        shards.write_shards(make(spark, rows, parts), 4, seed, bucket_bytes=2000).collect(), key=lambda r: (r["shard"], r["slot"]))]
    first = run(1, 2)
    assert first == run(1, 5) and first != run(2, 2) and sorted(first) == list(range(500))
    neighbours = sum(abs(a - b) == 1 for a, b in zip(first, first[1:]))
    assert neighbours < 20


def test_fewer_rows_than_shards_and_none(spark):
    law_holds(shards.write_shards(make(spark, ROWS[:3]), 40, 3).collect(), 3, 40)
    assert shards.write_shards(make(spark, []), 40, 3).collect() == []


def test_starts_of_buckets(spark, monkeypatch):
    monkeypatch.setattr(shards, "COARSE", 4)
    df = spark.range(1000).select((F.pmod(F.xxhash64("id"), F.lit(37))).alias("bucket"))
    counts = dict(map(tuple, df.groupBy("bucket").count().collect()))
    want = {b: sum(n for c, n in counts.items() if c < b) for b in counts}
    assert dict(map(tuple, shards.bucket_starts(df).collect())) == want
