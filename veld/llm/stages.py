"""The operators as stages of a corpus pipeline: whole rows in, whole rows out.

Operators that report by id are given a key made of the id and the text's hash, without nulls,
so that rows without an id, or with one id and different texts, are told apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import postings, simhash
from .store import written

KEY = "__key"


def keyed(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    return docs.withColumn(KEY, F.struct(F.col(id).isNull().alias("no_id"), F.coalesce(F.col(id), F.lit(0)).alias("id"),
                                         F.xxhash64(text).alias("hash")))


def without_near_duplicates(docs: DataFrame, words: int, bits: int) -> DataFrame:
    """One row of each group of near-duplicates: the one of the smallest id (rows without an id
    come last); of rows with that id and text, the smallest in the other columns."""
    rows = keyed(docs)
    groups = written(simhash.near_duplicates(rows, words, bits, id=KEY), "near-duplicates")
    marks = written(groups.groupBy(KEY).agg((F.first(KEY) != F.first("component_id")).alias("goes"), F.count(F.lit(1)).alias("n"))
                    .filter("goes OR n > 1"), "near-duplicate-marks")
    # kept apart from the texts: only rows that go, or come more than once, are in ``marks``
    stay = rows.join(marks, KEY, "left_anti").select(*docs.columns)
    repeated = marks.filter("NOT goes").select(KEY)
    if repeated.isEmpty():
        return stay
    once = rows.join(repeated, KEY).groupBy(KEY).agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return stay.union(once)


def without_contaminated(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """The rows without an occurrence of a window of an item."""
    rows = keyed(docs)
    index = postings.build_index(rows, id=KEY)
    hit = postings.index_documents(index, KEY).join(
        postings.find_phrases(index, items, width).select("segment", "doc_no").hint("merge"), ["segment", "doc_no"]).select(KEY).distinct()
    return rows.join(written(hit, "contaminated"), KEY, "left_anti").select(*docs.columns)
