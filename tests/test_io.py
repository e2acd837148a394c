import json
import os
import uuid

import pytest

from veld.operators.geo import lookup_table
from veld.session import checkpoint_root
from veld.sources import io


def _dir(spark):
    """A fresh local folder under the checkpoint root (the root is a ``file:`` URI)."""
    root = checkpoint_root(spark)
    root = root[len("file:"):] if root.startswith("file:") else root
    d = os.path.join(root, "test-io", uuid.uuid4().hex[:8])
    os.makedirs(d, exist_ok=True)
    return d


def test_unknown_suffix_raises(spark):
    with pytest.raises(ValueError):
        io.load_table(spark, "/nowhere/table.xlsx")


def test_csv_roundtrip_with_schema(spark):
    df = spark.createDataFrame([(1, "a;b", 2.5), (2, None, None)], "id long, s string, x double")
    paths = io.save_table(df, "t", _dir(spark), sep=";")
    back = io.load_table(spark, paths["csv"], fmt="csv", schema="id long, s string, x double", sep=";")
    assert sorted(back.collect()) == sorted(df.collect())
    pq = io.load_table(spark, paths["parquet"])
    assert sorted(pq.collect()) == sorted(df.collect())


def test_lookup_json_shape(spark):
    d = _dir(spark)
    p = os.path.join(d, "cache.json")
    with open(p, "w") as f:
        json.dump({"Nan nan, 1420 Braine-L'Alleud": [None, None], "Kerkstraat 5, Tielt": [51.0, 3.3],
                   "kerkstraat 5,  tielt": [51.5, 3.5]}, f, indent=4)
    raw = io.read_lookup_json(spark, p)
    assert raw.count() == 3 and raw.where("lat is null").count() == 1
    lk = {r["address_key"]: (r["lat"], r["lon"]) for r in lookup_table(raw).collect()}
    # null pair dropped; both spellings normalise to one key, smallest original key wins
    assert lk == {"kerkstraat 5, tielt": (51.0, 3.3)}


def test_csv_types_come_from_all_rows(spark):
    path = os.path.join(_dir(spark), "mixed.csv")
    with open(path, "w") as f:
        f.write("v\n" + "\n".join(["12"] * 1998 + ["abc", "xyz"]))
    df = io.load_table(spark, path)
    assert df.schema["v"].dataType.simpleString() == "string" and df.where("v is null").count() == 0


def test_nan_is_null_after_load(spark):
    path = os.path.join(_dir(spark), "nan.parquet")
    spark.createDataFrame([(1.0,), (float("nan"),)], "x double").write.parquet(path)
    assert io.load_table(spark, path).where("x is null").count() == 1


def _write(spark, *lines):
    path = os.path.join(_dir(spark), "t.csv")
    with open(path, "w") as f:
        f.write("\n".join(lines))
    return path


def test_wrong_header_raises(spark):
    """Columns in another order than the schema are never taken by position."""
    path = _write(spark, "price,id", "5,1")
    with pytest.raises(Exception, match="header|does not conform"):
        io.load_table(spark, path, schema="id int, price int").collect()
    with pytest.raises(ValueError, match="header"):
        io.load_checked(spark, path, "id int, price int")


def test_values_that_do_not_fit_raise_or_are_set_apart(spark):
    path = _write(spark, "id,price,name", "1,5,a", "2,x,b", "3,,c", "4,6", "y,7,d", "5,8,e,f", '6,9,"g,h"')
    with pytest.raises(Exception):
        io.load_table(spark, path, schema="id int, price int, name string").collect()
    rows, rejected = io.load_checked(spark, path, "id int, price int, name string")
    assert sorted(map(tuple, rows.collect())) == [(1, 5, "a"), (3, None, "c"), (6, 9, "g,h")]
    got = {r["record"]: r["reason"] for r in rejected.collect()}
    assert got == {"2,x,b": "price: no int: x", "y,7,d": "id: no int: y", "4,6": "wrong number of fields", "5,8,e,f": "wrong number of fields"}
    assert all(r["file"].endswith("t.csv") for r in rejected.collect())


def test_no_row_is_rejected_from_a_good_table(spark):
    df = spark.createDataFrame([(1, "a;b", 2.5), (2, None, float("nan"))], "id long, s string, x double")
    paths = io.save_table(df, "t", _dir(spark), sep=";")
    rows, rejected = io.load_checked(spark, paths["csv"], "id long, s string, x double", sep=";")
    assert sorted(map(tuple, rows.collect())) == [(1, "a;b", 2.5), (2, None, None)] and rejected.count() == 0
