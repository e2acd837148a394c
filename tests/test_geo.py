import math

from pyspark.sql import functions as F

from veld.functions.geo import mercator_distance
from veld.operators import geo


def test_province_ranges(spark):
    codes = ["999", "1000", "1299", "1300", "1999", "2000", "2999", "3000", "3499", "3500",
             "3999", "4000", "9999", "10000", "abc", " 1000 ", None, "+2000", "1000.5"]
    df = spark.createDataFrame([(c,) for c in codes], "Postal_code string")
    got = [r["Province"] for r in geo.add_province(df).collect()]
    assert got == [None, "Brussels", "Brussels", "Brabant_Walloon", "Brabant_Walloon", "Antwerp",
                   "Antwerp", "Flemish Brabant", "Flemish Brabant", "Limburg", "Limburg", "Liège",
                   "East Flanders", None, None, "Brussels", None, "Antwerp", None]


def _merc(lat1, lon1, lat2, lon2):
    a, e = 6378137.0, 0.0818191908426215

    def y(lat):
        p = math.radians(lat)
        return a * math.log(math.tan(math.pi / 4 + p / 2) * ((1 - e * math.sin(p)) / (1 + e * math.sin(p))) ** (e / 2))
    return math.hypot(a * math.radians(lon1) - a * math.radians(lon2), y(lat1) - y(lat2))


def test_mercator_distance_matches_python(spark):
    df = spark.createDataFrame([(50.85, 4.35, 51.22, 4.40)], "a double, b double, c double, d double")
    got = df.select(mercator_distance("a", "b", "c", "d")).first()[0]
    assert abs(got - _merc(50.85, 4.35, 51.22, 4.40)) < 1e-6


def test_proximity_tie_first_city_and_none(spark):
    rows = [(1, 51.2180, 4.4090), (2, 49.6, 6.1), (3, None, 4.0), (4, 50.85, 4.37)]
    df = spark.createDataFrame(rows, "id long, latitude double, longitude double")
    out = {r["id"]: r for r in geo.assign_cities(df).collect()}
    assert out[1]["Assigned_City_5"] == "Antwerp"           # Sint-Niklaas also within 5 km
    assert out[2]["Assigned_City_15"] is None and out[2]["Has_Assigned_City_15"] == 0
    assert out[3]["Assigned_City_5"] is None and out[3]["Has_Assigned_City_5"] == 0
    assert out[4]["Has_Assigned_City_5"] == 1 and out[4]["Assigned_City_5"] == "Brussels"


def test_cumulative_radii(spark):
    # about 12 km (projected) from Brussels: outside 10 km, inside 5+10=15 km cumulative
    df = spark.createDataFrame([(1, 50.85 + 0.068, 4.3517)], "id long, latitude double, longitude double")
    plain = geo.assign_cities(df, radii=[5, 10]).first()
    cum = geo.assign_cities(df, radii=[5, 10], cumulative=True).first()
    assert plain["Has_Assigned_City_10"] == 0 and cum["Has_Assigned_City_10"] == 1


def test_grid_join_equals_expression(spark):
    rows = [(i, 50.3 + (i % 37) * 0.03, 3.0 + (i % 53) * 0.05) for i in range(400)] + [(999, None, None)]
    df = spark.createDataFrame(rows, "id long, latitude double, longitude double")
    cities = spark.createDataFrame([(n, la, lo, i) for i, (n, la, lo) in enumerate(geo.CITIES)],
                                   "city string, latitude double, longitude double, pos int")
    a = geo.assign_cities(df).select("id", *[f"Assigned_City_{r}" for r in geo.RADII_KM])
    b = geo.assign_cities_grid(df, cities, "id").select("id", *[f"Assigned_City_{r}" for r in geo.RADII_KM])
    assert sorted(a.collect()) == sorted(b.collect())


def test_fallback_lookup(spark):
    raw = spark.createDataFrame(
        [("Nan nan, 1420 Braine-L'Alleud", None, None), ("Kerkstraat 5, Tielt", 51.0, 3.3),
         ("TIELT 8700", 50.9, 3.2), ("Gent", 51.05, 3.72)],
        "address_key string, lat double, lon double")
    lk = geo.lookup_table(raw)
    assert lk.count() == 3                                   # null pair dropped
    rows = [(1, "Kerkstr.", "5", "8700", "Tielt", None, None),     # candidate 2 hits
            (2, "Other", "1", "8700", "Tielt", 50.0, None),        # candidate 3 hits
            (3, "X", "1", "9000", "Nowhere", None, 3.0),           # no hit -> both NULL
            (4, "Y", "2", "9000", "Gent", 51.0, 3.7)]              # complete: untouched
    df = spark.createDataFrame(rows, "id long, street string, number string, Postal_code string, "
                                     "locality_name string, latitude double, longitude double")
    out = geo.fallback_lookup(df, lk)
    got = {r["id"]: (r["latitude"], r["longitude"]) for r in out.collect()}
    assert got == {1: (51.0, 3.3), 2: (50.9, 3.2), 3: (None, None), 4: (51.0, 3.7)}
    rep = geo.lookup_report(out).first()
    assert (rep["missing"], rep["completed"], rep["failed"]) == (3, 2, 1)
    keep = {r["id"]: (r["latitude"], r["longitude"])
            for r in geo.fallback_lookup(df, lk, keep_partial=True).collect()}
    assert keep[3] == (None, 3.0)


def test_fallback_lookup_plan_broadcasts_small_lookup(spark):
    raw = spark.createDataFrame([("Gent", 51.05, 3.72)], "address_key string, lat double, lon double")
    df = spark.createDataFrame([(1, "a", "1", "9000", "Gent", None, None)],
                               "id long, street string, number string, Postal_code string, "
                               "locality_name string, latitude double, longitude double")
    out = geo.fallback_lookup(df, geo.lookup_table(raw))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert out.select(F.col("latitude")).first()[0] == 51.05


def test_city_table_agrees_with_long_list(spark):
    rows = [(i, 50.3 + (i % 37) * 0.03, 3.0 + (i % 53) * 0.05) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, latitude double, longitude double")
    many = [(f"c{i}", 50.0 + (i % 30) * 0.05, 2.5 + (i // 30) * 0.1) for i in range(300)]
    table = spark.createDataFrame([(*c, i) for i, c in enumerate(many)], "city string, latitude double, longitude double, pos int")
    grid = geo.assign_cities_grid(df, table, "id")
    expr = geo.assign_cities(df, cities=many)
    cols = ["id"] + [f"Assigned_City_{r}" for r in geo.RADII_KM]
    assert sorted(grid.select(*cols).collect()) == sorted(expr.select(*cols).collect())


def test_fallback_lookup_hot_addresses_against_plain_python(spark):
    """Many rows of one address list and of none at all: each list is asked once, rows come back whole."""
    places = ["Gent", "Tielt", None]
    rows = [(i, [None, "Kerkstr.", "Main"][i % 3], str(i % 2) if i % 5 else None, "8700" if i % 7 else None, places[i % 11 % 3],
             None if i % 4 else 50.0, 3.0 if i % 3 else None) for i in range(600)]
    rows += rows[:50] + [(1000 + i, None, None, None, None, None, None) for i in range(300)]
    raw = [("Kerkstraat 1, 8700 Tielt", 1.0, 1.5), ("Main 0, Gent", 2.0, 2.5), ("Tielt 8700", 3.0, 3.5), ("gent", 4.0, None),
           ("Gent", 4.0, 4.5), ("nan nan, nan nan", 9.0, 9.5)]
    schema = "id long, street string, number string, Postal_code string, locality_name string, latitude double, longitude double"
    df = spark.createDataFrame(rows, schema)
    lk = geo.lookup_table(spark.createDataFrame(raw, "address_key string, lat double, lon double"))
    table = {r[0]: (r[1], r[2]) for r in lk.collect()}
    forms = {tuple(r[:7]): r[7] for r in df.select("*", F.transform(
        geo.address_candidates(), lambda c: geo.normalize_address(c, False))).collect()}

    def expected(row):
        if row[5] is not None and row[6] is not None:
            return row
        return row[:5] + next((table[k] for k in forms[row] if k in table), (None, None))

    out = geo.fallback_lookup(df, lk)
    order = lambda r: tuple((x is None, x) for x in r)
    got = sorted((tuple(r) for r in out.drop("_missing", "_found").collect()), key=order)
    assert got == sorted(map(expected, rows), key=order)
    assert out.columns == [*df.columns, "_missing", "_found"]
    empty = geo.fallback_lookup(df.limit(0), lk)
    assert empty.count() == 0 and geo.fallback_lookup(df, lk.limit(0)).filter("_found").count() == 0
