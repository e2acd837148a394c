"""Geographic enrichment: province, fallback coordinate lookup, city proximity.

J1 (fallback lookup), J2 (proximity flags), X6 (province), with the address helpers of
``veld.functions.text`` and the projected distance of ``veld.functions.geo``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veld.functions.geo import distance, mercator_x, mercator_y
from veld.functions.numeric import range_bucket
from veld.functions.text import address_candidates, normalize_address

# The ten reference cities in list order (name, latitude, longitude).
CITIES = [
    ("Brussels", 50.8503, 4.3517),
    ("Antwerp", 51.2194, 4.4025),
    ("Ghent", 51.0543, 3.7174),
    ("Bruges", 51.2093, 3.2247),
    ("Liège", 50.6293, 5.3345),
    ("Namur", 50.4811, 4.8708),
    ("Leuven", 50.8794, 4.7004),
    ("Mons", 50.4542, 3.9460),
    ("Aalst", 50.9402, 4.0710),
    ("Sint-Niklaas", 51.2170, 4.4155),
]
RADII_KM = [5, 10, 15]


def add_province(df: DataFrame, postcode: str = "Postal_code", out: str = "Province") -> DataFrame:
    """Province from the postcode by half-open ranges; unparsable -> NULL."""
    return df.withColumn(out, range_bucket(postcode))


# ---------------------------------------------------------------- lookup table

def lookup_table(raw: DataFrame, key: str = "address_key", lat: str = "lat",
                 lon: str = "lon", literal: bool = False) -> DataFrame:
    """Normalised ``(address_key, lat, lon)``: keys normalised like queries, null pairs
    dropped, and one entry per normalised key (smallest original key, then
    coordinates, wins)."""
    clean = (raw.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
             .select(normalize_address(key, literal).alias("address_key"),
                     F.col(key).alias("_orig"), F.col(lat).cast("double").alias("lat"),
                     F.col(lon).cast("double").alias("lon")))
    return (clean.groupBy("address_key")
            .agg(F.min_by(F.struct("lat", "lon"), F.struct("_orig", "lat", "lon")).alias("_p"))
            .select("address_key", "_p.lat", "_p.lon"))


def fallback_lookup(df: DataFrame, lookup: DataFrame, lat: str = "latitude",
                    lon: str = "longitude", street="street", number="number",
                    postcode="Postal_code", locality="locality_name",
                    keep_partial: bool = False, literal: bool = False) -> DataFrame:
    """Fill coordinates of rows missing latitude or longitude.

    The four address strings are tried in order; the first whose normalised form is in
    ``lookup`` wins and *both* coordinates are overwritten (NULL when nothing matches,
    unless ``keep_partial``).  Rows with both coordinates pass through untouched.

    One ranked join: the distinct address lists of the missing rows (a list that many rows
    share, as of rows without any address, counts once, by a partial aggregate) become narrow
    rows (list, place in the list, key), are joined with the lookup, and the hit of the
    smallest place goes back to the rows of its list.  The full rows are in that last join only.
    """
    missing = F.col(lat).isNull() | F.col(lon).isNull()
    keys = F.transform(address_candidates(street, number, postcode, locality), lambda c: normalize_address(c, literal))
    todo = df.where(missing).withColumn("_keys", F.to_json(keys))
    done = df.where(~missing)
    asked = (df.where(missing).select(keys.alias("k")).distinct()
             .select(F.to_json("k").alias("_keys"), F.posexplode("k").alias("_place", "address_key")))
    hits = (asked.join(lookup.select("address_key", F.struct("lat", "lon").alias("_at")), "address_key")
            .groupBy("_keys").agg(F.min_by("_at", "_place").alias("_hit")))
    hit = F.col("_hit")
    new_lat = hit["lat"] if not keep_partial else F.coalesce(hit["lat"], F.col(lat))
    new_lon = hit["lon"] if not keep_partial else F.coalesce(hit["lon"], F.col(lon))
    filled = (todo.join(hits, "_keys", "left")
              .withColumns({"_missing": F.lit(True), "_found": hit.isNotNull(), lat: new_lat, lon: new_lon})
              .drop("_hit", "_keys"))
    done = done.withColumns({"_missing": F.lit(False), "_found": F.lit(False)})
    return filled.unionByName(done)


def lookup_report(filled: DataFrame) -> DataFrame:
    """``(missing, completed, failed)`` of a ``fallback_lookup`` result, one aggregation."""
    return filled.agg(F.count_if("_missing").alias("missing"),
                      F.count_if("_found").alias("completed"),
                      F.count_if(F.col("_missing") & ~F.col("_found")).alias("failed"))


# ---------------------------------------------------------------- proximity

def _effective_radii(radii: Sequence[float], cumulative: bool) -> list[float]:
    if not cumulative:
        return [float(r) for r in radii]
    acc, out = 0.0, []
    for r in radii:
        acc += r
        out.append(acc)
    return out


def proximity_columns(lat: str = "latitude", lon: str = "longitude",
                      cities: Sequence[tuple[str, float, float]] = CITIES,
                      radii: Sequence[float] = RADII_KM, metric: str = "mercator",
                      cumulative: bool = False) -> dict[str, Column]:
    """``Assigned_City_<r>`` (first city in list order within r km) and
    ``Has_Assigned_City_<r>`` (0/1) as plain expressions (J2).

    With a short city list every distance is one expression on the row: no join and no
    shuffle, inside whole-stage codegen.  NULL coordinates give NULL and 0.
    ``cumulative=True`` reproduces buffers re-buffered radius after radius.
    """
    d = [distance(lat, lon, F.lit(la), F.lit(lo), metric) for _, la, lo in cities]
    out = {}
    for r, eff in zip(radii, _effective_radii(radii, cumulative)):
        limit = F.lit(eff * 1000.0)
        city = None
        for (name, _, _), di in zip(cities, d):
            cond = di <= limit
            city = F.when(cond, F.lit(name)) if city is None else city.when(cond, F.lit(name))
        out[f"Assigned_City_{r}"] = city
        out[f"Has_Assigned_City_{r}"] = F.when(city.isNotNull(), 1).otherwise(0)
    return out


def assign_cities(df: DataFrame, lat: str = "latitude", lon: str = "longitude",
                  cities: Sequence[tuple[str, float, float]] = CITIES,
                  radii: Sequence[float] = RADII_KM, metric: str = "mercator",
                  cumulative: bool = False) -> DataFrame:
    """City columns per row for a city list of the program, as expressions; a table of cities
    goes to ``assign_cities_grid``."""
    return df.withColumns(proximity_columns(lat, lon, cities, radii, metric, cumulative))


def assign_cities_grid(df: DataFrame, cities: DataFrame, key: str, lat: str = "latitude",
                       lon: str = "longitude", radii: Sequence[float] = RADII_KM,
                       cumulative: bool = False) -> DataFrame:
    """The same assignment for a table of cities (``city, latitude, longitude, pos``).

    Spatial equi-join on a Mercator grid of cell size = radius: each city is copied into
    its 3x3 neighbouring cells, each row looks up its own cell (no cross join), the
    distance filter keeps true hits and ``min_by(city, pos)`` per row key picks the first
    city in list order.  One such join per radius.
    """
    out = df
    for r, eff in zip(radii, _effective_radii(radii, cumulative)):
        cell = eff * 1000.0
        cx = F.floor(mercator_x(F.col("c_lon")) / cell)
        cy = F.floor(mercator_y(F.col("c_lat")) / cell)
        offs = F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy"))
                         for i in (-1, 0, 1) for j in (-1, 0, 1)])
        cgrid = (cities.select(F.col("city").alias("c_city"), F.col("latitude").alias("c_lat"),
                               F.col("longitude").alias("c_lon"), F.col("pos").alias("c_pos"))
                 .withColumn("_o", F.explode(offs))
                 .withColumn("_gx", cx + F.col("_o.dx")).withColumn("_gy", cy + F.col("_o.dy"))
                 .drop("_o"))
        pts = (df.select(F.col(key).alias("_key"), F.col(lat).alias("_lat"), F.col(lon).alias("_lon"))
               .where(F.col("_lat").isNotNull() & F.col("_lon").isNotNull())
               .withColumn("_gx", F.floor(mercator_x(F.col("_lon")) / cell))
               .withColumn("_gy", F.floor(mercator_y(F.col("_lat")) / cell)))
        hits = (pts.join(cgrid, ["_gx", "_gy"])
                .where(distance("_lat", "_lon", "c_lat", "c_lon") <= F.lit(cell))
                .groupBy("_key").agg(F.min_by("c_city", "c_pos").alias(f"Assigned_City_{r}")))
        out = (out.join(hits.withColumnRenamed("_key", key), key, "left")
               .withColumn(f"Has_Assigned_City_{r}",
                           F.when(F.col(f"Assigned_City_{r}").isNotNull(), 1).otherwise(0)))
    return out
