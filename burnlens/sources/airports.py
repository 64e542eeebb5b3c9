"""Location ("airport") dimension and lookups.

The dimension is a small table ``iata, lat, lon, city, country``. With the
driver data it is derived from ``nation`` (one location per nation key; the
last nation key has no coordinates, so that unknown-location paths are
exercised). Lookups upper-case the key (M30).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import haversine_km, route_part, route_parts
from ..operators.sizing import file_broadcast

# Fixed values of the location rule for the driver tables: nation k gets
# lat = -60 + 5k, lon = -170 + 13.7k; nation keys >= 24 have no coordinates.
LAT0, LAT_STEP = -60.0, 5.0
LON0, LON_STEP = -170.0, 13.7
KNOWN_NATIONS = 24


def airports_from_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    k = F.col("n_nationkey")
    known = k < KNOWN_NATIONS
    return (
        nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
        .select(
            F.upper(F.col("n_name")).alias("iata"),
            F.when(known, F.lit(LAT0) + F.lit(LAT_STEP) * k).alias("lat"),
            F.when(known, F.lit(LON0) + F.lit(LON_STEP) * k).alias("lon"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
        )
    )


def airports_from_csv(spark: SparkSession, path: str) -> DataFrame:
    schema = "iata string, lat double, lon double, city string, country string"
    return spark.read.schema(schema).option("header", True).csv(path).withColumn("iata", F.upper("iata"))


def with_location(df: DataFrame, airports: DataFrame, code_col: str, prefix: str) -> DataFrame:
    """Left lookup of ``code_col`` -> ``{prefix}Lat/Lon/City/Country``.

    Unknown codes give NULL coordinates, city falls back to the code and
    country to the empty string.
    """
    a = file_broadcast(airports).select(
        F.col("iata").alias(f"_{prefix}_iata"),
        F.col("lat").alias(f"{prefix}Lat"),
        F.col("lon").alias(f"{prefix}Lon"),
        F.col("city").alias(f"_{prefix}_city"),
        F.col("country").alias(f"_{prefix}_country"),
    )
    out = df.join(a, F.upper(df[code_col]) == a[f"_{prefix}_iata"], "left")
    return (
        out.withColumn(f"{prefix}City", F.coalesce(F.col(f"_{prefix}_city"), F.col(code_col)))
        .withColumn(f"{prefix}Country", F.coalesce(F.col(f"_{prefix}_country"), F.lit("")))
        .drop(f"_{prefix}_iata", f"_{prefix}_city", f"_{prefix}_country")
    )


def route_distance(df: DataFrame, airports: DataFrame, route_col: str = "ScheduledRoute") -> DataFrame:
    """Adds ``_hav_km``: great-circle distance when the route has exactly two
    parts and both are known locations, else NULL (M7 without fallback)."""
    a = file_broadcast(airports)
    o = a.select(F.col("iata").alias("_o_iata"), F.col("lat").alias("_o_lat"), F.col("lon").alias("_o_lon"))
    d = a.select(F.col("iata").alias("_d_iata"), F.col("lat").alias("_d_lat"), F.col("lon").alias("_d_lon"))
    two = route_parts(route_col) == 2
    out = (
        df.join(o, F.when(two, F.upper(route_part(route_col, 0))) == o._o_iata, "left")
        .join(d, F.when(two, F.upper(route_part(route_col, 1))) == d._d_iata, "left")
    )
    return out.withColumn("_hav_km", haversine_km("_o_lat", "_o_lon", "_d_lat", "_d_lon")).drop(
        "_o_iata", "_o_lat", "_o_lon", "_d_iata", "_d_lat", "_d_lon"
    )
