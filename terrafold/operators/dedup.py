"""One row a key: latest, first and last rules, and spatial thinning. Every rule has a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrafold.functions import geo


def one_per(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """The first row of each key in an order; nulls in keys are equal. Spark limits rows before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def latest(df: DataFrame, key: str = "obs_id", version: str = "ingested_at", ties: tuple[str, ...] = ()) -> DataFrame:
    return one_per(df, [key], [F.col(version).desc_nulls_last(), *[F.col(t).desc_nulls_last() for t in ties]])


def thin(df: DataFrame, metres: float, group: str, zone: int = 34, key: str = "obs_id", lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Of each group and square cell of a UTM zone the smallest key as a string stays."""
    cells = geo.apply(df, geo.utm(lon, lat, zone, x="tx_", y="ty_"))
    cells = cells.withColumn("cx_", F.floor(F.col("tx_") / metres)).withColumn("cy_", F.floor(F.col("ty_") / metres)).drop("tx_", "ty_")
    return one_per(cells, [group, "cx_", "cy_"], [F.col(key).cast("string")]).drop("cx_", "cy_")


def across_years(df: DataFrame, keys: list[str], year: str = "year", digits: int = 5, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Points of one place (rounded half-even) and key: the latest year stays."""
    return one_per(df, [F.bround(lon, digits), F.bround(lat, digits), *keys], [F.col(year).desc(), F.col("obs_id")])


def keep_last(df: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    return one_per(df, keys, [F.col(sequence).desc_nulls_last()])
