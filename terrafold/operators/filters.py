"""The label query and its predicates, each with its own rule for nulls."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.functions import geo
from terrafold.functions.scalars import at_least, at_most, contains_any
from terrafold.operators.dedup import latest


def date_range(date: str, low: str | None, high: str | None) -> Column:
    """The lower bound keeps undated rows, the upper bound drops them."""
    ts = F.try_to_timestamp(F.col(date).cast("string"))
    keep = F.lit(True)
    if low:
        keep = keep & at_least(ts, F.lit(low).cast("timestamp"), keep_null=True)
    if high:
        keep = keep & at_most(ts, F.lit(high).cast("timestamp"), keep_null=False)
    return keep


@dataclass(frozen=True)
class LabelFilter:
    """What `select_labels` keeps; None switches a rule off."""

    species: tuple[str, ...] | None = None
    sources: tuple[str, ...] | None = None
    min_uncertainty: float | None = None
    max_uncertainty: float | None = 500.0
    date_min: str | None = "2018-01-01"
    date_max: str | None = None
    geom_types: tuple[str, ...] | None = None
    min_weight: float | None = None
    min_cover: float | None = None
    bbox: tuple[float, float, float, float] | None = None

    def scan(self) -> Column:
        """What the scan takes: goes to the files before duplicates are resolved."""
        keep = F.lit(True)
        if self.sources:
            keep = keep & F.col("source").isin(*self.sources)
        if self.bbox:
            x0, y0, x1, y1 = self.bbox
            keep = keep & F.col("lon").between(x0, x1) & F.col("lat").between(y0, y1)
        return keep

    def mask(self) -> Column:
        keep = date_range("event_date", self.date_min, self.date_max)
        if self.geom_types:
            keep = keep & F.coalesce(F.col("geom_type").isin(*self.geom_types), F.lit(False))
        if self.min_weight is not None:
            keep = keep & at_least("weight", self.min_weight, keep_null=False)
        if self.min_cover is not None:
            keep = keep & at_least("cover_pct", self.min_cover, keep_null=False)
        if self.max_uncertainty is not None:
            keep = keep & at_most("coord_uncertainty_m", self.max_uncertainty, keep_null=True)
        if self.min_uncertainty is not None:
            keep = keep & at_least("coord_uncertainty_m", self.min_uncertainty, keep_null=True)
        if self.species:
            keep = keep & contains_any("species_normalized", list(self.species))
        return keep


def select_labels(store: DataFrame, rule: LabelFilter, aoi: DataFrame | None = None, ties: tuple[str, ...] = ("ingest_run_id", "source_record_id")) -> DataFrame:
    """Scan filters, latest row of each observation, the other filters, then the clip to the AOI."""
    rows = latest(store.where(rule.scan()), ties=ties).where(rule.mask())
    return rows if aoi is None else clip(rows, aoi, boundary=True)


def clip(points: DataFrame, parts: DataFrame, boundary: bool, band: float = 0.05) -> DataFrame:
    """Points in any part of an area (`ring`: array of x, y; nulls between the rings of a part).

    The edges are cut in bands of latitude and a point joins the edges of its own band, which are all that a ray along
    its latitude can cross. So an outline may be as detailed as it likes: nothing of it comes to the driver or into the plan."""
    low, high = F.least("_e.a.y", "_e.b.y"), F.greatest("_e.a.y", "_e.b.y")
    numbered = parts.select("ring", F.monotonically_increasing_id().alias("_part"))  # before the rings are taken apart
    cut = numbered.select("_part", F.explode(geo.edges("ring")).alias("_e"))
    cut = cut.withColumn("_band", F.explode(F.sequence(F.floor(low / band), F.floor(high / band))))
    bands = cut.groupBy("_band", "_part").agg(F.collect_list("_e").alias("_e")).groupBy("_band").agg(F.collect_list("_e").alias("_parts"))
    met = points.withColumn("_band", F.floor(F.col("lat") / band)).join(bands, "_band")
    return met.where(F.exists("_parts", lambda p: geo.in_edges("lon", "lat", p, boundary))).select(*points.columns)


def species_in(df: DataFrame, names: list[str], column: str = "species") -> DataFrame:
    return df.where(F.lower(column).isin(*[n.lower() for n in names]))


def unmatched(df: DataFrame, names: list[str], column: str = "species") -> DataFrame:
    """Which of the names no row has, case aside."""
    asked = df.sparkSession.createDataFrame([(n,) for n in names], "name string")
    have = df.select(F.lower(column).alias("_have")).distinct()
    return asked.join(have, F.lower("name") == F.col("_have"), "left_anti")


def at_least_rows(df: DataFrame, key: str, least: int) -> DataFrame:
    """Rows whose key occurs often enough; 0 keeps all. Counts are aggregated first, then joined back."""
    if least <= 0:
        return df
    often = df.groupBy(key).count().where(F.col("count") >= least).select(key)
    return df.join(often, key, "left_semi")
