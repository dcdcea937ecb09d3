"""A run of chip extraction: what is missing, its scenes, chips and manifest rows, one retry a year earlier, and what goes.

Chips are rows of Parquet under <prefix>/chips/run=<id>, and a manifest row names its chip by `chip_uri`, which begins
with the run. A run writes chips first, then its manifest shard, then merges the shards, so that a stop at any point
leaves either rows without a name, which no reader sees, or a shard that the next run merges."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.functions import geo
from terrafold.operators import chips, manifest
from terrafold.schema import MANIFEST
from terrafold.sources import sinks
from terrafold.sources.tiff import scene_pixels

#: The pixel grid of a UTM zone: 10 m, from the false origin of the south downwards.
X0, Y0, PIXEL, WIDTH, HEIGHT = 0.0, 1e7, 10.0, 100_000, 1_000_000
#: The asset of a scene that holds its pixels' classes.
MASK = "SCL"


@dataclass(frozen=True)
class Campaign:
    """Where chips go and how they are made. months: of each zone, a list of start, end (dates) and label."""

    prefix: str
    months: dict[str, list[dict[str, Any]]]
    size: int = 64
    least_valid: float = 0.5
    cloud_max: float = 95.0
    most_scenes: int | None = 20
    bands: tuple[str, ...] = field(default=())


def months_of(zone: Column, months: dict[str, list[dict[str, Any]]]) -> Column:
    """The month templates of a zone, as `manifest.windows` takes them; null for a zone that has none."""
    choice = F.lit(None)
    for name, listed in months.items():
        part = F.array(*[F.struct(F.lit(str(m["start"])[5:]).alias("start"), F.lit(str(m["end"])[5:]).alias("stop"), F.lit(m["label"]).alias("label")) for m in listed])
        choice = F.when(zone == name, part).otherwise(choice)
    return choice


def grouped(labels: DataFrame, margin: float = 320.0) -> DataFrame:
    """Adds grp, epsg and the box (degrees, with a margin in metres) of each block, year and zone; a group is extracted
    in the UTM zone of its middle."""
    keys = ["block_id", "year", "zone"]
    box = labels.groupBy(*keys).agg(F.avg("lon").alias("_lon"), F.avg("lat").alias("_lat"), *[f(c).alias(n) for n, f, c in (("minx", F.min, "lon"), ("maxx", F.max, "lon"), ("miny", F.min, "lat"), ("maxy", F.max, "lat"))])
    up = F.lit(margin / 110_574.0)
    across = F.lit(margin / 111_320.0) / F.cos(F.radians("_lat"))
    box = box.withColumns({"minx": F.col("minx") - across, "maxx": F.col("maxx") + across, "miny": F.col("miny") - up, "maxy": F.col("maxy") + up})
    box = box.withColumns({"grp": F.concat_ws("/", *keys), "epsg": F.expr(geo.utm_epsg("_lon", "_lat"))})
    return labels.join(box.drop("_lon", "_lat"), keys)


def extract(wanted: DataFrame, catalog: DataFrame, pixels: DataFrame, c: Campaign) -> DataFrame:
    """status, valid_frac and chip of each row of `wanted` (obs_id, month_label, win_start, win_end, lon, lat, grp, epsg, box).

    catalog: scene, day, cloud, s_minx, s_maxx, s_miny, s_maxy (degrees). pixels: scene, epsg, band, x, y (centres in
    metres), value, scl, or assets of scenes (scene, epsg, band, path; `tiff.scene_pixels`), of which the tiles on
    windows are read; a scene's pixels in another zone than the group's don't count. A window meets the pixels of its
    group's scenes by scene, zone and cell of 64 pixels, so pixels are moved once and multiplied by the windows on them only."""
    searched = wanted.select("grp", "month_label", "win_start", "win_end", "minx", "maxx", "miny", "maxy").distinct().withColumnRenamed("grp", "group")
    scenes = chips.scenes_for(searched, catalog, c.cloud_max, c.most_scenes).select(F.col("group").alias("grp"), "month_label", "scene")
    placed = geo.apply(wanted.withColumn("_zone", F.col("epsg") % 100), geo.utm("lon", "lat", "_zone", x="x", y="y"))
    points = placed.join(scenes, ["grp", "month_label"], "left").select("obs_id", "month_label", "x", "y", "epsg", "scene")
    if "path" in pixels.columns:
        half = (c.size // 2 + 1) * PIXEL
        edges = [(F.col(axis) + sign * half).alias(f"{axis}{k}") for axis in ("x", "y") for k, sign in enumerate((-1, 1))]
        assets = pixels.where(F.col("band").isin(*c.bands, MASK)) if c.bands else pixels
        pixels = scene_pixels(assets, points.where("scene is not null").select("scene", "epsg", *edges), PIXEL, MASK)
    chosen = pixels.where(F.col("band").isin(*c.bands)) if c.bands else pixels
    on_grid = chosen.select("scene", "epsg", "band", F.floor((F.col("x") - X0) / PIXEL).alias("col"), F.floor((Y0 - F.col("y")) / PIXEL).alias("row"), "value", "scl")
    return chips.extract(points, on_grid, X0, Y0, PIXEL, -PIXEL, WIDTH, HEIGHT, c.size, c.least_valid, by=("scene", "epsg"))


def _write(wanted: DataFrame, catalog: DataFrame, pixels: DataFrame, c: Campaign) -> None:
    run = uuid.uuid4().hex
    made = extract(wanted, catalog, pixels, c).where("status = 'ok'")
    told = wanted.select("obs_id", "month_label", F.col("species_normalized").alias("species"), "year", "block_id", "lon", "lat")
    uri = F.concat_ws("/", F.lit(f"run={run}"), "obs_id", "year", "month_label").alias("chip_uri")
    at = f"{c.prefix}/chips/run={run}"
    sinks.write_parquet(made.join(told, ["obs_id", "month_label"]).select(uri, *[n for n in MANIFEST.names if n != "chip_uri"], "chip"), at)
    rows = wanted.sparkSession.read.parquet(at).select(*[F.col(f.name).cast(f.dataType) for f in MANIFEST])
    if rows.isEmpty():
        sinks.remove(wanted.sparkSession, at)
    else:
        sinks.append_shard(rows, c.prefix)


def run(labels: DataFrame, catalog: DataFrame, pixels: DataFrame, c: Campaign, fallback: bool = True, prune: bool = True) -> DataFrame:
    """Extracts what the manifest lacks and gives the manifest. labels: obs_id (one row each), species_normalized, lon, lat, year, zone, block_id.

    An observation that has chips keeps their commonest year. One that gets none is tried once more a year earlier.
    `prune` takes chips of observations that are gone and of months that an observation's zone doesn't have (leave it
    off where the labels are a part of what is kept)."""
    spark = labels.sparkSession
    had = sinks.consolidate_shards(spark, c.prefix)
    before = runs_of(had)
    fixed = labels.join(manifest.modal_year(had), "obs_id", "left").withColumn("year", F.coalesce("modal_year", "year").cast("int")).drop("modal_year")
    at = f"{c.prefix}/labels"
    sinks.write_parquet(fixed, at)  # the passes and the pruning see the same labels, whatever happens to the store meanwhile
    fixed = spark.read.parquet(at)

    def lacking(rows: DataFrame, have: DataFrame) -> DataFrame:
        """Windows of the observations that have months to come, grouped as one search."""
        days = manifest.windows(rows.withColumn("months", months_of(F.col("zone"), c.months)))
        return grouped_windows(days.join(have.select("obs_id", "month_label").distinct(), ["obs_id", "month_label"], "left_anti"))

    first = lacking(fixed, had)
    if not first.isEmpty():
        _write(first, catalog, pixels, c)
    now = sinks.consolidate_shards(spark, c.prefix)
    if fallback:
        failed = fixed.join(now.select("obs_id").distinct(), "obs_id", "left_anti")  # without any chip, so tried just now
        again = lacking(manifest.year_fallback(fixed, failed), now)
        if not again.isEmpty():
            _write(again, catalog, pixels, c)
            now = sinks.consolidate_shards(spark, c.prefix)
    if prune:
        expected = manifest.windows(fixed.withColumn("months", months_of(F.col("zone"), c.months))).select("obs_id", "month_label")
        kept = manifest.reconcile(now, fixed, expected).where("not stale")
        before |= runs_of(now)
        now = sinks.replace_manifest(kept, c.prefix)
        sweep(spark, c.prefix, now, before)
    return now


def grouped_windows(days: DataFrame) -> DataFrame:
    """Windows with the group of their observations; an observation counts once in a group's middle."""
    labels = days.select("obs_id", "lon", "lat", "block_id", "year", "zone").distinct()
    return days.join(grouped(labels).drop("lon", "lat", "block_id", "year", "zone"), "obs_id")


def read_chips(spark: SparkSession, prefix: str) -> DataFrame:
    """Chips that the manifest names."""
    table = spark.read.option("recursiveFileLookup", "true").parquet(f"{prefix}/chips")
    return table.join(sinks.read_manifest(spark, prefix).select("chip_uri"), "chip_uri", "left_semi")


def runs_of(rows: DataFrame) -> set[str]:
    """The runs that manifest rows name; one a run."""
    return {r[0] for r in rows.select(F.substring_index("chip_uri", "/", 1)).distinct().toLocalIterator()}


def sweep(spark: SparkSession, prefix: str, rows: DataFrame, before: set[str], hours: float = 48.0) -> list[str]:
    """Removes the chips of runs of which the manifest names none any more; a run's chips go together, when its last one does.

    Only runs that the manifest named `before`, and those of no name that are older than `hours`, go: another run may have
    written chips of which it is yet to write the shard."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{prefix}/chips")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    named, limit = runs_of(rows), (time.time() - hours * 3600) * 1000
    gone = [s.getPath() for s in fs.listStatus(at) if (name := s.getPath().getName()) not in named and (name in before or s.getModificationTime() < limit)]
    for path in gone:
        fs.delete(path, True)
    return sorted(p.getName() for p in gone)
