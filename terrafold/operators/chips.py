"""Chips: windows of pixels around points, composed over scenes; one plan for all points, months and bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.operators.raster import BAD_SCL, chip_status, clearest_scenes, pixel_window

CELL = 64


def scenes_for(windows: DataFrame, catalog: DataFrame, cloud_max: float, most: int | None = 20) -> DataFrame:
    """(group, month_label, scene): scenes that overlap a window in time and space and are clear enough, the
    clearest of each window. windows: group, month_label, win_start, win_end, box; catalog: scene, day, cloud, box."""
    overlap = (
        F.col("day").between(F.col("win_start"), F.col("win_end"))
        & (F.coalesce(F.col("cloud"), F.lit(100.0)) < cloud_max)
        & (F.col("s_minx") <= F.col("maxx"))
        & (F.col("s_maxx") >= F.col("minx"))
        & (F.col("s_miny") <= F.col("maxy"))
        & (F.col("s_maxy") >= F.col("miny"))
    )
    # equal keys, the calendar month and square cells of a degree, keep this a hash join of near things; a window spans
    # at most three months and a scene a few cells
    months = F.sequence(F.trunc("win_start", "month"), F.trunc("win_end", "month"), F.expr("interval 1 month"))
    keyed = _cells(windows.withColumn("_month", F.explode(months)), "minx", "maxx", "miny", "maxy")
    met = keyed.join(_cells(catalog.withColumn("_month", F.trunc("day", "month")), "s_minx", "s_maxx", "s_miny", "s_maxy"), ["_month", "_cx", "_cy"]).where(overlap)
    found = met.select("group", "month_label", "scene", "cloud").distinct()
    return found if most is None else clearest_scenes(found, ["group", "month_label"], most)


def _cells(df: DataFrame, x0: str, x1: str, y0: str, y1: str) -> DataFrame:
    """A row for each square cell of a degree that a box touches."""
    df = df.withColumn("_cx", F.explode(F.sequence(F.floor(x0), F.floor(x1))))
    return df.withColumn("_cy", F.explode(F.sequence(F.floor(y0), F.floor(y1))))


def extract(
    points: DataFrame, pixels: DataFrame, x0: float, y0: float, dx: float, dy: float, width: int, height: int, size: int = 64, least: float = 0.5, by: tuple[str, ...] = ("month_label",)
) -> DataFrame:
    """A row a point and month: status, valid_frac and, if ok, chip (medians in order of band, row, column).

    points: obs_id, month_label, x, y in metres and the columns `by`, one row for each of their values that the window
    takes (a null takes none). pixels: `by`, scene, band, col, row, value, scl. Points on one pixel with the same values of
    `by` share a window, which is made once. Pixels are dealt by cells of 64 pixels, each to the sets of values that
    windows on its cell take; a pixel's median is made once a set, and a cell's medians travel as one row to each window on it."""
    window = pixel_window(F.col("x"), F.col("y"), x0, y0, dx, dy, width, height, size)
    named = F.when(F.forall(F.array(*[F.col(b).isNotNull() for b in by]), lambda known: known), F.struct(*by))
    placed = points.withColumns(window).groupBy("obs_id", "month_label", "oob", "col0", "row0").agg(F.array_sort(F.collect_set(named)).alias("_by"))
    placed = placed.withColumns({"_set": F.xxhash64("_by"), "_set2": F.xxhash64(F.lit(1), "_by")})  # 128 bits of the values
    key = ["_set", "_set2", "col0", "row0"]
    windows = placed.where("not oob and size(_by) > 0").dropDuplicates(key).select(*key, "_by")
    for axis, cell in (("col0", "_cx"), ("row0", "_cy")):
        windows = windows.withColumn(cell, F.explode(F.sequence(F.floor(F.col(axis) / CELL), F.floor((F.col(axis) + size - 1) / CELL))))
    takes = windows.select("_cx", "_cy", "_set", "_set2", F.explode("_by").alias("_v")).distinct()
    takes = takes.groupBy("_cx", "_cy", "_v").agg(F.collect_list(F.struct("_set", "_set2")).alias("_sets"))
    takes = takes.groupBy("_cx", "_cy").agg(F.map_from_entries(F.collect_list(F.struct("_v", "_sets"))).alias("_takes"))
    clear = F.when(~F.coalesce(F.col("scl").isin(*BAD_SCL), F.lit(False)) & ~F.isnan("value"), F.col("value"))
    keyed = pixels.select(*by, "band", "col", "row", clear.alias("_v"), F.floor(F.col("col") / CELL).alias("_cx"), F.floor(F.col("row") / CELL).alias("_cy"))
    taken = keyed.join(takes, ["_cx", "_cy"]).select("_cx", "_cy", "band", "col", "row", "_v", F.explode(F.element_at("_takes", F.struct(*by))).alias("_s"))
    cell = ["_cx", "_cy", "_set", "_set2"]
    median = taken.select("*", "_s.*").groupBy(*cell, "band", "col", "row").agg(F.median("_v").cast("float").alias("v"))
    medians = median.groupBy(*cell).agg(F.collect_list(F.struct("band", F.col("row").alias("r"), F.col("col").alias("c"), "v")).alias("_px"))
    inside = F.filter("_px", lambda p: p["c"].between(F.col("col0"), F.col("col0") + size - 1) & p["r"].between(F.col("row0"), F.col("row0") + size - 1))
    met = windows.drop("_by").join(medians, cell).select(*key, inside.alias("_px"))
    chips = met.groupBy(*key).agg(F.array_sort(F.flatten(F.collect_list("_px"))).alias("_px")).where("size(_px) > 0")

    def places(px: Column) -> Column:
        return F.size(F.array_distinct(F.transform(px, lambda p: (p["r"] - F.col("row0")) * size + p["c"] - F.col("col0"))))

    valid = (places(F.col("_px")) - places(F.filter("_px", lambda p: p["v"].isNull()))) / F.lit(float(size * size))
    chips = chips.select(*key, valid.alias("valid_frac"), F.transform("_px", lambda p: F.coalesce(p["v"], F.lit(float("nan")).cast("float"))).alias("chip"))
    out = placed.drop("_by").join(chips, key, "left")
    status = chip_status(F.col("valid_frac"), F.col("oob"), least)
    return out.select("obs_id", "month_label", status.alias("status"), "valid_frac", F.when(status == "ok", F.col("chip")).alias("chip"))


def drop_counts(chips: DataFrame) -> DataFrame:
    return chips.groupBy("month_label", "status").agg(F.count(F.lit(1)).alias("n"))
