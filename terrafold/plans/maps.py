"""Queries over what is read, written and mapped: the store, the manifest's shards, scenes, chips, embeddings, maps and the warp.

What a query writes goes to a new folder under the checkpoint folder, as its result reads it."""

from __future__ import annotations

import re
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.functions import geo
from terrafold.operators import chips, dedup, inference, raster
from terrafold.plans.bindings import view
from terrafold.plans.registry import query, r6
from terrafold.schema import MANIFEST
from terrafold.sources import sinks
from terrafold.sources.store import Store


def scratch(spark: SparkSession) -> str:
    """A new folder in the one that the cluster shares; on one machine, where none is named, in the session's warehouse."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(named or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/maps-{uuid.uuid4().hex}"


def table(spark: SparkSession, d: str, sql: str) -> DataFrame:
    """SQL that both sides run, over the driver's tables by path."""
    return spark.sql(re.sub(r"\bFROM (lineitem|customer|orders|nation|part)\b", lambda m: f"FROM parquet.`{d}/{m[1]}.parquet`", sql))


_LAST = "row_number() OVER (PARTITION BY obs_id ORDER BY ingested_at DESC, ingest_run_id DESC, source_record_id DESC)"


@query(f"SELECT obs_id, source, source_record_id, ingested_at, lon, lat FROM (SELECT *, {_LAST} AS rn FROM again) WHERE rn = 1 AND source IN ('view', 'error') AND lon BETWEEN 18 AND 26 AND lat BETWEEN -33 AND -25")
def store_upserts_read(spark, d):
    """Two upserts into a new store, then a scan by source and box."""
    store, rows = Store(spark, scratch(spark)), view(spark, d, "again")
    for part in (F.col("event_id") % 3 == 0, F.col("event_id") % 3 != 0):
        store.upsert(rows.where(part), "sanlc_accuracy_points")
    return store.read(["view", "error"], (18.0, -33.0, 26.0, -25.0)).select("obs_id", "source", "source_record_id", "ingested_at", "lon", "lat")


@query("SELECT obs_id, month_label, year, chip_uri FROM (SELECT *, row_number() OVER (PARTITION BY obs_id, month_label, year ORDER BY seq % 2, seq DESC) AS rn FROM manifest) WHERE rn = 1")
def manifest_shards(spark, d):
    """Two shards one after the other, merged into the manifest."""
    at, rows = scratch(spark), view(spark, d, "manifest")
    for rest in (1, 0):
        part = dedup.keep_last(rows.where(F.col("seq") % 2 == rest), ["obs_id", "month_label", "year"], "seq")
        sinks.append_shard(part.select(*[F.col(f.name).cast(f.dataType) for f in MANIFEST]), at)
    return sinks.consolidate_shards(spark, at).select("obs_id", "month_label", "year", "chip_uri")


_SEARCH = """SELECT CAST(n_nationkey AS STRING) AS grp, m.month_label, CAST(m.a AS DATE) AS win_start, CAST(m.b AS DATE) AS win_end, 16e0 + n_nationkey % 8 AS minx, 16.5e0 + n_nationkey % 8 AS maxx, -34e0 + n_nationkey % 5 AS miny, -33.5e0 + n_nationkey % 5 AS maxy
  FROM nation CROSS JOIN (SELECT 'feb' AS month_label, '1995-01-17' AS a, '1995-03-15' AS b UNION ALL SELECT 'may', '1995-04-16', '1995-06-15' UNION ALL SELECT 'sep', '1995-08-17', '1995-10-15') m"""
_SCENES = """SELECT o_orderkey AS scene, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE (o_orderkey * 37 % 110) * 1e0 END AS cloud,
  16e0 + (o_custkey * 7 % 80) / 1e1 AS s_minx, 17.1e0 + (o_custkey * 7 % 80) / 1e1 AS s_maxx, -34e0 + (o_custkey * 11 % 50) / 1e1 AS s_miny, -32.9e0 + (o_custkey * 11 % 50) / 1e1 AS s_maxy FROM orders"""


@query(
    f"SELECT grp, month_label, scene FROM (SELECT *, row_number() OVER (PARTITION BY grp, month_label ORDER BY cloud, scene) AS rn FROM ({_SEARCH}) w JOIN ({_SCENES}) s "
    "ON day BETWEEN win_start AND win_end AND cloud < 95 AND s_minx <= maxx AND s_maxx >= minx AND s_miny <= maxy AND s_maxy >= miny) WHERE rn <= 20"
)
def scene_search(spark, d):
    found = chips.scenes_for(table(spark, d, _SEARCH).withColumnRenamed("grp", "group"), table(spark, d, _SCENES), 95.0, 20)
    return found.select(F.col("group").alias("grp"), "month_label", "scene")


#: A field of 2048 by 2048 pixels of 10 m: a line item is a value of a pixel; a customer is a point, of one of three months or none.
_FIELD = """SELECT l_returnflag AS month_label, l_linenumber AS scene, l_linestatus AS band, l_orderkey * 37 % 2048 AS col, l_partkey * 53 % 2048 AS row,
  CASE WHEN l_partkey % 9 = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(l_extendedprice AS DOUBLE) END AS value, CAST(l_quantity AS INT) % 12 AS scl FROM lineitem"""
_SPOTS = """SELECT CAST(c_custkey AS STRING) AS obs_id, CASE c_custkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'N' WHEN 2 THEN 'R' ELSE 'Z' END AS month_label,
  (c_custkey * 977 % 20480) + 5e-1 AS x, 20480e0 - (c_custkey * 761 % 20480) - 5e-1 AS y FROM customer"""


@query(
    f"WITH px AS ({_FIELD}), w AS (SELECT obs_id, month_label, CAST(floor(x / 10) - 16 AS BIGINT) AS c0, CAST(floor((20480 - y) / 10) - 16 AS BIGINT) AS r0 FROM ({_SPOTS})), "
    "p AS (SELECT *, c0 < 0 OR r0 < 0 OR c0 + 32 > 2048 OR r0 + 32 > 2048 AS oob FROM w), "
    "m AS (SELECT obs_id, month_label, band, row - r0 AS r, col - c0 AS c, CAST(median(CASE WHEN scl NOT IN (0, 1, 3, 8, 9, 10) AND NOT isnan(value) THEN value END) AS FLOAT) AS v FROM p JOIN px USING (month_label) "
    "WHERE NOT oob AND col BETWEEN c0 AND c0 + 31 AND row BETWEEN r0 AND r0 + 31 GROUP BY ALL), "
    "f AS (SELECT obs_id, month_label, count(*) FILTER (ok) / 1024e0 AS valid_frac FROM (SELECT obs_id, month_label, r, c, bool_and(v IS NOT NULL) AS ok FROM m GROUP BY ALL) GROUP BY ALL), "
    "g AS (SELECT obs_id, month_label, count(*) AS n_values, sum(CAST(v AS DOUBLE)) AS total FROM m GROUP BY ALL), "
    "s AS (SELECT obs_id, month_label, valid_frac, CASE WHEN oob THEN 'oob' WHEN valid_frac IS NULL THEN 'no_scene_overlap' WHEN valid_frac < 0.002 THEN 'low_valid_frac' ELSE 'ok' END AS status FROM p LEFT JOIN f USING (obs_id, month_label)) "
    "SELECT s.obs_id, s.month_label, status, round(valid_frac, 6) AS valid_frac, CASE WHEN status = 'ok' THEN n_values END AS n_values, CASE WHEN status = 'ok' THEN round(total, 2) END AS total FROM s LEFT JOIN g USING (obs_id, month_label)"
)
def chip_medians(spark, d):
    """Chips of 32 pixels, of which the number of values and the sum of the known ones are shown."""
    rows = chips.extract(table(spark, d, _SPOTS), table(spark, d, _FIELD), 0.0, 20480.0, 10.0, -10.0, 2048, 2048, size=32, least=0.002)
    total = F.aggregate(F.filter("chip", lambda v: ~F.isnan(v)), F.lit(0e0), lambda a, v: a + v.cast("double"))
    shown = F.when(F.col("chip").isNotNull(), F.size("chip").cast("long"))
    return rows.select("obs_id", "month_label", "status", r6("valid_frac").alias("valid_frac"), shown.alias("n_values"), F.round(total, 2).alias("total"))


@query("SELECT vec_id, round(avg(v), 3) AS mean, round(stddev_pop(v), 3) AS deviation FROM (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings) GROUP BY vec_id")
def embed_stacks(spark, d):
    """Raw statistics of stacks of one month, one band and 8 by 8 pixels."""
    rows = spark.read.parquet(f"{d}/embeddings.parquet").select(F.col("vec_id").cast("string").alias("obs_id"), F.col("embedding").alias("stack"), F.array(F.lit(46)).alias("dates"))
    out = raster.embed(rows, raster.RawStats(), (1, 1, 8, 8), scale=1.0)
    return out.select(F.col("obs_id").cast("long").alias("vec_id"), F.round(F.col("emb")[0].cast("double"), 3).alias("mean"), F.round(F.col("emb")[1].cast("double"), 3).alias("deviation"))


_SHADE = "(y * 31 + x * 17 + n_nationkey * 7) % 100"


@query(f"SELECT n_nationkey AS tile, CAST(y AS INT) AS y, CAST(x AS INT) AS x, CASE WHEN {_SHADE} >= 50 THEN 3 ELSE 5 END AS class_id, CAST(greatest({_SHADE}, 99 - {_SHADE}) AS INT) AS confidence, CAST({_SHADE} AS INT) AS ood FROM nation, range(40) a(y), range(48) b(x)")
def tta_map(spark, d):
    """Tiles of 40 by 48 pixels through windows of 64 and eight views each; a pixel's own value is its score, so the map must give it back."""
    grid = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(39)), lambda y: F.transform(F.sequence(F.lit(0), F.lit(47)), lambda x: (y * 31 + x * 17 + F.col("n_nationkey").cast("int") * 7) % 100 * 100 + 50e0)))
    tiles = spark.read.parquet(f"{d}/nation.parquet").select(F.col("n_nationkey").alias("tile"), F.lit(40).alias("height"), F.lit(48).alias("width"), F.lit(1).alias("months"), F.lit(1).alias("bands"), grid.alias("data"))

    def score(stacks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = stacks[:, 0, 0].astype(float)
        return np.stack([v, 1 - v], axis=-1), v

    return inference.blend_map(inference.predict_windows(tiles, score, views=8), [3, 5])


#: A field of 220 by 150 pixels in a box: a line item is a value of a pixel in one of seven scenes, of which the last is too cloudy.
_VALUES = """SELECT l_linenumber AS scene, 32734 AS epsg, 'B02' AS band, 300005e0 + 1e1 * (l_orderkey * 37 % 220) AS x, 6239995e0 - 1e1 * (l_partkey * 53 % 150) AS y,
  (CAST(floor(l_extendedprice) AS BIGINT) % 100) * 1e2 + 25 AS value, CAST(l_quantity AS INT) % 12 AS scl FROM lineitem"""
_SEEN = "SELECT DISTINCT l_linenumber AS scene, CAST('2023-02-10' AS DATE) AS day, l_linenumber * 1e1 AS cloud, 17e0 AS s_minx, 20e0 AS s_maxx, -35e0 AS s_miny, -33e0 AS s_maxy FROM lineitem"


@query(
    f"WITH m AS (SELECT CAST((x - 300005) / 10 AS INT) AS x, CAST((6239995 - y) / 10 AS INT) AS y, CAST(median(value) AS FLOAT) / 1e4 AS v FROM ({_VALUES}) WHERE scene * 10 < 65 AND scl NOT IN (0, 1, 3, 8, 9, 10) GROUP BY ALL), "
    "f AS (SELECT a.y, b.x, coalesce(v, 0e0) AS v FROM range(150) a(y) CROSS JOIN range(220) b(x) LEFT JOIN m ON m.x = b.x AND m.y = a.y) "
    "SELECT CAST(y AS INT) AS y, CAST(x AS INT) AS x, CASE WHEN v > 5e-1 THEN 3 ELSE 5 END AS class_id, CAST(floor(greatest(v, 1 - v) * 100) AS INT) AS confidence, CAST(floor(v * 100) AS INT) AS ood FROM f"
)
def tiled_map(spark, d):
    """A box's composite in tiles of two windows on a side, mapped and blended; a pixel's own median is its score."""
    box = inference.Box(34, True, 300000.0, 6240000.0, 220, 150)
    tiles = inference.composite(table(spark, d, _VALUES), table(spark, d, _SEEN), (18.0, -34.5, 19.0, -33.5), box, [("feb", "2023-02-01", "2023-02-28")], ["B02"], cloud_max=65.0, side=2)

    def score(stacks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = stacks[:, 0, 0].astype(float)
        return np.stack([v, 1 - v], axis=-1), v

    return inference.blend_map(inference.predict_windows(tiles, score), [3, 5]).drop("tile")


_CENTRES = "SELECT l_suppkey AS raster, 300005e0 + 1e1 * (l_linenumber % 5) AS x, 6239995e0 - 2e1 * (CAST(l_quantity AS INT) % 10) AS y FROM lineitem"


@query(
    f"SELECT raster, x0 - (x1 - x0) / nullif(w - 1, 0) / 2 AS west, y1 + (y1 - y0) / nullif(h - 1, 0) / 2 AS north, (x1 - x0) / nullif(w - 1, 0) AS dx, (y1 - y0) / nullif(h - 1, 0) AS dy, w AS width, h AS height "
    f"FROM (SELECT raster, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, count(DISTINCT x) AS w, count(DISTINCT y) AS h FROM ({_CENTRES}) GROUP BY raster)"
)
def affine_from_centres(spark, d):
    return raster.pixel_grid(table(spark, d, _CENTRES), ["raster"])


#: A part is a pixel of a UTM raster that is 64 wide; a customer is a place in and around it, off the pixels' edges.
_PLACES = "SELECT c_custkey, 300003e0 + 1e1 * (c_custkey * 29 % 70) AS sx, 6239997e0 - 1e1 * (c_custkey * 13 % 40) AS sy FROM customer"
_RASTER = "SELECT CAST(floor(p_partkey / 64) AS INT) AS y, CAST(p_partkey % 64 AS INT) AS x, CAST(p_size AS INT) AS class_id, CAST(p_partkey % 101 AS INT) AS confidence, CAST(p_partkey % 7 AS INT) AS ood FROM part"


@query(
    f"SELECT c_custkey, coalesce(class_id, 255) AS class_id, coalesce(confidence, 255) AS confidence, coalesce(ood, 255) AS ood FROM ({_PLACES}) c "
    f"LEFT JOIN ({_RASTER}) r ON r.x = CAST(floor((sx - 300000) / 10) AS INT) AND r.y = CAST(floor((6240000 - sy) / 10) AS INT)"
)
def warp_nearest(spark, d):
    """Places go to Albers as cells, and the warp finds the pixels that they lie on."""
    places = geo.apply(table(spark, d, _PLACES), geo.utm_inverse("sx", "sy", 34))
    cells = geo.apply(places, geo.albers("lon", "lat", "ax", "ay")).select("c_custkey", "ax", "ay")
    moved = inference.warp(cells, table(spark, d, _RASTER), 34, 300000.0, 6240000.0, 10.0, -10.0)
    return moved.select("c_custkey", "class_id", "confidence", "ood")
