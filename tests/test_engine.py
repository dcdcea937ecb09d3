"""Invariants of the observation engine; results against SQL are in test_catalog.py."""

import datetime as dt
import math
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from terrafold.functions import geo
from terrafold.functions import scalars as S
from terrafold.operators import adapters, crosswalk, dedup, filters, head, manifest, raster, spatial, split, stats
from terrafold.schema import OBSERVATION, REQUIRED
from terrafold.sources import files
from terrafold.sources.store import Store, canonical, run_id

T0 = dt.datetime(2024, 1, 1)


def observation(obs, when=T0, **more):
    return {n: None for n in OBSERVATION.names} | {"obs_id": obs, "source": "gbif", "source_record_id": obs, "geom_type": "point", "weight": 0.5, "ingested_at": when, "ingest_run_id": "r", "aoi_admin1": "western_cape", "lon": 18.5, "lat": -33.9} | more


def observations(spark, rows):
    return spark.createDataFrame(rows, OBSERVATION)


# ---- projections


def points(spark, n=200):
    rng = np.random.default_rng(0)
    return spark.createDataFrame([(float(a), float(b)) for a, b in zip(rng.uniform(16, 33, n), rng.uniform(-35, -22, n), strict=True)], "lon double, lat double")


def test_albers_round_trip_and_equal_area(spark):
    there = geo.apply(points(spark), geo.albers("lon", "lat", "x", "y"))
    back = geo.apply(there, geo.albers_inverse("x", "y", "lon2", "lat2")).toPandas()
    assert np.abs(back.lon - back.lon2).max() < 1e-9 and np.abs(back.lat - back.lat2).max() < 2e-8
    d = 1e-4
    for lon, lat in ((17.0, -34.0), (25.0, -28.0), (32.0, -23.0)):
        ring = spark.createDataFrame([(lon, lat), (lon + d, lat), (lon + d, lat + d), (lon, lat + d)], "lon double, lat double")
        p = geo.apply(ring, geo.albers("lon", "lat", "x", "y")).toPandas()
        area = abs(sum(p.x[i] * p.y[(i + 1) % 4] - p.x[(i + 1) % 4] * p.y[i] for i in range(4))) / 2
        s0, s1 = (math.sin(math.radians(v)) for v in (lat, lat + d))
        q = [s / (1 - geo.E2 * s * s) + math.atanh(geo.E * s) / geo.E for s in (s0, s1)]
        true = math.radians(d) * geo.A**2 * (1 - geo.E2) / 2 * (q[1] - q[0])
        assert abs(area / true - 1) < 1e-4


def test_utm_round_trip_and_known_place(spark):
    there = geo.apply(points(spark), geo.utm("lon", "lat", 34))
    back = geo.apply(there, geo.utm_inverse("x", "y", 34, True, "lon2", "lat2")).toPandas()
    near = (back.lon - 21).abs() < 6
    assert np.abs(back.lon - back.lon2)[near].max() < 1e-8 and np.abs(back.lat - back.lat2)[near].max() < 1e-8
    middle = geo.apply(spark.createDataFrame([(21.0, 0.0)], "lon double, lat double"), geo.utm("lon", "lat", 34)).first()
    assert abs(middle.x - 500000) < 1e-6 and abs(middle.y - 10000000) < 1e-6


def test_offsets_are_geodesic(spark):
    rows = geo.apply(points(spark, 50).withColumns({"az": F.lit(37e0), "m": F.lit(-5e0)}), geo.offset("lon", "lat", "az", "m"))
    there = geo.apply(rows.withColumns({"a2": F.lit(37e0), "m2": F.lit(5e0)}), geo.offset("lon2", "lat2", "a2", "m2", "lon3", "lat3")).toPandas()
    assert np.abs(there.lon - there.lon3).max() * 111320 < 1e-3 and np.abs(there.lat - there.lat3).max() * 111320 < 1e-3
    flat = geo.apply(geo.apply(rows, geo.utm("lon", "lat", "floor((lon + 180) / 6) + 1", x="x1", y="y1")), geo.utm("lon2", "lat2", "floor((lon + 180) / 6) + 1", x="x2", y="y2")).toPandas()
    assert np.abs(np.hypot(flat.x1 - flat.x2, flat.y1 - flat.y2) - 5).max() < 0.01


def test_polygon_edges(spark):
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (2, 0), (2, 2), (0, 2), (0, 0))])
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (0.0, 0.0), (3.0, 1.0)], "x double, y double")
    got = df.select(geo.in_ring("x", "y", ring, True).alias("a"), geo.in_ring("x", "y", ring, False).alias("b")).collect()
    assert [tuple(r) for r in got] == [(True, True), (True, False), (True, False), (False, False)]


# ---- scalars


def test_scalar_rules(spark):
    names = ["Populus × canescens", "Salix alba", "NA", "", "(x y)", "[x y", "Pinus", None]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(S.normalize_name("n")).collect()]
    assert got == ["Populus canescens", "Sali alba", None, None, None, None, None, None]
    marks = [r[0] for r in spark.createDataFrame([(m,) for m in ("C", "c", "0", "10", "3L", "7R", "?")], "m string").select(S.mark_offset("m")).collect()]
    assert marks == [0.0, 0.0, -5.0, 5.0, -2.0, 2.0, None]
    cover = [r[0] for r in spark.createDataFrame([(100.0,), (0.0,), (-1.0,), (float("nan"),), (None,)], "d double").select(S.density_to_cover("d")).collect()]
    assert cover == [100.0, None, None, None, None]
    dates = [r[0] for r in spark.createDataFrame([("1899-12-30",), ("2025-05-19 10:00:00",), ("1990-01-01",), ("no",), (None,)], "d string").select(S.clean_date("d")).collect()]
    assert dates == [None, "2025-05-19", "1990-01-01", None, None]
    assert spark.range(1).select(S.coordinate_id("m", F.lit(1.5), F.lit(-2.25))).first()[0] == "m:1.500000:-2.250000"
    with pytest.raises(Exception, match="nowhere"):
        spark.createDataFrame([("nowhere",)], "p string").select(adapters.zone_of("p")).collect()


def test_uncertainty_constants():
    assert abs(adapters.LINE_UNCERTAINTY_M - 26**0.5) < 1e-12 and abs(adapters.PLOT_UNCERTAINTY_M - 31.25**0.5) < 1e-12
    assert len(adapters.ACCURACY) == 48 and len(adapters.LULC) == 30 and len(adapters.BIOMES) == 7


# ---- classes


def test_class_map_rules():
    with pytest.warns(UserWarning):
        m = crosswalk.build({"m": {0: {"members": ["A b"]}, 1: {"members": ["a B", "Pinus x"], "genus_fallback": True, "genus": "pinus"}, "x": {"members": ["q r"]}, 2: {"name": "water", "source": "sanlc", "members": []}}}, "m")
    assert [m.resolve(x) for x in ("a b", " PINUS nigra ", "q r", "", None, "water")] == [1, 1, None, None, None, 2]
    with pytest.raises(KeyError):
        crosswalk.build({}, "m")
    with pytest.raises(ValueError, match="members"):
        crosswalk.build({"m": {0: {"name": "x"}}}, "m")


# ---- store


def test_store_upserts_and_scans(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    with pytest.raises(FileNotFoundError):
        store.read()
    later = T0 + dt.timedelta(days=1)
    first = observations(spark, [observation("gbif:1"), observation("gbif:42", species="old")])
    store.upsert(first, "mapwaps_tugela", "r1")
    store.upsert(observations(spark, [observation("gbif:42", later, species="new")]), "mapwaps_tugela", "r2")
    store.upsert(first, "mapwaps_tugela", "r3")
    assert sorted((r.obs_id, r.species) for r in store.read().collect()) == [("gbif:1", None), ("gbif:42", "new")]
    store.upsert(observations(spark, [observation("s:1", source="sanlc", lon=30.0)]), "sanlc_accuracy_points")
    spark.range(3).write.parquet(str(tmp_path / "store" / "summary.parquet"))
    assert store.read().count() == 3
    assert [r.obs_id for r in store.read(sources=["sanlc"]).collect()] == ["s:1"]
    assert store.read(bbox=(18, -34, 19, -33)).count() == 2
    plan = store.read(sources=["sanlc"], bbox=(18, -34, 19, -33))._jdf.queryExecution().toString()
    assert "IsNotNull(source)" in plan[plan.index("PushedFilters") :]
    with pytest.raises(ValueError, match="unknown dataset"):
        store.upsert(first, "elsewhere")
    with pytest.raises(ValueError, match="weight"):
        canonical(first.drop("weight"))
    assert canonical(first.select(*REQUIRED)).columns == OBSERVATION.names
    assert run_id("x", T0) == "x_20240101T000000Z"


def test_streamed_upsert_equals_batch(spark, tmp_path):
    from terrafold.streaming.upsert import upsert_stream

    rows = [observation(f"o:{i % 5}", T0 + dt.timedelta(hours=i), species=str(i)) for i in range(20)]
    observations(spark, rows).repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(OBSERVATION).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    store = Store(spark, str(tmp_path / "store"))
    upsert_stream(stream, store, "mapwaps_tugela", str(tmp_path / "cp")).awaitTermination()
    assert sorted((r.obs_id, r.species) for r in store.read().collect()) == sorted((r.obs_id, r.species) for r in dedup.latest(observations(spark, rows)).collect())


# ---- filters


def test_label_query_rules(spark):
    rows = [
        observation("a", event_date=None),
        observation("b", event_date="2010-01-01"),
        observation("c", event_date="2020-01-01", coord_uncertainty_m=900.0),
        observation("d", event_date="2020-01-01", cover_pct=70.0, species_normalized="acacia mearnsii"),
        observation("e", event_date="junk", lon=50.0),
    ]
    df = observations(spark, rows)
    aoi = spark.createDataFrame([Row(ring=[Row(x=float(x), y=float(y)) for x, y in ((18, -34), (19, -34), (19, -33), (18, -33), (18, -34))])])

    def ids(**rule):
        return sorted(r.obs_id for r in filters.select_labels(df, filters.LabelFilter(**rule), aoi).collect())

    assert ids() == ["a", "d"]
    assert ids(date_max="2025-12-31") == ["d"]
    assert ids(min_cover=60.0) == ["d"] and ids(species=("mearnsii",)) == ["d"] and ids(species=("Mearnsii",)) == []
    assert ids(max_uncertainty=None, date_min=None) == ["a", "b", "c", "d"]


# ---- thinning, grids


def test_thinning_does_not_depend_on_order(spark):
    rows = [(f"obs{i}", "Pinus", 19 + 1e-5 * i, -32.0) for i in range(8)]
    a, b = (sorted(r.obs_id for r in dedup.thin(spark.createDataFrame(x, "obs_id string, sp string, lon double, lat double"), 20.0, "sp").collect()) for x in (rows, rows[::-1]))
    assert a == b and "obs0" in a and len(a) < 8


def test_grid_counts_and_blocks(spark):
    square = [(0.0, -3500000.0), (20000.0, -3500000.0), (20000.0, -3480000.0), (0.0, -3480000.0), (0.0, -3500000.0)]
    grid = spatial.grid(spark, square, 10, 0.01)
    assert [(r.block_id, r.ix, r.iy) for r in grid.orderBy("block_id").collect()] == [(0, 0, 0), (1, 0, 1), (2, 1, 0), (3, 1, 1)]
    inside = geo.apply(spark.createDataFrame([(5000.0, -3495000.0), (15000.0, -3485000.0), (50000.0, -3485000.0)], "ax double, ay double"), geo.albers_inverse("ax", "ay"))
    got = spatial.assign_blocks(inside, grid, 10).collect()
    assert sorted(r.block_id for r in got) == [0, 3]
    edge = geo.apply(spark.createDataFrame([(9999.9, -3495000.0), (10000.1, -3495000.0)], "ax double, ay double"), geo.albers_inverse("ax", "ay"))
    assert len(spatial.assign_blocks(edge, grid, 10).collect()) <= 2
    assert spatial.clip_area(square, 5000, -3495000, 30000, -3470000) == pytest.approx(15000 * 15000)


def test_blocks_straight_in_metres(spark):
    """Half way along an edge of 100 km, the chord in degrees lies tens of metres off the line in metres."""
    square = [(-600000.0, -3700000.0), (-400000.0, -3700000.0), (-400000.0, -3500000.0), (-600000.0, -3500000.0), (-600000.0, -3700000.0)]
    grid = spatial.grid(spark, square, 100, 0.01)
    places = [(-550000.0 + 20000 * i, -3600000.0 + off) for i in range(6) for off in (-150.0, -1.0, -0.01, 0.01, 1.0, 150.0)]
    points = geo.apply(spark.createDataFrame([(k, *p) for k, p in enumerate(places)], "k int, ax double, ay double"), geo.albers_inverse("ax", "ay"))
    got = {r.k: r.block_id for r in spatial.assign_blocks(points, grid, 100, straight="metres").collect()}
    assert got == {k: int(x >= -500000) * 2 + int(y >= -3600000) for k, (x, y) in enumerate(places)}


# ---- rasters


def test_median_skips_nan_and_masks(spark):
    nan = float("nan")
    rows = [("a", 1.0, 4), ("a", nan, 4), ("a", 3.0, 5), ("b", nan, 4), ("c", 5.0, 8), ("c", 7.0, 11), ("c", 9.0, 2)]
    df = spark.createDataFrame(rows, "k string, value double, scl int")
    got = {r.k: r.median for r in raster.median_composite(raster.mask_scl(df), ["k"]).collect()}
    assert got == {"a": 2.0, "b": None, "c": 8.0}


def test_windows_tapers_and_views(spark):
    assert raster.starts(64, 64, 48) == [0] and raster.starts(200, 64, 48) == [0, 48, 96, 136]
    w = [r[0] for r in spark.range(64).select(raster.taper_weight(F.col("id"), 64, 16)).collect()]
    assert all(abs(w[48 + i] + w[i] - 1) < 1e-12 for i in range(16)) and min(w[16:48]) == 1
    for forward, inverse in raster.d4(8):
        r, c = forward(F.col("r"), F.col("c"), 6)
        cells = spark.range(36).select((F.col("id") / 6).cast("int").alias("r"), (F.col("id") % 6).cast("int").alias("c"))
        there = cells.select("r", "c", r.alias("fr"), c.alias("fc"))
        br, bc = inverse(F.col("fr"), F.col("fc"), 6)
        assert there.where((br != F.col("r")) | (bc != F.col("c"))).count() == 0
    assert len(raster.d4(0)) == 1 and len(raster.d4(9)) == 8
    with pytest.raises(MemoryError):
        raster.check_size(1 << 20, 1 << 20)


def test_raw_stats_embedder(spark):
    stacks = np.random.default_rng(0).normal(size=(4, 3, 10, 8, 8)).astype("float32")
    stacks[0, 0, 0] = np.nan
    out = raster.RawStats().embed(stacks, np.zeros((4, 3)))
    assert out.shape == (4, 60) and np.isfinite(out).all() and out[0, 0] == 0
    df = spark.createDataFrame([(str(i), s.ravel().tolist(), [46, 135, 258]) for i, s in enumerate(np.nan_to_num(stacks))], "obs_id string, stack array<float>, dates array<int>")
    assert [len(r.emb) for r in raster.embed(df, raster.RawStats(), (3, 10, 8, 8), 1.0).collect()] == [60] * 4


# ---- manifest


def test_reconcile_and_todo(spark):
    m = spark.createDataFrame([("a", "feb"), ("a", "oct"), ("b", "feb"), ("c", "jul")], "obs_id string, month_label string")
    want = spark.createDataFrame([("a", x) for x in ("feb", "may", "sep")], "obs_id string, month_label string")
    keep = spark.createDataFrame([("a",), ("c",)], "obs_id string")
    got = {(r.obs_id, r.month_label): r.stale for r in manifest.reconcile(m, keep, want).collect()}
    assert got == {("a", "feb"): False, ("a", "oct"): True, ("b", "feb"): True, ("c", "jul"): False}
    assert sorted(r.month_label for r in manifest.todo(want, m).collect()) == ["may", "sep"]
    done = manifest.completeness(want, m).first()
    assert (done.missing, done.extra, done.done) == (["may", "sep"], ["oct"], False)


# ---- split and head


def test_stratification_reaches_every_fold_and_keeps_locks():
    matrix = np.zeros((20, 2))
    matrix[:, 0] = 5
    matrix[[2, 9, 15], 1] = 1
    folds = split.stratify(list(range(20)), matrix, 0.7, 0.15, 42)
    assert set(folds) == set(range(20)) and {folds[b] for b in range(20)} == set(split.FOLDS)
    assert folds == split.stratify(list(range(20)), matrix, 0.7, 0.15, 42)
    locked = split.stratify(list(range(20)), matrix, 0.7, 0.15, 42, {3: "test", 99: "val"})
    assert locked[3] == "test" and 99 not in locked


def test_head_learns_and_round_trips(spark):
    rng = np.random.default_rng(1)
    fold = ["train", "train", "val", "test"]
    rows = [(i, (rng.normal(size=8) * 0.5 + (i % 2) * 2).tolist(), i % 2, fold[(i // 2) % 4]) for i in range(80)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, fold string")
    for arch in ("linear", "mlp"):
        h = head.train(df, arch=arch, hidden=16, epochs=80)
        assert h.report["test_macro_f1"] > 0.8
    again = head.Head.from_row(h.to_row())
    x = np.stack([r[1] for r in rows])
    assert np.allclose(h.probabilities(x)[0], again.probabilities(x)[0])
    got = head.predict(df, h, "vec_id").toPandas()
    assert got.ood.between(0, 100).all() and (got.class_id == got.vec_id % 2).mean() > 0.9
    with pytest.raises(ValueError, match="empty"):
        head.train(df.where("fold <> 'val'"))
    means, precision = head.gaussian_fit(df, [0, 1], 8)
    y = np.array([r[2] for r in rows])
    direct = np.stack([x[y == c].mean(0) for c in (0, 1)])
    assert np.allclose(means, direct)
    assert np.allclose(precision, np.linalg.inv(np.cov(x - direct[y], rowvar=False) + 1e-3 * np.eye(8)))
    with pytest.raises(ValueError, match="classes"):
        head.gaussian_fit(df, [0, 1, 2], 8)


def test_scores_and_distances_of_wide_vectors(spark):
    rng = np.random.default_rng(3)
    dim, k = 200, 5
    x, means, w, b = rng.normal(size=(20, dim)), rng.normal(size=(k, dim)), rng.normal(size=(k, dim)) / 10, rng.normal(size=k)
    a = rng.normal(size=(dim, dim)) / 10
    precision = a @ a.T + np.eye(dim)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, v array<double>")
    z, mean, sd = F.col("v"), means[0], np.abs(means[1]) + 1
    got = rows.select("i", head.mahalanobis(z, means, precision).alias("d"), head.softmax(head.linear_scores(z, w, b)).alias("p"), head.standardise("v", mean, sd).alias("s")).orderBy("i").toPandas()
    want = np.min([(((x - m) @ precision) * (x - m)).sum(1) for m in means], axis=0)
    scores = np.exp(x @ w.T + b)
    assert np.allclose(got.d, want) and np.allclose(np.stack(got.p), scores / scores.sum(1, keepdims=True)) and np.allclose(np.stack(got.s), (x - mean) / sd)


def test_macro_f1_uses_rounded_values(spark):
    df = spark.createDataFrame([(0, 0)] * 2 + [(0, 1)] + [(1, 1)] * 3, "y_true int, y_pred int")
    got = stats.prf(df, [0, 1, 2]).orderBy("class_id").collect()
    assert [r.f1 for r in got] == [0.8, 0.857, 0.0] and got[0].macro_f1 == pytest.approx((0.8 + 0.857) / 2)


# ---- files


def write_shapefile(path, pts, names):
    records, index = b"", b""
    for i, (x, y) in enumerate(pts):
        index += struct.pack(">ii", (100 + len(records)) // 2, 10)
        records += struct.pack(">ii", i + 1, 10) + struct.pack("<idd", 1, x, y)

    def header(size):
        return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, size // 2) + struct.pack("<ii8d", 1000, 1, 0, 0, 0, 0, 0, 0, 0, 0)

    path.with_suffix(".shp").write_bytes(header(100 + len(records)) + records)
    path.with_suffix(".shx").write_bytes(header(100 + len(index)) + index)
    dbf = struct.pack("<4BIHH20x", 3, 124, 1, 1, len(pts), 32 + 32 + 1, 1 + 12) + b"LULC".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([12, 0]) + b"\0" * 14 + b"\r"
    path.with_suffix(".dbf").write_bytes(dbf + b"".join(b" " + n.encode().ljust(12) for n in names))


def test_readers(spark, tmp_path):
    spark.dataSource.register(files.ShapefileSource)
    write_shapefile(tmp_path / "p", [(18.5, -33.0), (19.0, -32.5)], ["Alien_Pine", ""])
    got = spark.read.format("shapefile").load(str(tmp_path / "p.shp")).collect()
    assert [(r.x, r.y, r.LULC) for r in got] == [(18.5, -33.0, "Alien_Pine"), (19.0, -32.5, None)]
    (tmp_path / "a.geojson").write_text('{"features": [{"properties": {"n": 1}, "geometry": {"type": "Polygon", "coordinates": [[[0,0],[1,0],[1,1],[0,0]]]}}, {"properties": {}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[5,5],[6,5],[6,6],[5,5]]], [[[7,7],[8,7],[8,8],[7,7]]]]}}]}')
    rings = files.read_geojson(spark, str(tmp_path / "a.geojson")).orderBy("order").collect()
    assert [(r.order, r.ring[0].x, len(r.ring)) for r in rings] == [(0, 0.0, 4), (1, 5.0, 4), (1, 7.0, 4)]
    (tmp_path / "s.csv").write_text("a,b\n1,x\n,2.5\n")
    assert [(r.a, r.b) for r in files.read_csv(spark, str(tmp_path / "s.csv"), ("b",)).collect()] == [("1", None), (None, 2.5)]
    assert files.list_parquet(spark, str(tmp_path / "none")) == []
