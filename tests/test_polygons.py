"""Polygons of several rings: holes are out, every part is in."""

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafold import cli
from terrafold.operators import filters, spatial
from terrafold.schema import OBSERVATION
from terrafold.sources import files
from terrafold.sources.store import Store

OUTER = [(18.0, -34.0), (22.0, -34.0), (22.0, -30.0), (18.0, -30.0), (18.0, -34.0)]
HOLE = [(19.0, -33.0), (21.0, -33.0), (21.0, -31.0), (19.0, -31.0), (19.0, -33.0)]
ISLE = [(25.0, -34.0), (26.0, -34.0), (26.0, -33.0), (25.0, -34.0)]
PLACES = [("in", 18.5, -32.0), ("hole", 20.0, -32.0), ("isle", 25.9, -33.9), ("out", 24.0, -32.0), ("edge", 18.0, -32.0), ("rim", 19.0, -32.0), ("none", None, None)]


def geojson(path, *polygons):
    path.write_text(json.dumps({"features": [{"properties": {"shapeName": "A"}, "geometry": {"type": "MultiPolygon", "coordinates": polygons}}]}))
    return str(path)


@pytest.fixture(scope="module")
def places(spark):
    return spark.createDataFrame(PLACES, "obs_id string, lon double, lat double")


def test_geojson_keeps_holes_and_parts(spark, places, tmp_path):
    parts = files.read_geojson(spark, geojson(tmp_path / "a.geojson", [OUTER, HOLE], [ISLE]))
    assert [sum(v is None for v in r.ring) for r in parts.orderBy(F.desc(F.size("ring"))).collect()] == [1, 0]
    for boundary, want in ((False, {"in", "isle"}), (True, {"in", "isle", "edge", "rim"})):
        assert {r.obs_id for r in filters.clip(places, parts, boundary).collect()} == want
    assert filters.clip(places, parts.limit(0), True).isEmpty()
    found = spatial.join_polygons(places, parts.withColumn("name", F.lit("x")).drop("properties"))
    assert {r.obs_id for r in found.where("name = 'x'").collect()} == {"in", "isle"}


def test_overlapping_parts_are_each_tested(spark, places):
    square = [{"x": x, "y": y} for x, y in OUTER]
    parts = spark.createDataFrame([(square,), (square,)], "ring array<struct<x:double,y:double>>")
    assert {r.obs_id for r in filters.clip(places, parts, False).collect()} == {"in", "hole", "rim"}


def test_an_outline_of_many_vertices(spark):
    import math

    n = 50_000
    ring = [{"x": 20 + math.cos(2 * math.pi * i / n), "y": -32 + math.sin(2 * math.pi * i / n)} for i in range(n)]
    parts = spark.createDataFrame([(ring + ring[:1],)], "ring array<struct<x:double,y:double>>")
    points = spark.range(400).select(F.col("id").cast("string").alias("obs_id"), (18.5 + (F.col("id") % 20) * 0.15).alias("lon"), (-33.5 + F.floor(F.col("id") / 20) * 0.15).alias("lat"))
    got = {r.obs_id for r in filters.clip(points, parts, False).collect()}
    assert got == {r.obs_id for r in points.collect() if math.hypot(r.lon - 20, r.lat + 32) < 1}


def record(*rings):
    starts, points = [sum(map(len, rings[:i])) for i in range(len(rings))], [p for r in rings for p in r]
    box = (min(x for x, _ in points), min(y for _, y in points), max(x for x, _ in points), max(y for _, y in points))
    return struct.pack("<i4d2i", 5, *box, len(rings), len(points)) + struct.pack(f"<{len(rings)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points)


def write_shapefile(path, kind, bodies, field, names):
    records, index, at = b"", b"", 100
    for i, body in enumerate(bodies, 1):
        index += struct.pack(">2i", at // 2, len(body) // 2)
        records += struct.pack(">2i", i, len(body) // 2) + body
        at += 8 + len(body)
    head = struct.pack("<i", 9994) + b"\0" * 28 + struct.pack("<i", kind) + b"\0" * 64
    path.with_suffix(".shp").write_bytes(head + records)
    path.with_suffix(".shx").write_bytes(head + index)
    dbf = struct.pack("<4BIHH20x", 3, 124, 1, 1, len(names), 65, 1 + 30) + field.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([30, 0]) + b"\0" * 14 + b"\r"
    path.with_suffix(".dbf").write_bytes(dbf + b"".join(b" " + n.encode().ljust(30) for n in names))
    return str(path)


def test_shapefile_rings(spark, places, tmp_path):
    at = write_shapefile(tmp_path / "p.shp", 5, [record(OUTER, HOLE, ISLE), struct.pack("<i", 0), record([(60.0, 1.0), (61.0, 1.0), (61.0, 2.0), (60.0, 1.0)])], "N", ["a", "b", "c"])
    spark.dataSource.register(files.ShapefileSource)
    shapes = spark.read.format("shapefile").load(at)
    assert {r.N: r.ring is None for r in shapes.collect()} == {"a": False, "b": True, "c": False}
    assert {r.obs_id for r in filters.clip(places, shapes.where("ring is not null"), False).collect()} == {"in", "isle"}
    assert {r.N for r in spark.read.format("shapefile").option("bbox", "17,-35,27,-29").load(at).where("ring is not null").collect()} == {"a"}


def test_accuracy_points_from_folders(spark, tmp_path):
    """The folder's points, not its integrity file; biomes of a shapefile; points out of the area and in holes go."""
    def point(x, y):
        return struct.pack("<i2d", 1, x, y)

    (tmp_path / "2020").mkdir()
    write_shapefile(tmp_path / "2020" / "a_integrity.shp", 1, [point(18.5, -32.0)], "Class_name", ["Mines"])
    write_shapefile(tmp_path / "2020" / "points.shp", 1, [point(18.5, -32.0), point(18.6, -32.0), point(20.0, -32.0), point(50.0, 3.0)], "Class_name", ["Mines", "Mangrove Wetlands", "Mines", "Mines"])
    biomes = write_shapefile(tmp_path / "veg.shp", 5, [record(OUTER)], "T_BIOME", ["Fynbos"])
    aoi = geojson(tmp_path / "aoi.geojson", [OUTER, HOLE])
    a = cli.parser().parse_args(["labels-sanlc-ingest", "--root", str(tmp_path / "s"), "--points", f"2020={tmp_path / '2020'}", "--aoi", aoi, "--biomes", biomes])
    Store(spark, a.root).upsert(spark.createDataFrame([], OBSERVATION), "mapwaps_tugela")
    assert [r.n for r in a.run(spark, a).collect()] == [2]
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        files.shapefile_in(str(tmp_path / "none"))


def test_a_survey_without_a_projection(spark, tmp_path):
    at = write_shapefile(tmp_path / "t.shp", 1, [struct.pack("<i2d", 1, 30.0, -29.0)], "LULC_Class", ["Alien_Pine"])
    a = cli.parser().parse_args(["labels-mapwaps-ingest", "--root", str(tmp_path / "s"), "--points", at, "--catchment", "mapwaps_tugela"])
    with pytest.raises(ValueError, match="projection"):
        a.run(spark, a)


def test_grid_leaves_holes_out(spark, tmp_path):
    square = lambda x, y, side: [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]
    outline = [*square(0.0, 0.0, 50000.0), None, *square(10000.0, 10000.0, 20000.0), None, *square(80000.0, 0.0, 10000.0)]
    cells = {(r.ix, r.iy): r.share for r in spatial.grid(spark, outline, 10.0, 0.01).collect()}
    assert len(cells) == 25 - 4 + 1 and (1, 1) not in cells and cells[8, 0] == pytest.approx(1)
    at = geojson(tmp_path / "a.geojson", [OUTER, HOLE], [ISLE])
    assert sum(v is None for v in cli._outline(spark, at)) == 3
    assert cli.provinces(files.read_geojson(spark, at), ["A"], south=-33.0).count() == 1


def wild_rings(seed, n, x=20.0, y=-30.0, size=3.0):
    """A wavy, rough outline of n vertices with a hole of n / 2 and an isle in the hole."""
    rng = np.random.default_rng(seed)
    rings = []
    for radius, k in ((size, n), (size / 2, n // 2), (size / 8, 40)):
        turn = np.sort(rng.random(k)) * 2 * np.pi
        r = radius * (0.8 + 0.1 * np.sin(7 * turn) + 0.05 * np.sin(31 * turn + seed) + 1e-4 * rng.random(k))
        points = list(zip((x + r * np.cos(turn)).tolist(), (y + r * np.sin(turn)).tolist(), strict=True))
        rings.append([*points, points[0]])
    return rings


def crossings(rings, px, py):
    """Even-odd rule of many points, ring by ring."""
    odd = np.zeros(len(px), bool)
    for ring in rings:
        v = np.array(ring)
        for k in range(0, len(px), 200):
            x, y = px[k : k + 200, None], py[k : k + 200, None]
            (ax, ay), (bx, by) = v[:-1].T, v[1:].T
            with np.errstate(all="ignore"):
                odd[k : k + 200] ^= (((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)).sum(1) % 2 == 1
    return odd


def parted(rings):
    return [None if v is None else {"x": v[0], "y": v[1]} for k, r in enumerate(rings) for v in ([None] if k else []) + r]


@pytest.mark.parametrize("most_edges", [10, 128, 10**9])
def test_points_meet_the_edges_of_their_cells(spark, most_edges):
    """As many edges as 100,000, holes and isles, overlapping polygons of which the first wins, and vertices on the cells' sides."""
    shapes = [wild_rings(1, 100_000 if most_edges == 128 else 3000), wild_rings(2, 60, 21.0, -31.0), [[(18.0, -32.0), (18.0, -28.0), (19.5, -28.5), (22.0, -28.0), (22.0, -32.0), (18.0, -32.0)]], [[(16.0, -32.0), (32.0, -32.0), (32.0, -16.0), (16.0, -16.0), (16.0, -32.0)]]]
    rng = np.random.default_rng(3)
    x, y = rng.uniform(16, 25, 1500), rng.uniform(-35, -26, 1500)
    x[:300], y[:300] = np.round(x[:300] * 4) / 4 + 1e-9, np.round(y[:300] * 4) / 4 + 1e-9  # beside the corners of cells
    points = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))], "i int, lon double, lat double")
    polygons = spark.createDataFrame([(k, parted(r), f"p{k}") for k, r in enumerate(shapes)], "order int, ring array<struct<x:double,y:double>>, name string")
    got = {r.i: r.name for r in spatial.join_polygons(points, polygons, most_edges=most_edges).collect()}
    inside = np.stack([crossings(r, x, y) for r in shapes])
    want = {i: f"p{inside[:, i].argmax()}" if inside[:, i].any() else None for i in range(len(x))}
    assert len(got) == len(x) and got == want and len(set(want.values())) == 5
    if most_edges == 128:
        cells = spatial.polygon_cells(polygons.where("order = 0"))
        assert cells.agg(F.max(F.size("_e"))).first()[0] < 100_000 / 20


def test_points_on_edges_and_empty_polygons(spark):
    polygons = spark.createDataFrame([(0, None, "none"), (1, [], "empty"), (2, parted([[(18.0, -33.0), (19.0, -33.0), (19.0, -32.0), (18.0, -32.0), (18.0, -33.0)]]), "box")], "order int, ring array<struct<x:double,y:double>>, name string")
    points = spark.createDataFrame([(1, 18.0, -32.5), (2, 18.5, -33.0), (3, 19.0, -32.0), (4, 18.5, -32.5), (5, None, -32.5)], "i int, lon double, lat double")
    for boundary, want in ((False, {4}), (True, {1, 2, 3, 4})):
        assert {r.i for r in spatial.join_polygons(points, polygons, boundary).collect() if r.name} == want
    assert spatial.join_polygons(points, polygons.limit(0)).count() == 5


def test_dense_places_are_settled_without_pairs(spark):
    """100,000 points and as many others in one cell, and points around that are near or far."""
    rng = np.random.default_rng(4)
    crowd = spark.range(100_000).select(F.concat(F.lit("c"), "id").alias("obs_id"), (20.0 + F.rand(1) * 1e-3).alias("lon"), (-30.0 + F.rand(2) * 1e-3).alias("lat"))
    others = spark.range(100_000).select((20.0 + F.rand(3) * 1e-3).alias("lon"), (-30.0 + F.rand(4) * 1e-3).alias("lat"))
    x, y = rng.uniform(19.99, 20.01, 300), rng.uniform(-30.01, -29.99, 300)
    ring = spark.createDataFrame([(f"r{i}", float(a), float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))], "obs_id string, lon double, lat double")
    got = {r.obs_id for r in spatial.away_from(crowd.unionByName(ring), others, 320.0).collect()}
    assert not any(k.startswith("c") for k in got)
    few = spatial.away_from(ring, spark.createDataFrame([(20.0, -30.0), (20.001, -29.999)], "lon double, lat double"), 320.0)
    metres = lambda a, b, c, d: np.hypot((a - c) * 111_320 * np.cos(np.radians(30)), (b - d) * 110_860)
    distance = np.minimum(metres(x, y, 20.0, -30.0), metres(x, y, 20.001, -29.999))
    sure = np.abs(distance - 320) > 5
    found = {r.obs_id for r in few.collect()}
    assert all((f"r{i}" in found) == (distance[i] > 320) for i in np.flatnonzero(sure))
