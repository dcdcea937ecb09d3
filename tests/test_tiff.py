"""Tiled TIFF: what is read, which tiles are read, what is written, and maps and chips over it."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafold.operators import campaign, inference
from terrafold.sources import tiff


def classic(path, array, origin, metres, epsg, nodata=None, tile=16, order="<", predictor=1, planes=1, packed=True):
    """Writes (bands, rows, columns) as a tiled file of 32-bit offsets."""
    bands, rows, cols = array.shape
    form = {"u": 1, "i": 2, "f": 3}[array.dtype.kind]
    blocks = []
    for group in [[b] for b in range(bands)] if planes == 2 else [list(range(bands))]:
        for r in range(0, rows, tile):
            for c in range(0, cols, tile):
                full = np.zeros((tile, tile, len(group)), array.dtype)
                part = np.moveaxis(array[group, r : r + tile, c : c + tile], 0, -1)
                full[: part.shape[0], : part.shape[1]] = part
                if predictor == 2:
                    full[:, 1:] -= full[:, :-1].copy()
                raw = full.astype(array.dtype.newbyteorder(order)).tobytes()
                blocks.append(zlib.compress(raw) if packed else raw)
    offsets, data = [], b""
    for b in blocks:
        offsets.append(8 + len(data))
        data += b + b"\0" * (len(b) % 2)
    p = lambda code, *v: struct.pack(f"{order}{len(v)}{code}", *v)
    tags = [(256, 4, 1, p("I", cols)), (257, 4, 1, p("I", rows)), (258, 3, bands, p("H", *[array.dtype.itemsize * 8] * bands)), (259, 3, 1, p("H", 8 if packed else 1)), (277, 3, 1, p("H", bands))]
    tags += [(284, 3, 1, p("H", planes)), (317, 3, 1, p("H", predictor)), (322, 4, 1, p("I", tile)), (323, 4, 1, p("I", tile)), (324, 4, len(blocks), p("I", *offsets)), (325, 4, len(blocks), p("I", *map(len, blocks)))]
    tags += [(339, 3, bands, p("H", *[form] * bands)), (33550, 12, 3, p("d", metres, metres, 0)), (33922, 12, 6, p("d", 0, 0, 0, *origin, 0)), (34735, 3, 8, p("H", 1, 1, 0, 1, 3072, 0, 1, epsg))]
    tags += [(42113, 2, len(str(nodata)) + 1, str(nodata).encode() + b"\0")] if nodata is not None else []
    entries, extra, tail = b"", b"", 8 + len(data) + 2 + 12 * len(tags) + 4
    for tag, kind, count, value in tags:
        if len(value) > 4:
            value, extra = p("I", tail + len(extra)), extra + value + b"\0" * (len(value) % 2)
        entries += struct.pack(f"{order}HHI", tag, kind, count) + value.ljust(4, b"\0")
    head = (b"II" if order == "<" else b"MM") + p("H", 42) + p("I", 8 + len(data))
    path.write_bytes(head + data + p("H", len(tags)) + entries + p("I", 0) + extra)
    return str(path)


def picture(path, level=0):
    """(bands, rows, columns) of a file."""
    with open(path, "rb") as f:
        i = tiff.images(f)[level]
        out = np.zeros((i.bands, i.height, i.width), np.dtype(i.dtype).newbyteorder("="))
        for b in range(i.bands):
            for r in range(i.down):
                for c in range(i.across):
                    part = tiff.tile_of(f, i, r, c, b)
                    out[b, r * i.tile_height : r * i.tile_height + part.shape[0], c * i.tile_width : c * i.tile_width + part.shape[1]] = part
    return out


@pytest.mark.parametrize("form", [{}, {"order": ">"}, {"predictor": 2}, {"planes": 2}, {"packed": False, "planes": 2}])
@pytest.mark.parametrize("dtype", ["u1", "u2", "i2"])
def test_layouts_are_read(tmp_path, form, dtype):
    array = np.random.default_rng(1).integers(0, 120, (3, 37, 50)).astype(dtype)
    at = classic(tmp_path / "a.tif", array, (1000.0, 2000.0), 10.0, 32734, **form)
    assert np.array_equal(picture(at), array)
    i = tiff.header(at)
    assert (i.left, i.top, i.dx, i.dy, i.epsg) == (1000.0, 2000.0, 10.0, -10.0, 32734)


def test_other_files_are_errors(tmp_path):
    (tmp_path / "no.tif").write_bytes(b"GIF89a" + b"\0" * 20)
    with pytest.raises(ValueError, match="TIFF"):
        tiff.header(str(tmp_path / "no.tif"))


def test_a_window_reads_its_tiles_only(spark, tmp_path, monkeypatch):
    tiff.register(spark)
    array = np.arange(2 * 40 * 70, dtype="u2").reshape(2, 40, 70)
    at = classic(tmp_path / "a.tif", array, (1000.0, 2000.0), 10.0, 32734, nodata=5)
    whole = spark.read.format("tiff").load(at)
    assert whole.count() == array.size and whole.rdd.getNumPartitions() == 15
    near = spark.read.format("tiff").option("window", "20,3,33,17").option("bands", "2").load(at)
    assert near.rdd.getNumPartitions() == 2 * 2  # of 3 by 5 tiles
    got = {(r.row, r.col): (r.value, r.x, r.y, r.band) for r in near.collect()}
    assert got == {(r, c): (float(array[1, r, c]), 1005.0 + 10 * c, 1995.0 - 10 * r, 2) for r in range(3, 18) for c in range(20, 34)}
    assert whole.where("value is null").count() == 1
    assert spark.read.format("tiff").option("window", "900,900,910,910").load(at).count() == 0


def test_rasters_are_written_in_tiles_with_overviews(spark, tmp_path, monkeypatch):
    tiff.register(spark)
    rows = spark.range(70 * 45).select((F.col("id") % 45).cast("int").alias("row"), (F.col("id") / 45).cast("int").alias("col")).where("not (row between 16 and 31 and col between 16 and 31)")
    rows = rows.withColumns({"a": F.col("row") * 3, "b": F.when(F.col("col") == 3, None).otherwise(F.col("col"))})
    at = str(tmp_path / "o" / "w.tif")
    tiff.write_raster(rows, at, tiff.Grid(500.0, 900.0, 70, 45, 10.0, 32734), ("a", "b"), tile=16)
    r, c = np.mgrid[0:45, 0:70]
    want = np.stack([r * 3, np.where(c == 3, 255, c)])
    want[:, 16:32, 16:32] = 255
    with open(at, "rb") as f:
        levels = tiff.images(f)
    assert [(i.width, i.height) for i in levels] == [(70, 45), (35, 23), (18, 12), (9, 6)] and levels[0].epsg == 32734 and levels[2].dx == 40.0
    assert levels[0].sizes[1 * 5 + 1] == 0  # a tile without a row
    for k in range(4):
        assert np.array_equal(picture(at, k), want[:, :: 2**k, :: 2**k])
    assert struct.unpack("<H", open(at, "rb").read(4)[2:])[0] == 43
    # a stop leaves what stood there, and nothing beside it
    before = open(at, "rb").read()
    broken = rows.withColumn("a", F.when(F.col("row") == 44, F.raise_error(F.lit("stopped"))).otherwise(F.col("a")))
    with pytest.raises(Exception, match="stopped"):
        tiff.write_raster(broken, at, tiff.Grid(500.0, 900.0, 70, 45, 10.0, 32734), ("a", "b"), tile=16)
    assert open(at, "rb").read() == before and [p.name for p in (tmp_path / "o").iterdir()] == ["w.tif"]


def land(tmp_path, spark):
    """Two scenes of 100 by 100 pixels of 10 m in two bands, with classes in pixels of 20 m, as files and as rows."""
    rng = np.random.default_rng(2)
    assets, rows = [], []
    for s in (1, 2):
        scl = rng.choice([4, 4, 4, 8], (50, 50)).astype("u1")
        assets.append((s, 32734, "SCL", classic(tmp_path / f"{s}_SCL.tif", scl[None], (300000.0, 6240000.0), 20.0, 32734, tile=16)))
        for band in ("B02", "B03"):
            v = rng.integers(1, 9000, (100, 100)).astype("u2")
            v[rng.random((100, 100)) < 0.02] = 0
            assets.append((s, 32734, band, classic(tmp_path / f"{s}_{band}.tif", v[None], (300000.0, 6240000.0), 10.0, 32734, nodata=0, predictor=2, tile=16)))
            rows += [(s, 32734, band, 300005.0 + 10 * c, 6239995.0 - 10 * r, float(v[r, c]), int(scl[r // 2, c // 2])) for r in range(100) for c in range(100) if v[r, c]]
    return spark.createDataFrame(assets, "scene int, epsg int, band string, path string"), spark.createDataFrame(rows, "scene int, epsg int, band string, x double, y double, value double, scl int")


def test_scenes_are_read_by_cells(spark, tmp_path):
    assets, rows = land(tmp_path, spark)
    box = spark.createDataFrame([(1, 32734, 300100.0, 6239500.0, 300300.0, 6239700.0)], "scene int, epsg int, x0 double, y0 double, x1 double, y1 double")
    got = {tuple(r) for r in tiff.scene_pixels(assets, box, cell=320.0).collect()}
    inside = rows.where("scene = 1 and floor(x / 320) between floor(300100 / 320) and floor(300300 / 320) and floor(y / 320) between floor(6239500 / 320) and floor(6239700 / 320)")
    assert got == {tuple(r) for r in inside.collect()} and got
    every = tiff.scene_tiles(assets, 320.0).select("path", "trow", "tcol").distinct().count()
    assert every == 2 * (16 + 2 * 49)
    asked = tiff.scene_tiles(assets, 320.0).where("scene = 1 and cx between floor(300100 / 320) and floor(300300 / 320) and cy between floor(6239500 / 320) and floor(6239700 / 320)").select("path", "trow", "tcol").distinct().count()
    assert asked < every / 3


def test_chips_of_rasters_are_those_of_rows(spark, tmp_path):
    from terrafold.functions import geo

    assets, rows = land(tmp_path, spark)
    catalog = spark.createDataFrame([(s, "2023-02-0%d" % s, 5.0, 17.0, 20.0, -35.0, -33.0) for s in (1, 2)], "scene int, day string, cloud double, s_minx double, s_maxx double, s_miny double, s_maxy double").withColumn("day", F.to_date("day"))
    places = geo.apply(spark.createDataFrame([("a", 300405.0, 6239595.0), ("b", 300505.0, 6239495.0)], "obs_id string, sx double, sy double"), geo.utm_inverse("sx", "sy", 34))
    wanted = places.select("obs_id", F.lit("feb").alias("month_label"), F.to_date(F.lit("2023-02-01")).alias("win_start"), F.to_date(F.lit("2023-02-28")).alias("win_end"), "lon", "lat", F.lit("g").alias("grp"), F.lit(32734).alias("epsg"), *[F.lit(v).alias(n) for n, v in (("minx", 18.0), ("maxx", 19.0), ("miny", -34.5), ("maxy", -33.5))])
    c = campaign.Campaign("unused", {}, size=32, bands=("B02", "B03"))
    known = lambda chip: [None if v != v else v for v in chip]
    one, other = ({r.obs_id: (r.status, r.valid_frac, known(r.chip)) for r in campaign.extract(wanted, catalog, p, c).collect()} for p in (rows, assets))
    assert one == other and {v[0] for v in one.values()} == {"ok"}


def score(stacks):
    v = stacks.reshape(len(stacks), -1, *stacks.shape[3:])
    p = np.stack([v.mean(axis=1), v.max(axis=1), 1 - v.min(axis=1)], axis=-1) / 3
    return p, v.std(axis=1)


@pytest.mark.parametrize(("width", "height"), [(100, 100), (37, 90), (5, 3), (1, 20)])
def test_a_map_is_the_same_in_tiles(spark, tmp_path, width, height):
    """Tiles of two windows on a side, one tile, and one whole raster that is padded in the task."""
    assets, rows = land(tmp_path, spark)
    catalog = spark.createDataFrame([(s, "2023-02-0%d" % s, 5.0, 17.0, 20.0, -35.0, -33.0) for s in (1, 2)], "scene int, day string, cloud double, s_minx double, s_maxx double, s_miny double, s_maxy double").withColumn("day", F.to_date("day"))
    box, months = inference.Box(34, True, 300000.0, 6240000.0, width, height), [("feb", "2023-02-01", "2023-02-28"), ("may", "2023-05-01", "2023-05-28")]

    def mapped(pixels, side):
        tiles = inference.composite(pixels, catalog, (18.0, -34.5, 19.0, -33.5), box, months, ["B02", "B03"], size=16, side=side)
        found = inference.blend_map(inference.predict_windows(tiles, score, size=16, views=2), [3, 5, 9])
        return sorted(map(tuple, found.collect()))

    small, large = mapped(rows, 2), mapped(rows, 100)
    assert small == large and len(small) == width * height
    if width == 37:
        assert mapped(assets, 2) == small
    data = np.full((2, 2, height, width), np.nan, np.float32)
    medians = rows.where("scl = 4").groupBy("band", "x", "y").agg(F.median("value").alias("v")).collect()
    for r in medians:
        y, x = int((6240000 - r.y) // 10), int((r.x - 300000) // 10)
        if y < height and x < width:
            data[0, int(r.band[-1]) - 2, y, x] = r.v
    if width > 8 and height > 8:  # as wide as the padding at least
        whole = spark.createDataFrame([("box", height, width, 2, 2, data.ravel().tolist())], "tile string, height int, width int, months int, bands int, data array<float>")
        assert sorted(map(tuple, inference.blend_map(inference.predict_windows(whole, score, size=16, views=2), [3, 5, 9]).collect())) == small
