"""The verbs end to end, from a store to chips, a split, a head and a map."""

import datetime as dt
import json

import numpy as np
import pytest

from terrafold import cli
from terrafold.functions import geo
from terrafold.operators import campaign, inference
from terrafold.operators.head import Head
from terrafold.schema import OBSERVATION
from terrafold.sources import sinks
from terrafold.sources.store import Store

from tests.test_tiff import picture

BANDS = ["B02", "B03"]


@pytest.fixture(scope="module")
def land(spark, tmp_path_factory):
    """A store of points over a scene of 100 by 100 pixels, and the files that the verbs read."""
    at = tmp_path_factory.mktemp("land")
    x0, y0, n = 300000.0, 6240000.0, 100
    rng = np.random.default_rng(0)
    value = np.where(np.arange(n)[None, :] < n // 2, 1000.0, 5000.0) + rng.integers(0, 50, (n, n))
    rows = [(s, 32734, b, x0 + 10 * c + 5, y0 - 10 * r - 5, float(value[r, c] + k), 4) for s in ("f", "m") for k, b in enumerate(BANDS) for r in range(n) for c in range(n)]
    spark.createDataFrame(rows, "scene string, epsg int, band string, x double, y double, value double, scl int").write.parquet(str(at / "pixels"))
    scenes = [("f", dt.date(2023, 2, 5), 1.0, 18.0, 20.0, -35.0, -33.0), ("m", dt.date(2023, 5, 5), 1.0, 18.0, 20.0, -35.0, -33.0)]
    spark.createDataFrame(scenes, "scene string, day date, cloud double, s_minx double, s_maxx double, s_miny double, s_maxy double").write.parquet(str(at / "scenes"))
    corner = spark.createDataFrame([(f"p{i}", x0 + 400 + 25 * i, y0 - 500.0) for i in range(6)] + [("ne", x0 + 10.0 * n, y0), ("sw", x0, y0 - 10.0 * n)], "obs_id string, x double, y double")
    where = {r.obs_id: (r.lon, r.lat) for r in geo.apply(corner, geo.utm_inverse("x", "y", 34)).collect()}
    blank = {k: None for k in OBSERVATION.names} | {"source": "sanlc", "source_record_id": "1", "geom_type": "point", "weight": 1.0, "ingested_at": dt.datetime(2024, 1, 1), "ingest_run_id": "r", "event_date": "2023-06-01"}
    seen = [blank | {"obs_id": o, "species_normalized": ("Pinus", "Salix")[i % 2], "aoi_admin1": "western_cape", "lon": where[o][0], "lat": where[o][1]} for i, o in enumerate(f"p{i}" for i in range(6))]
    seen.append(seen[0] | {"obs_id": "poly", "geom_type": "polygon"})
    Store(spark, str(at / "store")).upsert(spark.createDataFrame(seen, OBSERVATION), "sanlc_accuracy_points")
    ring = [[18.0, -35.0], [20.0, -35.0], [20.0, -33.0], [18.0, -33.0], [18.0, -35.0]]
    (at / "aoi.geojson").write_text(json.dumps({"features": [{"properties": {}, "geometry": {"type": "Polygon", "coordinates": [ring]}}]}))
    months = [{"start": "2023-02-01", "end": "2023-02-28", "label": "feb"}, {"start": "2023-05-01", "end": "2023-05-31", "label": "may"}]
    (at / "pipeline.yaml").write_text(json.dumps({"months": months, "months_by_zone": {"wet": months}, "admin1_zone": {"western_cape": "wet"}, "s2_bands": BANDS}))  # JSON is YAML
    return at, where, value


def call(spark, *args):
    a = cli.parser().parse_args([str(x) for x in args])
    return a.run(spark, a)


def test_labels_chips_and_split(spark, land, capsys):
    at, _, _ = land
    common = ("--root", at / "store", "--aoi", at / "aoi.geojson")
    assert call(spark, "labels", *common).count() == 7
    assert [r.n for r in spark.read.parquet(str(at / "store" / "summary.parquet")).collect()] == [7]
    ingest = ("ingest-chips", *common, "--pipeline", at / "pipeline.yaml", "--out-prefix", at / "train", "--block-km", 50, "--thin-m", 20)
    assert call(spark, *ingest).count() == 12  # the plan: six points, two months
    with pytest.raises(ValueError, match="together"):
        call(spark, *ingest, "--scenes", at / "scenes")
    made = call(spark, *ingest, "--scenes", at / "scenes", "--pixels", at / "pixels")
    assert made.count() == 12 and call(spark, *ingest).count() == 0
    chip = campaign.read_chips(spark, str(at / "train")).first()
    assert len(chip.chip) == len(BANDS) * 64 * 64 and chip.valid_frac == 1
    split = ("make-split", "--manifest", at / "train" / "manifest.parquet", "--out-prefix", at / "train")
    first = {r.obs_id: r.fold for r in call(spark, *split).collect()}
    assert len(first) == 6 and "TOTAL" in capsys.readouterr().out
    assert {r.obs_id: r.fold for r in spark.read.parquet(str(at / "train" / "split.parquet")).collect()} == first
    # folds are locked: another seed and other shares change nothing, until the lock is off
    folds = str(at / "train" / "block_folds.parquet")
    sinks.save_folds(spark.createDataFrame([(b, "val") for b in sinks.load_folds(spark, folds)] + [(999, "test")], "block_id int, fold string"), folds)
    assert set(r.fold for r in call(spark, *split, "--seed", 1).collect()) == {"val"}
    assert sinks.load_folds(spark, folds)[999] == "test"
    call(spark, *split, "--no-lock-folds", "--train-frac", 1.0, "--val-frac", 0.0)
    assert 999 not in sinks.load_folds(spark, folds)


def test_a_province_without_a_zone_stops_the_run(spark, land, tmp_path):
    at, _, _ = land
    cfg = json.loads((at / "pipeline.yaml").read_text()) | {"admin1_zone": {"limpopo": "wet"}}
    (tmp_path / "p.yaml").write_text(json.dumps(cfg))
    with pytest.raises(Exception, match="rainfall zone"):
        call(spark, "ingest-chips", "--root", at / "store", "--aoi", at / "aoi.geojson", "--pipeline", tmp_path / "p.yaml", "--out-prefix", tmp_path).collect()


def test_box_to_raster(spark, land, tmp_path):
    at, where, value = land
    k = 2 * len(BANDS)
    head = Head([3, 8], np.full(k, 0.3), np.full(k, 0.1), [(np.array([[-5.0, 5.0]] * k), np.zeros(2))], np.zeros((2, k)), np.eye(k), 1e6)
    (tmp_path / "h.json").write_text(json.dumps(head.to_row()))
    (west, south), (east, north) = where["sw"], where["ne"]
    bbox = f"--bbox={west + 1e-3},{south + 1e-3},{east - 1e-3},{north - 1e-3}"
    args = ("infer", "--ckpt", tmp_path / "h.json", bbox, "--pipeline", at / "pipeline.yaml", "--scenes", at / "scenes", "--pixels", at / "pixels")
    box = inference.box_of(spark, cli.parse_bbox(bbox[7:]))
    assert (box.zone, box.epsg) == (34, 32734) and box.width < 100 and box.height < 100
    rows = call(spark, *args, "--native", "--raster", tmp_path / "n.tif").collect()
    left, down = int((box.x0 - 300000) / 10), int((6240000 - box.y0) / 10)
    assert len(rows) == box.width * box.height
    assert all(r.class_id == (3 if r.col + left < 50 else 8) for r in rows)
    shown = picture(tmp_path / "n.tif")
    assert shown.shape == (3, box.height, box.width) and set(np.unique(shown[0])) == {3, 8}
    # in Albers the box leans, so that corners have no data and the rest keeps its two halves
    call(spark, *args, "--raster", tmp_path / "a.tif")
    turned = picture(tmp_path / "a.tif")[0]
    counts = dict(zip(*np.unique(turned, return_counts=True), strict=True))
    assert set(counts) == {3, 8, 255}
    assert counts[3] + counts[8] == pytest.approx(len(rows), rel=0.02) and counts[3] == pytest.approx(sum(r.class_id == 3 for r in rows), rel=0.04)
    assert down >= 0
    with pytest.raises(ValueError, match="composites"):
        call(spark, "infer", "--ckpt", tmp_path / "h.json")
