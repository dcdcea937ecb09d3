"""Chip extraction from labels to the manifest, over scenes made of rows."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafold.functions import geo
from terrafold.operators import campaign
from terrafold.sources import sinks

MONTHS = {"w": [{"start": "2023-02-01", "end": "2023-02-28", "label": "feb"}, {"start": "2023-05-01", "end": "2023-05-31", "label": "may"}], "s": [{"start": "2023-07-01", "end": "2023-07-31", "label": "jul"}]}
LABELS = "obs_id string, species_normalized string, lon double, lat double, year int, zone string, block_id int"
SIZE = 4


@pytest.fixture(scope="module")
def world(spark):
    """A field of 16 by 16 pixels, its scenes of three months and two years, and the middle of three pixels."""
    x0, y0 = 300000.0, 6240000.0
    days = {"f1": dt.date(2023, 2, 10), "f2": dt.date(2023, 2, 20), "m1": dt.date(2022, 5, 5), "j1": dt.date(2023, 7, 7), "cloudy": dt.date(2023, 2, 12), "far": dt.date(2023, 2, 11)}
    catalog = [(s, d, 99.0 if s == "cloudy" else 5.0, 25.0 if s == "far" else 18.0, 26.0 if s == "far" else 20.0, -35.0, -33.0) for s, d in days.items()]
    rng = np.random.default_rng(1)
    cube = {(s, b): rng.integers(1, 999, (16, 16)).astype(float) for s in days for b in ("B02", "B03")}
    pixels = [(s, 32734, b, x0 + 10 * c + 5, y0 - 10 * r - 5, float(v[r, c]), 4) for (s, b), v in cube.items() for r in range(16) for c in range(16)]
    corner = spark.createDataFrame([("a", x0 + 65, y0 - 65), ("b", x0 + 85, y0 - 75), ("c", x0 + 5000, y0 - 5)], "obs_id string, x double, y double")
    where = {r.obs_id: (r.lon, r.lat) for r in geo.apply(corner, geo.utm_inverse("x", "y", 34)).collect()}
    return (
        spark.createDataFrame(catalog, "scene string, day date, cloud double, s_minx double, s_maxx double, s_miny double, s_maxy double"),
        spark.createDataFrame(pixels, "scene string, epsg int, band string, x double, y double, value double, scl int"),
        where,
        cube,
    )


def label(where, obs, year=2023, zone="w", name="Pinus"):
    return (obs, name, *where[obs], year, zone, 7)


def test_run_is_incremental_and_prunes(spark, tmp_path, world):
    catalog, pixels, where, cube = world
    c = campaign.Campaign(str(tmp_path / "train"), MONTHS, size=SIZE)

    def go(rows, **more):
        done = campaign.run(spark.createDataFrame(rows, LABELS), catalog, pixels, c, **more)
        return {(r.obs_id, r.month_label, r.year) for r in done.collect()}

    # a has February; b, of the other calendar, July; c lies off every pixel
    assert go([label(where, "a"), label(where, "b", zone="s"), label(where, "c")]) == {("a", "feb", 2023), ("b", "jul", 2023)}
    chips = {(r.obs_id, r.month_label): r for r in campaign.read_chips(spark, c.prefix).collect()}
    want = np.stack([np.median([cube[s, b] for s in ("f1", "f2")], axis=0)[4:8, 4:8] for b in ("B02", "B03")])
    assert np.allclose(np.array(chips["a", "feb"].chip).reshape(2, SIZE, SIZE), want) and chips["a", "feb"].valid_frac == 1
    runs = set((tmp_path / "train" / "chips").iterdir())
    before = {r.chip_uri for r in sinks.read_manifest(spark, c.prefix).collect()}
    # nothing to do: the same chips, by the same names
    assert go([label(where, "a"), label(where, "b", zone="s")]) == {("a", "feb", 2023), ("b", "jul", 2023)}
    assert {r.chip_uri for r in sinks.read_manifest(spark, c.prefix).collect()} == before
    # b moves to a's calendar, a is gone: July goes, February comes; what a part knows nothing of stays without pruning
    assert go([label(where, "b")], prune=False) == {("a", "feb", 2023), ("b", "jul", 2023), ("b", "feb", 2023)}
    assert go([label(where, "b")]) == {("b", "feb", 2023)}
    left = set((tmp_path / "train" / "chips").iterdir())
    assert len(left) == 1 and not left & runs


def test_the_year_before_is_tried_once(spark, tmp_path, world):
    catalog, pixels, where, _ = world
    only_may = {"w": MONTHS["w"][1:]}
    c = campaign.Campaign(str(tmp_path / "y"), only_may, size=SIZE)
    rows = spark.createDataFrame([label(where, "a", 2023), label(where, "b", 2024)], LABELS)
    # May has a scene in 2022 alone: a year before a's, two before b's
    assert {(r.obs_id, r.year) for r in campaign.run(rows, catalog, pixels, c).collect()} == {("a", 2022)}
    # a's other months are looked for in the year that its chips have
    both = campaign.Campaign(c.prefix, MONTHS, size=SIZE)
    early = catalog.unionByName(catalog.where("scene = 'f1'").withColumn("day", F.lit(dt.date(2022, 2, 9))))
    assert {(r.obs_id, r.month_label, r.year) for r in campaign.run(rows.where("obs_id = 'a'"), early, pixels, both).collect()} == {("a", "may", 2022), ("a", "feb", 2022)}


def test_a_stopped_run_is_taken_up(spark, tmp_path, world, monkeypatch):
    catalog, pixels, where, _ = world
    c = campaign.Campaign(str(tmp_path / "z"), MONTHS, size=SIZE)
    rows = spark.createDataFrame([label(where, "a")], LABELS)
    whole = sinks.append_shard
    monkeypatch.setattr(sinks, "append_shard", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        campaign.run(rows, catalog, pixels, c)
    monkeypatch.setattr(sinks, "append_shard", whole)
    assert campaign.run(rows, catalog, pixels, c).count() == 1
    now, folder = sinks.read_manifest(spark, c.prefix), tmp_path / "z" / "chips"
    # what the stopped run left may be another run's that is yet to name it, until it is old
    assert campaign.read_chips(spark, c.prefix).count() == 1 and len(list(folder.iterdir())) == 2
    assert len(campaign.sweep(spark, c.prefix, now, set(), hours=-1)) == 1 and len(list(folder.iterdir())) == 1
    assert campaign.read_chips(spark, c.prefix).count() == 1


def test_no_labels(spark, tmp_path, world):
    catalog, pixels, _, _ = world
    c = campaign.Campaign(str(tmp_path / "n"), MONTHS, size=SIZE)
    assert campaign.run(spark.createDataFrame([], LABELS), catalog, pixels, c).isEmpty()
