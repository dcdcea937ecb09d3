"""Chip extraction, map inference and the command line."""

import argparse

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafold import cli
from terrafold.functions import geo
from terrafold.operators import chips, inference


def test_chips_are_medians_of_clear_pixels(spark):
    rng = np.random.default_rng(0)
    rows = [("feb", s, b, c, r, float(rng.integers(1, 99)), int(rng.choice([4, 4, 4, 8]))) for s in range(3) for b in ("B02", "B03") for r in range(12) for c in range(12)]
    pixels = spark.createDataFrame(rows, "month_label string, scene int, band string, col long, row long, value double, scl int")
    points = spark.createDataFrame([("a", "feb", 65.0, 55.0), ("b", "feb", 5.0, 55.0), ("c", "may", 65.0, 55.0)], "obs_id string, month_label string, x double, y double")
    got = {r.obs_id: r for r in chips.extract(points, pixels, 0.0, 120.0, 10.0, -10.0, 12, 12, size=4, least=0.1).collect()}
    assert (got["a"].status, got["b"].status, got["c"].status) == ("ok", "oob", "no_scene_overlap")
    cube = np.full((3, 2, 12, 12), np.nan)
    for _, s, b, c, r, v, scl in rows:
        cube[s, ("B02", "B03").index(b), r, c] = v if scl == 4 else np.nan
    with np.errstate(all="ignore"):
        want = np.nanmedian(cube, axis=0)[:, 4:8, 4:8]
    assert np.allclose(np.array(got["a"].chip).reshape(2, 4, 4), want, equal_nan=True)
    assert got["a"].valid_frac == pytest.approx(np.isfinite(want).all(axis=0).mean())


def joined_rows(node):
    """Rows that each join of a plan that has run gave."""
    name, metrics = node.nodeName(), node.metrics()
    below = [node.executedPlan()] if name.startswith("Adaptive") else [node.plan()] if "QueryStage" in name else [node.children().apply(i) for i in range(node.children().size())]
    own = [metrics.apply("numOutputRows").value()] if "Join" in name else []
    return own + [n for b in below for n in joined_rows(b)]


def test_points_on_one_pixel_share_their_window(spark):
    rows = [("feb", s, b, c, r, float(7 * s + c + r), 4) for s in range(3) for b in ("B02", "B03") for r in range(12) for c in range(12)]
    pixels = spark.createDataFrame(rows, "month_label string, scene int, band string, col long, row long, value double, scl int")
    points = spark.createDataFrame([(f"a{i}", "feb", 65.0, 55.0) for i in range(40)] + [("b", "feb", 25.0, 75.0), ("n", None, 65.0, 55.0)], "obs_id string, month_label string, x double, y double")
    df = chips.extract(points, pixels, 0.0, 120.0, 10.0, -10.0, 12, 12, size=4, least=0.1)
    got = {r.obs_id: r for r in df.collect()}
    assert len(got) == 42 and got["n"].status == "no_scene_overlap"
    for name, c0, r0 in [(f"a{i}", 4, 4) for i in range(40)] + [("b", 0, 2)]:
        assert got[name].valid_frac == 1.0 and got[name].chip == [7.0 + c + r for _ in range(2) for r in range(r0, r0 + 4) for c in range(c0, c0 + 4)]
    found = joined_rows(df._jdf.queryExecution().executedPlan())
    assert found and max(found) <= len(rows)  # each pixel once, not once a point


def test_constant_scores_blend_to_themselves(spark):
    data = np.arange(2 * 3 * 20 * 30, dtype=float).ravel().tolist()
    tile = spark.createDataFrame([("t", 20, 30, 2, 3, data)], "tile string, height int, width int, months int, bands int, data array<double>")

    def score(x):
        n, size = len(x), x.shape[-1]
        return np.tile([0.2, 0.7, 0.1], (n, size, size, 1)), np.full((n, size, size), 0.5)

    for views in (1, 8):
        out = inference.blend_map(inference.predict_windows(tile, score, size=16, views=views), [3, 5, 9]).toPandas()
        assert len(out) == 600 and set(out.class_id) == {5} and set(out.confidence) <= {69, 70} and set(out.ood) <= {49, 50}


def test_views_are_undone(spark):
    tile = spark.createDataFrame([("t", 16, 16, 1, 1, np.arange(256, dtype=float).ravel().tolist())], "tile string, height int, width int, months int, bands int, data array<double>")

    def score(x):
        return np.stack([x[:, 0, 0], 1 - x[:, 0, 0]], axis=-1), x[:, 0, 0]

    one, eight = (inference.predict_windows(tile, score, 16, v).groupBy("y", "x").agg((F.sum("o") / F.sum("w")).alias("o")).orderBy("y", "x").toPandas().o for v in (1, 8))
    assert np.allclose(one, eight) and np.allclose(one * 10000, np.arange(256), atol=0.5)


def test_warp_takes_the_nearest_pixel(spark):
    source = spark.range(400).select((F.col("id") / 20).cast("int").alias("y"), (F.col("id") % 20).cast("int").alias("x"), F.col("id").cast("int").alias("class_id"), F.lit(1).alias("confidence"), F.lit(2).alias("ood"))
    middle = geo.apply(spark.createDataFrame([(300105.0, 6239895.0), (1.0, 1.0)], "sx double, sy double"), geo.utm_inverse("sx", "sy", 34))
    cells = geo.apply(middle, geo.albers("lon", "lat", "ax", "ay")).select("ax", "ay")
    got = sorted(r.class_id for r in inference.warp(cells, source, 34, 300000.0, 6240000.0, 10.0, -10.0).collect())
    assert got == [10 * 20 + 10, 255]


def test_command_line(spark, tmp_path, capsys):
    assert cli.parse_bbox("18,-34,19,-33") == (18, -34, 19, -33)
    for bad in ("18,-34,19", "a,b,c,d", "19,-34,18,-33", "18,-33,19,-34", ""):
        with pytest.raises(argparse.ArgumentTypeError):
            cli.parse_bbox(bad)
    rows = [(f"o{i % 6}", "Pinus radiata" if i % 2 else "Salix alba", m, f"u{i}", 2023, i % 3, 19.0 + i / 100, -32.0, 0.9) for i in range(24) for m in [("jan", "apr", "aug", "oct")[i // 6]]]
    spark.createDataFrame(rows, "obs_id string, species string, month_label string, chip_uri string, year int, block_id int, lon double, lat double, valid_frac double").write.parquet(str(tmp_path / "m"))
    a = cli.parser().parse_args(["chips-stats", "--manifest", str(tmp_path / "m")])
    assert a.run(spark, a).columns == ["long_tail", "share_top_10", "share_top_30"]
    assert "Pinus radiata" in capsys.readouterr().out
    a = cli.parser().parse_args(["make-split", "--manifest", str(tmp_path / "m")])
    assert set(a.run(spark, a).toPandas().fold) <= {"train", "val", "test"}
    (tmp_path / "p.geojson").write_text('{"features": [{"properties": {"shapeName": "Western Cape"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[18,-34],[19,-34],[19,-33],[18,-34]]], [[[37,-46],[38,-46],[38,-47],[37,-46]]]]}}]}')
    a = cli.parser().parse_args(["aoi-wc", "--source", str(tmp_path / "p.geojson")])
    assert a.run(spark, a).count() == 1
    a = cli.parser().parse_args(["aoi-wc", "--source", str(tmp_path / "p.geojson"), "--provinces", "Elsewhere"])
    with pytest.raises(ValueError, match="elsewhere"):
        a.run(spark, a)
