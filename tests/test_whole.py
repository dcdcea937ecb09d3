"""Queries that take every row of their tables."""

import inspect
import os

import pytest

from terrafold.operators import adapters, head, spatial
from terrafold.plans import catalog, registry

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


def test_every_part_is_blended(spark):
    parts = spark.read.parquet(f"{DIR}/part.parquet").select("p_partkey").distinct().count()
    got = registry.QUERIES["taper_blend"](spark, DIR)
    assert got.select("id").distinct().count() == parts and got.count() == parts * 112


def test_every_observation_has_a_side(spark, monkeypatch):
    """Points and known rows of both anti-joins are all of obs; the known side is dense."""
    total = catalog.view(spark, DIR, "obs").count()
    sides, away = [], spatial.away_from

    def spy(points, others, *rest):
        sides.append((points.count(), others.count()))
        return away(points, others, *rest)

    monkeypatch.setattr(spatial, "away_from", spy)
    monkeypatch.setattr(adapters, "sanlc", lambda points, biomes, store: sides.append((points.count(), store.count())) or store.selectExpr("obs_id", "'' AS species", "taxon_rank", "event_date"))
    registry.QUERIES["iap_anti_distance"](spark, DIR)
    registry.QUERIES["sanlc_rows"](spark, DIR)
    assert [a + b for a, b in sides] == [total, total] and all(b > total / 2 for _, b in sides)


def test_head_is_fitted_to_its_end(spark, monkeypatch):
    """The early stop, not a count of epochs that it can't reach, ends the fit."""
    asked, train = [], head.train

    def spy(*a, **b):
        asked.append(inspect.signature(train).bind(*a, **b))
        asked[-1].apply_defaults()
        return train(*a, **b)

    monkeypatch.setattr(head, "train", spy)
    assert registry.QUERIES["train_head"](spark, DIR).count() == catalog.view(spark, DIR, "labelled").where("fold = 'test'").count()
    assert [(x.arguments["epochs"], x.arguments["patience"]) for x in asked] == [(500, 60)]
