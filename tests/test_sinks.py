import datetime as dt

import numpy as np
import pytest

from terrafold.operators.head import Head
from terrafold.schema import MANIFEST, OBSERVATION
from terrafold.sources import sinks


def chip(obs, month, uri, year=2023):
    return (obs, "Pinus", month, uri, year, 1, 18.0, -33.0, 0.9)


def test_shards_merge_and_go(spark, tmp_path):
    at = str(tmp_path / "chips")
    assert sinks.consolidate_shards(spark, at).count() == 0
    sinks.append_shard(spark.createDataFrame([chip("a", "feb", "1"), chip("a", "may", "2")], MANIFEST), at)
    sinks.append_shard(spark.createDataFrame([], MANIFEST), at)
    assert sorted(r.chip_uri for r in sinks.consolidate_shards(spark, at).collect()) == ["1", "2"]
    sinks.append_shard(spark.createDataFrame([chip("a", "feb", "3"), chip("b", "feb", "4")], MANIFEST), at)
    (tmp_path / "chips" / "shards" / "run=x").mkdir()
    (tmp_path / "chips" / "shards" / "run=x" / "part-0.parquet").write_bytes(b"broken")
    with pytest.warns(UserWarning, match="part-0.parquet"):
        assert sorted(r.chip_uri for r in sinks.consolidate_shards(spark, at).collect()) == ["2", "3", "4"]
    assert not (tmp_path / "chips" / "shards").exists()
    assert (tmp_path / "chips" / "unreadable" / "run=x_part-0.parquet").read_bytes() == b"broken"
    assert sorted(r.chip_uri for r in sinks.consolidate_shards(spark, at).collect()) == ["2", "3", "4"]


def test_split_folds_summary_and_head(spark, tmp_path):
    split = spark.createDataFrame([("b", "train", 1), ("a", "train", 1), ("a", "train", 1), ("c", "test", 2)], "obs_id string, fold string, class_id int")
    sinks.write_split(split, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s" / "split.parquet")).count() == 3
    lists = {p.name: sorted(x for f in p.glob("*.txt") for x in f.read_text().split()) for p in (tmp_path / "s" / "lists").glob("fold=*")}
    assert lists == {"fold=train": ["a", "b"], "fold=test": ["c"]}
    assert sinks.load_folds(spark, str(tmp_path / "f")) is None
    sinks.save_folds(spark.createDataFrame([(2, "val"), (1, "train")], "block_id int, fold string"), str(tmp_path / "f"))
    assert sinks.load_folds(spark, str(tmp_path / "f")) == {1: "train", 2: "val"}
    row = {n: None for n in OBSERVATION.names} | {"source": "x", "cover_pct": 1.0, "ingested_at": dt.datetime(2024, 1, 1)}
    assert sinks.write_summary(spark.createDataFrame([row, row | {"source": None}], OBSERVATION), str(tmp_path / "y")).count() == 2
    head = Head([1, 4], np.zeros(3), np.ones(3), [(np.arange(6.0).reshape(3, 2), np.ones(2))], np.zeros((2, 3)), np.eye(3), 2.5)
    sinks.save_head(spark, head, str(tmp_path / "h"))
    again = sinks.load_head(spark, str(tmp_path / "h"))
    x = np.random.default_rng(0).normal(size=(5, 3))
    assert again.classes == [1, 4] and again.threshold == 2.5
    assert all(np.allclose(a, b) for a, b in zip(head.probabilities(x), again.probabilities(x), strict=True))
    with pytest.raises(Exception, match="."):
        sinks.load_head(spark, str(tmp_path / "nothing"))
