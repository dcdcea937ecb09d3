"""A writer that stops at any point loses no stored row, and a replay gives what an undisturbed run gives."""

import datetime as dt

import pytest

from terrafold.schema import MANIFEST, OBSERVATION
from terrafold.sources import sinks
from terrafold.sources.store import Store
from terrafold.sources.swap import Swap
from terrafold.sources.versions import Versions
from terrafold.streaming.upsert import upsert_stream
from tests.test_engine import T0, observation, observations

DATASET = "mapwaps_tugela"


class Stopped(Exception):
    pass


def stop_after(monkeypatch, moves):
    """The writer stops right after so many moves and removals."""
    done = {"n": 0}

    def counted(method):
        def call(self, *args):
            if done["n"] == moves:
                raise Stopped
            done["n"] += 1
            return method(self, *args)

        return call

    monkeypatch.setattr(Swap, "move", counted(Swap.move))
    monkeypatch.setattr(Swap, "remove", counted(Swap.remove))


def rows_of(store):
    return sorted((r.obs_id, r.species) for r in store.read().collect())


STEPS = ("files", "write_list", "publish")


def stop_at(monkeypatch, step):
    """The writer stops where it would take that step."""

    def call(self, *args):
        raise Stopped

    monkeypatch.setattr(Versions, step, call)


@pytest.mark.parametrize("step", STEPS)
def test_upsert_stopped_between_any_two_steps(spark, tmp_path, monkeypatch, step):
    store = Store(spark, str(tmp_path))
    old = observations(spark, [observation("a", species="old"), observation("b", species="old")])
    new = observations(spark, [observation("b", T0 + dt.timedelta(days=1), species="new"), observation("c", species="new")])
    store.upsert(old, DATASET)
    with monkeypatch.context() as m:
        stop_at(m, step)
        with pytest.raises(Stopped):
            store.upsert(new, DATASET)
    assert rows_of(store) == [("a", "old"), ("b", "old")]  # readers never miss rows
    for _ in range(2):
        store.upsert(new, DATASET)
        assert rows_of(store) == [("a", "old"), ("b", "new"), ("c", "new")]
    named = {f.path for f in store.versions(DATASET).files(store.versions(DATASET).newest())}
    assert store.vacuum(DATASET, keep=1, hours=24) == []  # all of it is young
    store.vacuum(DATASET, keep=1, hours=-1)
    left = {str(p.relative_to(tmp_path / f"dataset={DATASET}")) for p in (tmp_path / f"dataset={DATASET}" / "data").rglob("*.parquet")}
    assert left == named and rows_of(store) == [("a", "old"), ("b", "new"), ("c", "new")]


@pytest.mark.parametrize("step", STEPS)
def test_stream_stopped_and_started_again(spark, tmp_path, monkeypatch, step):
    rows = [observation(f"o:{i % 5}", T0 + dt.timedelta(hours=i), species=str(i)) for i in range(20)]
    store = Store(spark, str(tmp_path / "store"))
    store.upsert(observations(spark, [observation("kept", species="k")]), DATASET)
    observations(spark, rows).coalesce(1).write.parquet(str(tmp_path / "in"))

    def run():
        stream = spark.readStream.schema(OBSERVATION).parquet(str(tmp_path / "in"))
        upsert_stream(stream, store, DATASET, str(tmp_path / "cp")).awaitTermination()

    with monkeypatch.context() as m:
        stop_at(m, step)
        with pytest.raises(Exception, match="Stopped"):
            run()
    run()
    assert rows_of(store) == [("kept", "k"), *((f"o:{i}", str(15 + i)) for i in range(5))]


def test_an_upsert_rewrites_the_files_it_touches(spark, tmp_path):
    store = Store(spark, str(tmp_path), file_rows=20)
    log = store.versions(DATASET)
    store.upsert(observations(spark, [observation(f"k{i:04}", species="old") for i in range(400)]), DATASET)
    before = {f.path: f for f in log.files(1)}
    assert len(before) >= 15
    spans = sorted((f.least, f.greatest) for f in before.values())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
    batch = [observation(k, T0 + dt.timedelta(days=1), species="new") for k in ("k0200", "k0201", "k0200x", "a-before-all", None)]
    store.upsert(observations(spark, batch), DATASET)
    after = {f.path for f in log.files(2)}
    rewritten = [f for p, f in before.items() if p not in after]
    holders = [f for f in before.values() if f.least <= "k0201" <= f.greatest or f.least <= "k0200" <= f.greatest or f.least == "k0000"]
    assert {f.path for f in rewritten} == {f.path for f in holders}
    got = {r.obs_id: r.species for r in store.read().collect()}
    assert len(got) == 403 and {k for k, v in got.items() if v == "new"} == {"k0200", "k0201", "k0200x", "a-before-all", None}
    spans = sorted((f.least or "", f.greatest) for f in log.files(2))
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
    store.upsert(observations(spark, [observation("k0399z", species="last")]), DATASET)
    assert store.read().count() == 404


def test_of_two_writers_the_later_merges_with_the_other(spark, tmp_path, monkeypatch):
    store, publish, once = Store(spark, str(tmp_path)), Versions.publish, []
    store.upsert(observations(spark, [observation("a", species="old")]), DATASET)

    def other_first(self, version, name):
        if not once:
            once.append(version)
            store.upsert(observations(spark, [observation("a", T0 + dt.timedelta(days=2), species="other"), observation("b", species="other")]), DATASET)
            assert not publish(self, version, name)
            return False
        return publish(self, version, name)

    with monkeypatch.context() as m:
        m.setattr(Versions, "publish", other_first)
        store.upsert(observations(spark, [observation("a", T0 + dt.timedelta(days=1), species="mine"), observation("c", species="mine")]), DATASET)
    assert rows_of(store) == [("a", "other"), ("b", "other"), ("c", "mine")] and store.versions(DATASET).numbers() == [1, 2, 3]


def test_a_folder_of_plain_files_is_taken_over(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    observations(spark, [observation("a", species="old"), observation("b", species="old")]).write.parquet(store.partition(DATASET))
    assert rows_of(store) == [("a", "old"), ("b", "old")]
    store.upsert(observations(spark, [observation("b", T0 + dt.timedelta(days=1), species="new")]), DATASET)
    assert rows_of(store) == [("a", "old"), ("b", "new")]


def test_a_box_leaves_files_out(spark, tmp_path):
    store = Store(spark, str(tmp_path), file_rows=10)
    store.upsert(observations(spark, [observation(f"k{i:03}", lon=18.0 + i / 10) for i in range(100)]), DATASET)
    near = store.read(bbox=(18.0, -90.0, 18.45, 90.0))
    assert near.count() == 5 and len(near.inputFiles()) < len(store.read().inputFiles()) / 3


@pytest.mark.parametrize("moves", range(4))
def test_consolidation_stopped_between_any_two_steps(spark, tmp_path, monkeypatch, moves):
    def chip(obs, uri):
        return (obs, "Pinus", "feb", uri, 2023, 1, 18.0, -33.0, 0.9)

    at = str(tmp_path)
    sinks.append_shard(spark.createDataFrame([chip("a", "1"), chip("b", "2")], MANIFEST), at)
    sinks.consolidate_shards(spark, at)
    sinks.append_shard(spark.createDataFrame([chip("b", "3"), chip("c", "4")], MANIFEST), at)
    with monkeypatch.context() as m:
        stop_after(m, moves)
        with pytest.raises(Stopped):
            sinks.consolidate_shards(spark, at)
    assert {r.obs_id for r in sinks.read_manifest(spark, at).collect()} >= {"a", "b"}
    assert sorted((r.obs_id, r.chip_uri) for r in sinks.consolidate_shards(spark, at).collect()) == [("a", "1"), ("b", "3"), ("c", "4")]


def test_a_move_that_fails_is_an_error(spark, tmp_path):
    swap = Swap(spark, str(tmp_path / "at"), str(tmp_path / "fresh"), str(tmp_path / "old"))
    with pytest.raises(Exception, match="fresh"):
        swap.commit()
