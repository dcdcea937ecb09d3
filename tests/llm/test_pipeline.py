import random

import pytest

P = pytest.importorskip("corpus_pipeline")

from tests.llm.odd import ODD, documents  # noqa: E402


def test_stages_keep_their_promises(spark, tmp_path):
    if not __import__("os").path.exists(__import__("terrafold.llm.langid", fromlist=["x"]).VOCABULARY):
        pytest.skip("no vocabulary here")
    rng = random.Random(8)
    item = " ".join(f"q{k}" for k in range(25))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    text = [" ".join(f"w{rng.randrange(500)}" for _ in range(80)) for _ in range(40)]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(text)]
    rows += [(100, text[3] + " more", "en", "s0"), (101, text[4].upper(), "en", "s1"), (102, "x " + item + " y", "en", "s0"), (103, "123 !!", "en", "s0"), *ODD]
    docs = documents(spark, rows)
    columns = docs.columns
    assert len(P.STAGES) in (4, 5)
    seen = {}
    for name, stage in P.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "shard":
            assert docs.columns == columns
        seen[name] = docs.toPandas()
    ids = {n: set(d.doc_id.dropna()) for n, d in seen.items()}
    assert 103 not in ids["language_id"] and set(range(40)) <= ids["language_id"]
    assert not {100, 101} & ids["ngram_join"] and set(range(40)) <= ids["ngram_join"] and list(seen["ngram_join"].doc_id).count(5) == 1
    assert 102 not in ids["decontamination"] and set(range(40)) <= ids["decontamination"]
    before, after = seen["decontamination"], seen["mix"]
    words = before.text.str.split().str.len().sum()
    assert abs(after.text.str.split().str.len().sum() - 1.5 * words) <= 3
    assert len(seen["shard"]) == len(after)
    for _, g in seen["shard"].groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = documents(spark, [])
    for _, stage in P.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0
