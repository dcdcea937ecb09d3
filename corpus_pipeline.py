"""A corpus pipeline of five stages. Each takes (spark, docs, sf_dir) and works on all of `docs`.

Rows without a text, or without a letter in it, go in the first stage, as they have no language. Rows without an id
are kept by the second, since they belong to no group; rows that repeat an id are one document, of which one row stays
(the smallest text) if one of its texts represents its group; a null source or language is a source like others.
Mixing repeats a document once for each turn that takes it; a document between two shards, or at the end of its source's
quota, is cut into the words of each. Very long texts are read whole by every stage. Columns beside those of documents
are carried along whatever their names, but for the last stage, which returns its own. Empty input gives empty output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrafold.llm import decontaminate, langid, mixing, near_join, sharding
from terrafold.llm.common import aside, keep, restored
from terrafold.shipping import ship

MIN_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose best language isn't likelier than all others together, go."""
    ship(spark)
    slim, others = aside(docs, "text")
    found = langid.identify(slim, docs.where("lang is not null and text is not null"))
    back = dict(zip(others, restored(others), strict=True))
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE)).select(*[back[c] if c in back else F.col(c) for c in docs.columns])


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id stays."""
    ship(spark)
    stays = near_join.near_join(docs).where("doc_id = component_id").select("doc_id").distinct()
    known, others = aside(docs, "doc_id", "text")
    one = Window.partitionBy("doc_id").orderBy("text")
    first = known.where("doc_id is not null").join(stays, "doc_id", "left_semi").withColumn("row", F.row_number().over(one)).where("row = 1").drop("row")
    back = dict(zip(others, restored(others), strict=True))
    return first.unionByName(known.where("doc_id is null")).select(*[back[c] if c in back else F.col(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    ship(spark)
    slim, others = aside(docs, "text")
    found = decontaminate.decontaminate(slim, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    back = dict(zip(others, restored(others), strict=True))
    return found.where("n_hit = 0").select(*[back[c] if c in back else F.col(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a row for each piece that the tree gave a shard, shuffled within the shards."""
    ship(spark)
    slim, others = aside(docs, "doc_id", "text", "source")
    out, back = mixing.lay_out(mixing.mix(slim)), dict(zip(others, restored(others), strict=True))
    if "n_chars" in back:
        back["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return out.select(*[back[c] if c in back else F.col(c) for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each row goes."""
    ship(spark)
    return sharding.shard(docs).select("doc_id", "size", "tokens", "text_crc32", "shard", "slot")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("mix", mix),
    ("shard", shard),
]

#: SQL can't express the language model; the stages are tested one by one instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES):
            docs = keep(docs)
    return docs
