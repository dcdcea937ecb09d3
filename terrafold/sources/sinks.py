"""What leaves the engine: compressed Parquet, split lists, block folds, manifest shards, heads."""

from __future__ import annotations

import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.operators.dedup import one_per
from terrafold.operators.head import Head
from terrafold.operators.manifest import consolidate
from terrafold.operators.stats import source_summary
from terrafold.schema import MANIFEST, MANIFEST_KEY
from terrafold.sources.files import list_parquet
from terrafold.sources.swap import Swap

HEAD = (
    "classes array<int>, mean array<double>, sd array<double>, layers array<struct<w:array<double>,b:array<double>>>, means array<double>, "
    "precision array<double>, threshold double"
)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("compression", "zstd").parquet(path)
    return path


def write_summary(store: DataFrame, path: str) -> DataFrame:
    write_parquet(source_summary(store).orderBy("source"), path)
    return store.sparkSession.read.parquet(path)


def write_split(split: DataFrame, path: str) -> None:
    """split.parquet, one row an observation, and a sorted list of ids under lists/fold=<fold>."""
    columns = [c for c in ("obs_id", "fold", "class_id") if c in split.columns]
    write_parquet(one_per(split.select(*columns), ["obs_id"], [F.col(c) for c in columns[1:]]), f"{path}/split.parquet")
    ids = split.select("obs_id", "fold").distinct().repartitionByRange("fold", "obs_id").sortWithinPartitions("fold", "obs_id")
    ids.write.mode("overwrite").partitionBy("fold").text(f"{path}/lists")


def _folds(spark: SparkSession, path: str) -> Swap:
    return Swap(spark, path, f"{path}.next", f"{path}.old")


def save_folds(folds: DataFrame, path: str) -> None:
    """Sorted by block, so that two runs give the same file; swapped in, so that a stop loses no locked block."""
    swap = _folds(folds.sparkSession, path)
    swap.recover()
    write_parquet(folds.select("block_id", "fold").coalesce(1).sortWithinPartitions("block_id"), swap.fresh)
    swap.commit()


def load_folds(spark: SparkSession, path: str) -> dict[int, str] | None:
    """None where there are none yet; a broken file is an error, as guessing would move locked blocks."""
    at = _folds(spark, path).current()
    return {r["block_id"]: r["fold"] for r in spark.read.parquet(at).select("block_id", "fold").toLocalIterator()} if at else None


def append_shard(rows: DataFrame, prefix: str) -> None:
    """Rows of finished groups, committed as a whole or not at all; nothing is written for no rows."""
    if not rows.isEmpty():
        write_parquet(rows, f"{prefix}/shards/run={uuid.uuid4().hex}")


def read_manifest(spark: SparkSession, prefix: str) -> DataFrame:
    """The manifest without its shards; empty where there is none yet."""
    at = _manifest(spark, prefix).current()
    return spark.read.schema(MANIFEST).parquet(at) if at else spark.createDataFrame([], MANIFEST)


def _manifest(spark: SparkSession, prefix: str) -> Swap:
    return Swap(spark, f"{prefix}/manifest.parquet", f"{prefix}/manifest.next", f"{prefix}/manifest.old")


def replace_manifest(rows: DataFrame, prefix: str) -> DataFrame:
    """Writes `rows`, which may come from the manifest itself, as the manifest."""
    swap = _manifest(rows.sparkSession, prefix)
    write_parquet(rows.select(*MANIFEST.names), swap.fresh)
    return rows.sparkSession.read.schema(MANIFEST).parquet(swap.commit())


def consolidate_shards(spark: SparkSession, prefix: str) -> DataFrame:
    """The manifest with its shards, later rows first; files of shards that can't be read are put aside under `unreadable`
    and named in a warning. The merged table
    is written beside the old one and swapped in, then the shards go; a replay after a stop merges them again,
    which changes nothing."""
    swap, shards = _manifest(spark, prefix), f"{prefix}/shards"
    old = spark.read.schema(MANIFEST).parquet(swap.at) if swap.recover() else None
    if not exists(spark, shards):
        return old if old is not None else spark.createDataFrame([], MANIFEST)
    fresh = spark.read.schema(MANIFEST).option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true").parquet(shards)
    # the time of the shard, then the place in it
    fresh = fresh.withColumn("seq", F.unix_millis("_metadata.file_modification_time") * 1_000_000 + F.pmod(F.col("_metadata.row_index"), F.lit(1_000_000)))
    merged = replace_manifest(consolidate(old, fresh, MANIFEST_KEY).drop("seq"), prefix)
    for file in _unreadable(spark, shards, {r[0] for r in fresh.select("_metadata.file_path").distinct().toLocalIterator()}):
        swap.make(f"{prefix}/unreadable")
        swap.move(file, f"{prefix}/unreadable/{'_'.join(file.split('/')[-2:])}")
        warnings.warn(f"{file} can't be read; it is now under {prefix}/unreadable", stacklevel=2)
    swap.remove(shards)
    return merged


def _unreadable(spark: SparkSession, shards: str, seen: set[str]) -> list[str]:
    """Files of shards that gave no row because they are broken; those that are merely empty aren't."""
    names = {f.split("/shards/")[-1] for f in seen}
    out = []
    for file in list_parquet(spark, shards, recursive=True):
        if file.split("/shards/")[-1] not in names:
            try:
                spark.read.schema(MANIFEST).parquet(file).collect()  # it has no row, or can't be read
            except Exception as e:  # whatever a broken file raises
                if "FAILED_READ_FILE" not in str(e) and "not a Parquet file" not in str(e):
                    raise
                out.append(file)
    return out


def save_head(spark: SparkSession, head: Head, path: str) -> None:
    row = head.to_row()
    names = ("classes", "mean", "sd", "layers", "means", "precision", "threshold")
    write_parquet(spark.createDataFrame([tuple(row[n] for n in names)], HEAD), path)


def load_head(spark: SparkSession, path: str) -> Head:
    row = spark.read.parquet(path).first().asDict(recursive=True)
    return Head.from_row(row)
