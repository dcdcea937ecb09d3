"""The observation store: one folder a dataset, upserts that rewrite the files they touch, scans that reach the files."""

from __future__ import annotations

import bisect
import datetime as dt
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.operators.dedup import latest
from terrafold.schema import OBSERVATION, OBSERVATION_COLUMNS, REQUIRED
from terrafold.sources.files import list_parquet
from terrafold.sources.versions import File, Versions

DATASETS = frozenset({"BioSCape_VegPlots_Berg_Eerste_2425", "mapwaps_olifants_doring", "mapwaps_tugela", "mapwaps_umzimvubu", "sanlc_accuracy_points"})
TIES = ("ingest_run_id", "source_record_id")
#: Rows of a data file, and how often a writer begins again because another one was first.
FILE_ROWS, ATTEMPTS = 1_000_000, 20


def run_id(source: str, when: dt.datetime | None = None) -> str:
    return f"{source}_{(when or dt.datetime.now(tz=dt.UTC)).strftime('%Y%m%dT%H%M%SZ')}"


def canonical(df: DataFrame) -> DataFrame:
    """The store's columns in order and type; a missing required column is an error."""
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t, _ in OBSERVATION_COLUMNS])


def in_slots(rows: DataFrame, files: list[File]) -> DataFrame:
    """Adds slot: the number of the file whose keys a row's obs_id is among, or that of the last file before it.

    The files' keys don't overlap, so each key has one slot; what is held in a task is one key a file (`MAX_FILES`)."""
    firsts = [f.least or "" for f in files][1:]  # keys before all files go to the first one

    def slot(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            yield pd.Series([bisect.bisect_right(firsts, k or "") for k in keys], dtype="int32")

    return rows.withColumn("slot", F.pandas_udf(slot, "int")("obs_id") if firsts else F.lit(0))


class Store:
    """Paths go through Hadoop's file system, so any store that Spark reads will do."""

    def __init__(self, spark: SparkSession, root: str, datasets: frozenset[str] = DATASETS, file_rows: int = FILE_ROWS):
        self.spark, self.root, self.datasets, self.file_rows = spark, root.rstrip("/"), datasets, file_rows

    def partition(self, dataset: str) -> str:
        if dataset not in self.datasets:
            raise ValueError(f"unknown dataset {dataset!r}; there are {sorted(self.datasets)}")
        return f"{self.root}/dataset={dataset}"

    def versions(self, dataset: str) -> Versions:
        return Versions(self.spark, self.partition(dataset))

    def upsert(self, new: DataFrame, dataset: str, run: str | None = None) -> str:
        """Merges by obs_id, latest ingested_at first; `run` names the run of rows that have none.

        Data files hold ranges of obs_id that don't overlap. Only files among whose keys the batch has one are read; their
        rows and the batch's become new files, one or more in the place of each, sorted by place within, and a new version
        names these and the untouched ones. A stop at any point changes nothing that was stored, a replay of the same rows
        gives the same rows, and a writer that finds its version taken merges again with the one that took it."""
        rows = canonical(new)
        if run:
            rows = rows.withColumn("ingest_run_id", F.coalesce("ingest_run_id", F.lit(run)))
        log = self.versions(dataset)
        for _ in range(ATTEMPTS):
            version = log.newest()
            files, folder = log.files(version), f"data/{uuid.uuid4().hex}"
            if not version and (flat := list_parquet(self.spark, log.at)):  # a folder of plain files, all of which are touched once
                rows = rows.unionByName(self.spark.read.schema(OBSERVATION).parquet(*flat))
            kept, fresh = self._merge(log, files, rows, folder)
            name = log.write_list([*kept, *fresh])
            if log.publish(version + 1, name):
                return log.at
            log.remove(*folder.split("/"))
            log.remove("lists", name)
        raise RuntimeError(f"{log.at}: other writers were first {ATTEMPTS} times")

    def _merge(self, log: Versions, files: list[File], rows: DataFrame, folder: str) -> tuple[list[File], list[File]]:
        """The files that stay and those that are written to `folder` in the place of the others."""
        batch = {r.slot: r.n for r in in_slots(rows.select("obs_id"), files).groupBy("slot").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a file at most
        if not batch:
            return files, []
        touched = [f for k, f in enumerate(files) if k in batch]
        merged = in_slots(latest(log.read(OBSERVATION, touched).unionByName(rows), ties=TIES), files)
        pieces = max(len(batch), -(-(sum(batch.values()) + sum(f.n for f in touched)) // self.file_rows))
        dealt = merged.repartitionByRange(pieces, "slot", "obs_id").sortWithinPartitions("slot", "lon", "lat")
        dealt.write.partitionBy("slot").option("compression", "zstd").parquet(f"{log.at}/{folder}")
        ends = [f(c).alias(n) for n, f, c in (("least", F.min, "obs_id"), ("greatest", F.max, "obs_id"))]
        box = [f(c).alias(n) for n, f, c in (("minlon", F.min, "lon"), ("maxlon", F.max, "lon"), ("minlat", F.min, "lat"), ("maxlat", F.max, "lat"))]
        path = F.concat(F.lit(f"{folder}/"), F.substring_index("_metadata.file_path", f"/{folder}/", -1))
        written = self.spark.read.schema(OBSERVATION).option("recursiveFileLookup", "true").parquet(f"{log.at}/{folder}")
        listed = written.groupBy(path.alias("path")).agg(*ends, F.count(F.lit(1)).alias("n"), *box)
        return [f for k, f in enumerate(files) if k not in batch], [File(*r) for r in listed.collect()]

    def vacuum(self, dataset: str, keep: int = 2, hours: float = 24.0) -> list[str]:
        """Removes what only older versions name; see `Versions.vacuum`."""
        return self.versions(dataset).vacuum(keep, hours)

    def read(self, sources: list[str] | None = None, bbox: tuple[float, float, float, float] | None = None) -> DataFrame:
        """All datasets; both filters are plain comparisons on flat columns and reach the files, and files that the box
        doesn't meet are left out."""
        paths, known = [], False
        for dataset in sorted(self.datasets):
            log = self.versions(dataset)
            version = log.newest()
            known |= version > 0
            if version:
                paths += [f"{log.at}/{f.path}" for f in log.files(version) if bbox is None or f.meets(bbox)]
            else:
                paths += list_parquet(self.spark, log.at)
        if not paths and not known:
            raise FileNotFoundError(f"no observations under {self.root}")
        df = self.spark.read.schema(OBSERVATION).parquet(*paths) if paths else self.spark.createDataFrame([], OBSERVATION)
        if sources:
            df = df.where(F.col("source").isin(*sources))
        if bbox:
            df = df.where(F.col("lon").between(bbox[0], bbox[2]) & F.col("lat").between(bbox[1], bbox[3]))
        return df.select(*OBSERVATION.names)
