"""Leakage-free split: whole blocks go to folds, classes spread by iterative stratification.

Spark counts the blocks' classes; the assignment itself is sequential by nature and works on that matrix
(one row a block, bounded by the area, not by the labels); its result joins back to the labels."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.operators.crosswalk import ClassMap
from terrafold.operators.dedup import one_per, thin
from terrafold.operators.filters import at_least_rows

FOLDS = ("train", "val", "test")


def stratify(blocks: list[int], matrix: np.ndarray, train: float, val: float, seed: int, locked: dict[int, str] | None = None) -> dict[int, str]:
    """Fold of each block. The rarest class left goes first, each of its blocks to the fold that lacks it
    most, then to the one that lacks most overall, then by a draw. Locked blocks keep their fold."""
    share = np.array([train, val, 1 - train - val])
    fold = np.full(len(blocks), -1)
    for i, block in enumerate(blocks):
        if block in (locked or {}):
            fold[i] = FOLDS.index(locked[block])
    # what each fold still lacks of each class
    owed = np.outer(share, matrix.sum(axis=0)) - np.stack([matrix[fold == f].sum(axis=0) for f in range(len(FOLDS))])
    rng = np.random.default_rng(seed)
    while (fold < 0).any():
        free = np.flatnonzero(fold < 0)
        supply = matrix[free].sum(axis=0)
        if not supply.any():  # blocks without labels
            fold[free] = owed.sum(axis=1).argmax()
            break
        scarce = min(np.flatnonzero(supply), key=lambda c: supply[c])
        for i in rng.permutation(free[matrix[free, scarce] > 0]):
            fold[i] = np.lexsort((rng.random(len(FOLDS)), owed.sum(axis=1), owed[:, scarce]))[-1]
            owed[fold[i]] -= matrix[i]
    return {b: FOLDS[f] for b, f in zip(blocks, fold.tolist(), strict=True)}


def block_folds(labels: DataFrame, column: str, train: float = 0.7, val: float = 0.15, seed: int = 42, locked: dict[int, str] | None = None, max_blocks: int = 1_000_000) -> DataFrame:
    """block_id, fold of labels that have block_id and a class column."""
    counts = labels.where(F.col("block_id").isNotNull() & F.col(column).isNotNull()).groupBy("block_id", column).agg(F.count(F.lit(1)).alias("n"))
    rows = counts.limit(max_blocks + 1).collect()
    if len(rows) > max_blocks:
        raise ValueError(f"more than {max_blocks} pairs of block and class")
    blocks, classes = sorted({r["block_id"] for r in rows}), sorted({r[column] for r in rows})
    matrix = np.zeros((len(blocks), len(classes)))
    b_at, c_at = ({k: i for i, k in enumerate(v)} for v in (blocks, classes))
    for r in rows:
        matrix[b_at[r["block_id"]], c_at[r[column]]] = r["n"]
    found = stratify(blocks, matrix, train, val, seed, locked)
    return labels.sparkSession.createDataFrame(sorted((int(b), f) for b, f in found.items()), "block_id int, fold string")


def make_split(manifest: DataFrame, classes: ClassMap | None = None, species: list[str] | None = None, min_class_obs: int = 0, thin_m: float = 20.0, **options) -> DataFrame:
    """obs_id, species, block_id, class_id, fold: one row an observation. With a species list unmapped names
    get class -1, else they go."""
    rows = manifest
    if species:
        rows = rows.where(F.lower("species").isin(*[s.lower() for s in species]))
        if rows.isEmpty():
            raise ValueError("none of the species asked for is in the manifest")
    rows = one_per(rows, ["obs_id"], [F.col("year"), F.col("month_label")]).select("obs_id", "species", "block_id", "lon", "lat")
    column = "species"
    if classes is not None:
        rows = rows.withColumn("class_id", F.coalesce(classes.column("species"), F.lit(-1)) if species else classes.column("species")).where("class_id is not null")
        column = "class_id"
    rows = thin(at_least_rows(rows, column, min_class_obs), thin_m, column)
    folds = block_folds(rows, column, **options)
    return rows.join(F.broadcast(folds), "block_id").drop("lon", "lat")
