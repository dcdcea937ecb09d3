"""Reports over the store and the manifest. Group keys that are null are left out unless a rule keeps them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _known(df: DataFrame, *keys: str) -> DataFrame:
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def source_summary(store: DataFrame) -> DataFrame:
    """Rows of each source (null is one), and how many have an uncertainty and a cover; percentages half-even."""
    rows = store.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count("coord_uncertainty_m").alias("n_with_coord_unc"), F.count("cover_pct").alias("n_with_cover"))
    return rows.withColumns({f"pct_with_{k}": F.bround(100 * F.col(f"n_with_{k}") / F.col("n"), 2) for k in ("coord_unc", "cover")})


def species_stats(manifest: DataFrame) -> DataFrame:
    rows = _known(manifest, "species").groupBy("species").agg(F.count_distinct("obs_id").alias("n_obs"), F.count(F.lit(1)).alias("n_chips"), F.count_distinct("block_id").alias("n_blocks"))
    return rows.withColumn("chips_per_obs", F.bround(F.col("n_chips") / F.col("n_obs"), 2))


def overview(manifest: DataFrame) -> DataFrame:
    return manifest.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_distinct(c).alias(f"n_{c}") for c in ("obs_id", "species", "block_id")],
        *[f(c).alias(f"{n}_{c}") for c in ("lon", "lat") for n, f in (("min", F.min), ("max", F.max))],
    )


def top(df: DataFrame, measure: str, name: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(measure), name).limit(n)


def cumulative_share(manifest: DataFrame, ns: tuple[int, ...] = (10, 30), tail: int = 50) -> DataFrame:
    """Share of observations in the n commonest species, and how many species have under `tail`."""
    counts = species_stats(manifest)
    total = manifest.agg(F.count_distinct("obs_id").alias("total"))
    parts = [top(counts, "n_obs", "species", n).agg((F.sum("n_obs")).alias(f"top_{n}")) for n in ns]
    out = total.join(counts.agg(F.count_if(F.col("n_obs") < tail).alias("long_tail")))
    for part in parts:  # single rows
        out = out.join(part)
    return out.select("long_tail", *[F.bround(F.col(f"top_{n}") / F.col("total"), 4).alias(f"share_top_{n}") for n in ns])


def month_completeness(manifest: DataFrame) -> DataFrame:
    """How many observations have each number of distinct months."""
    per = _known(manifest, "obs_id").groupBy("obs_id").agg(F.count_distinct("month_label").alias("n_months"))
    return per.groupBy("n_months").agg(F.count(F.lit(1)).alias("n_obs"))


def distinct_by(manifest: DataFrame, key: str, what: str = "obs_id") -> DataFrame:
    return _known(manifest, key).groupBy(key).agg(F.count_distinct(what).alias("n_obs"))


def dominance(manifest: DataFrame, share: float = 0.5, least: int = 50, n: int = 20) -> DataFrame:
    """Species of which one block holds at least `share`; an observation in two blocks counts in both."""
    blocks = _known(manifest, "species", "block_id").groupBy("species", "block_id").agg(F.count_distinct("obs_id").alias("n"))
    per = blocks.groupBy("species").agg(F.sum("n").alias("total"), F.max("n").alias("largest")).withColumn("share", F.col("largest") / F.col("total"))
    return top(per.where((F.col("share") >= share) & (F.col("total") >= least)), "share", "species", n)


def counts_matrix(df: DataFrame, row: str, column: str, values: list) -> DataFrame:
    """Counts with a column for each listed value, 0 where there are none."""
    return _known(df, row, column).groupBy(row).pivot(column, values).agg(F.count(F.lit(1))).fillna(0)


def fold_matrix(df: DataFrame, key: str, folds: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """Counts by fold, in the folds' order, and their total."""
    wide = counts_matrix(df, key, "fold", list(folds))
    return wide.withColumn("TOTAL", sum((F.col(f) for f in folds[1:]), F.col(folds[0])))


def class_composition(df: DataFrame) -> DataFrame:
    return _known(df, "class_id", "species").groupBy("class_id", "species").agg(F.count(F.lit(1)).alias("n"))


def composition_text(df: DataFrame) -> DataFrame:
    """`species (n)` of each class in one line, the commonest first."""
    rows = class_composition(df).groupBy("class_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "species"))).alias("_s"))
    return rows.select("class_id", F.array_join(F.transform("_s", lambda s: F.concat(s["species"], F.lit(" ("), (-s["k"]).cast("string"), F.lit(")"))), ", ").alias("members"))


def fold_balance(df: DataFrame) -> DataFrame:
    rows = df.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("species").alias("n_species"))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    return rows.join(F.broadcast(total)).withColumn("pct", F.bround(100 * F.col("n") / F.col("_total"), 1)).drop("_total")


def prf(df: DataFrame, classes: list[int], truth: str = "y_true", pred: str = "y_pred") -> DataFrame:
    """Precision, recall and F1 of each class, three places half-even, 0 where undefined; and macro_f1, the
    mean of the rounded F1 of classes that occur. Counts come from one pass, a row a pair of classes."""
    pairs = df.groupBy(truth, pred).agg(F.count(F.lit(1)).alias("n"))
    spread = pairs.select(F.explode(F.array([F.lit(c) for c in classes])).alias("class_id"), truth, pred, "n")

    def total(rule: Column) -> Column:
        return F.coalesce(F.sum(F.when(rule, F.col("n"))), F.lit(0))

    is_true, is_pred = F.col(truth) == F.col("class_id"), F.col(pred) == F.col("class_id")
    per = spread.groupBy("class_id").agg(total(is_true & is_pred).alias("tp"), total(~is_true & is_pred).alias("fp"), total(is_true & ~is_pred).alias("fn"))
    p = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0e0))
    r = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0e0))
    per = per.withColumns({"p_": p, "r_": r, "support": F.col("tp") + F.col("fn")}).withColumn("f_", F.coalesce(F.try_divide(2 * F.col("p_") * F.col("r_"), F.col("p_") + F.col("r_")), F.lit(0e0)))
    per = per.select("class_id", "support", F.bround("p_", 3).alias("precision"), F.bround("r_", 3).alias("recall"), F.bround("f_", 3).alias("f1"))
    macro = per.agg(F.avg(F.when(F.col("support") > 0, F.col("f1"))).alias("macro_f1"))
    return per.join(F.broadcast(macro))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """balanced: N / (K n); sqrt: 1 / sqrt(n), scaled to sum to K."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    sums = counts.agg(F.sum("n").alias("_n"), F.count(F.lit(1)).alias("_k"), F.sum(1 / F.sqrt("n")).alias("_s"))
    both = counts.join(F.broadcast(sums))
    return both.select(label, "n", (F.col("_n") / (F.col("_k") * F.col("n"))).alias("balanced"), (F.col("_k") / F.sqrt("n") / F.col("_s")).alias("sqrt"))
