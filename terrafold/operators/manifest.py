"""Planning of chip extraction and upkeep of the manifest, as set operations on keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.operators.dedup import keep_last


def windows(df: DataFrame, months: str = "months", year: str = "year", padding: int = 15) -> DataFrame:
    """A row for each month template (array of structs start, stop as MM-dd, and label) on the row's year."""
    out = df.withColumn("_m", F.explode(months))

    def day(part: str):
        return F.to_date(F.concat(F.col(year).cast("string"), F.lit("-"), F.col(f"_m.{part}")))

    return out.withColumns({"month_label": F.col("_m.label"), "win_start": F.date_sub(day("start"), padding), "win_end": F.date_add(day("stop"), padding)}).drop("_m", months)


def consolidate(existing: DataFrame | None, shards: DataFrame, keys: tuple[str, ...], sequence: str = "seq") -> DataFrame:
    """Existing rows and shards, the last of each key; shards come after what exists."""
    rows = shards if existing is None else existing.withColumn(sequence, F.lit(-1).cast(shards.schema[sequence].dataType)).unionByName(shards, allowMissingColumns=True)
    return keep_last(rows, list(keys), sequence)


def modal_year(manifest: DataFrame, obs: str = "obs_id", year: str = "year") -> DataFrame:
    """Each observation's commonest year, the smallest of equals. Years are counted first."""
    counts = manifest.groupBy(obs, year).count()
    return counts.groupBy(obs).agg(F.min_by(year, F.struct(-F.col("count"), F.col(year))).alias("modal_year"))


def todo(expected: DataFrame, manifest: DataFrame, obs: str = "obs_id", month: str = "month_label") -> DataFrame:
    """(obs, month) pairs still to be made."""
    return expected.select(obs, month).distinct().join(manifest.select(obs, month).distinct(), [obs, month], "left_anti")


def completeness(expected: DataFrame, manifest: DataFrame, obs: str = "obs_id", month: str = "month_label") -> DataFrame:
    """expected, got, missing and extra months of each expected observation, and whether it is done; done is a
    test of sets, not of counts."""
    want = expected.groupBy(obs).agg(F.array_sort(F.collect_set(month)).alias("expected"))
    got = manifest.groupBy(obs).agg(F.array_sort(F.collect_set(month)).alias("got"))
    both = want.join(got, obs, "left").withColumn("got", F.coalesce("got", F.array().cast("array<string>")))
    both = both.withColumns({"missing": F.array_except("expected", "got"), "extra": F.array_except("got", "expected")})
    return both.withColumn("done", F.size("missing") == 0)


def reconcile(manifest: DataFrame, keep: DataFrame, expected: DataFrame, obs: str = "obs_id", month: str = "month_label") -> DataFrame:
    """Manifest rows with `stale`: the observation is gone, or is managed and doesn't expect the month."""
    wanted = expected.groupBy(obs).agg(F.collect_set(month).alias("_want"))
    kept = keep.select(obs).distinct().withColumn("_kept", F.lit(True))
    both = manifest.join(kept, obs, "left").join(wanted, obs, "left")
    stale = F.col("_kept").isNull() | (F.col("_want").isNotNull() & ~F.array_contains("_want", F.col(month)))
    return both.withColumn("stale", stale).drop("_kept", "_want")


def year_fallback(todo_rows: DataFrame, failed: DataFrame, obs: str = "obs_id", year: str = "year") -> DataFrame:
    """What failed is tried once more a year earlier."""
    return todo_rows.join(failed.select(obs).distinct(), obs, "left_semi").withColumn(year, F.col(year) - 1)


def months_in_order(manifest: DataFrame, day_of: dict[str, int], least: int, obs: str = "obs_id", month: str = "month_label", uri: str = "chip_uri", sequence: str = "seq") -> DataFrame:
    """The first `least` months of each observation by day of year, of those that have as many; the last
    chip of a month counts."""
    table = manifest.sparkSession.createDataFrame(sorted(day_of.items()), f"`{month}` string, _doy int")
    last = keep_last(manifest.join(F.broadcast(table), month), [obs, month], sequence)
    rows = last.groupBy(obs).agg(F.array_sort(F.collect_list(F.struct(F.col("_doy").alias("doy"), F.col(uri).alias("uri")))).alias("chips"))
    return rows.where(F.size("chips") >= least).withColumn("chips", F.slice("chips", 1, least))
