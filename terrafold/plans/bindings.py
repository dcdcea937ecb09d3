"""Domain views over the driver's tables, as SQL that Spark and the oracle both run.

Values come from ids by arithmetic, so that every null policy and tie has rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPECIES = ("Acacia mearnsii", "Acacia saligna", "Pinus radiata", "Pinus patula", "Eucalyptus globulus", "Eucalyptus nitens", "Salix alba", "Quercus robur", "Hakea sericea", "Prosopis glandulosa", "Populus canescens")
ADMIN1 = ("western_cape", "kwazulu_natal", "eastern_cape", "limpopo", "mpumalanga")
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
DOY = (15, 46, 74, 105, 135, 166, 196, 227, 258, 288, 319, 349)


def choose(index: str, values: tuple) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" if isinstance(v, str) else f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE {index} {cases} END"


def pad(x: str, n: int) -> str:
    return f"lpad(CAST({x} AS STRING), {n}, '0')"


_LON = "16.5e0 + ((user_id * 7919 + event_id * 104729) % 16000) / 1e3"
_LAT = "-34.5e0 + ((user_id * 6101 + event_id * 7907) % 12000) / 1e3"
_DATE = f"CASE WHEN event_id % 13 = 0 THEN NULL ELSE concat(CAST(2015 + event_id % 10 AS STRING), '-', {pad('1 + event_id % 12', 2)}, '-', {pad('1 + event_id % 28', 2)}) END"
_COMMON = f"""event_id, user_id, event_type AS source, CAST(event_id AS STRING) AS source_record_id, {choose("event_id % 11", SPECIES)} AS species_normalized,
  CASE WHEN event_id % 17 = 0 THEN 'polygon' ELSE 'point' END AS geom_type, CASE WHEN event_id % 7 = 0 THEN NULL ELSE (event_id % 60) * 1e1 END AS coord_uncertainty_m,
  {_DATE} AS event_date, CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id % 101 AS DOUBLE) END AS cover_pct,
  CASE event_id % 4 WHEN 0 THEN 0e0 WHEN 1 THEN 5e-1 ELSE 1e0 END AS weight, ts AS ingested_at, concat('run', CAST(event_id % 3 AS STRING)) AS ingest_run_id,
  {choose("event_id % 5", ADMIN1)} AS aoi_admin1, {_LON} AS lon, {_LAT} AS lat"""

#: One observation an event, and observations that come again (a user's events of one kind).
OBS = f"SELECT concat('ev:', {pad('event_id', 9)}) AS obs_id, {_COMMON} FROM events"
AGAIN = f"SELECT concat('ev:', {pad('user_id', 6)}, ':', event_type) AS obs_id, {_COMMON} FROM events"
#: Chips: an order is one; the customer is the observation.
MANIFEST = f"""SELECT concat('c:', {pad('o_custkey', 8)}) AS obs_id, {choose("o_custkey % 11", SPECIES)} AS species, {choose("month(o_orderdate) - 1", MONTHS)} AS month_label,
  concat('chip/', CAST(o_orderkey AS STRING)) AS chip_uri, CAST(year(o_orderdate) AS INT) AS year, CAST(o_custkey % 97 AS INT) AS block_id, o_orderkey AS seq,
  16.5e0 + ((o_custkey * 7919) % 16000) / 1e3 AS lon, -34.5e0 + ((o_custkey * 6101) % 12000) / 1e3 AS lat, (o_orderkey % 100) / 1e2 AS valid_frac FROM orders"""
#: Pixels: a line item is a value of a pixel in a scene.
PIXELS = """SELECT l_suppkey AS chip, l_returnflag AS band, l_partkey % 8 AS px, CAST(l_quantity AS INT) % 12 AS scl, l_linenumber AS month_no,
  CASE WHEN l_partkey % 9 = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_extendedprice END AS value FROM lineitem"""
#: Months expected of each observation of the manifest.
EXPECTED = f"""SELECT concat('c:', {pad('c_custkey', 8)}) AS obs_id, m.month_label FROM customer CROSS JOIN (SELECT 'feb' AS month_label UNION ALL SELECT 'may' UNION ALL SELECT 'sep') m"""
FOLD = "CASE WHEN vec_id % 20 < 14 THEN 'train' WHEN vec_id % 20 < 17 THEN 'val' ELSE 'test' END"
LABELLED = f"SELECT vec_id, embedding, label, {FOLD} AS fold FROM embeddings"

VIEWS = {"obs": OBS, "again": AGAIN, "manifest": MANIFEST, "pixels": PIXELS, "expected": EXPECTED, "labelled": LABELLED}
RINGS = {
    "aoi": [(18.0, -34.0), (24.0, -34.25), (26.5, -31.0), (21.0, -28.5), (18.0, -34.0)],
    "b0": [(17.0, -34.0), (20.0, -34.0), (20.0, -30.0), (17.0, -30.0), (17.0, -34.0)],
    "b1": [(19.0, -33.0), (25.0, -33.5), (27.0, -29.0), (22.0, -27.0), (19.0, -33.0)],
    "b2": [(25.0, -32.0), (31.0, -33.0), (31.5, -25.0), (25.0, -32.0)],
}
BIOME_NAMES = {"b0": "Fynbos", "b1": "Nama-Karoo", "b2": "Savanna"}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A domain view; the driver's tables are read by path, under names of their own."""
    sql = VIEWS[name]
    for t in ("events", "orders", "lineitem", "customer", "embeddings"):
        if f"FROM {t}" in sql:
            sql = sql.replace(f"FROM {t}", f"FROM parquet.`{sf_dir}/{t}.parquet`")
    return spark.sql(sql)


def with_views(sql: str) -> str:
    """The oracle's SQL with the views that it names as common tables."""
    import re

    used = {n: v for n, v in VIEWS.items() if re.search(rf"\b{n}\b", sql)}
    head = ", ".join(f"{n} AS ({v})" for n, v in used.items())
    return sql if not head else f"WITH {head}, {sql[5:]}" if sql.startswith("WITH ") else f"WITH {head} {sql}"
