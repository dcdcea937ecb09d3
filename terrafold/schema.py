"""Schemas of the observation store and of the chip manifest."""

from __future__ import annotations

from pyspark.sql import types as T

#: name, type, whether a table must bring the column
OBSERVATION_COLUMNS: tuple[tuple[str, T.DataType, bool], ...] = (
    ("obs_id", T.StringType(), True),
    ("source", T.StringType(), True),
    ("source_record_id", T.StringType(), True),
    ("source_url", T.StringType(), False),
    ("source_doi", T.StringType(), False),
    ("license", T.StringType(), False),
    ("species", T.StringType(), False),
    ("species_normalized", T.StringType(), False),
    ("taxon_rank", T.StringType(), False),
    ("geom_type", T.StringType(), True),
    ("coord_uncertainty_m", T.DoubleType(), False),
    ("event_date", T.StringType(), False),
    ("basis_of_record", T.StringType(), False),
    ("cover_pct", T.DoubleType(), False),
    ("weight", T.DoubleType(), True),
    ("ingested_at", T.TimestampType(), True),
    ("ingest_run_id", T.StringType(), True),
    ("aoi_admin1", T.StringType(), True),
    ("lon", T.DoubleType(), True),
    ("lat", T.DoubleType(), True),
)
OBSERVATION = T.StructType([T.StructField(n, t, True) for n, t, _ in OBSERVATION_COLUMNS])
REQUIRED = tuple(n for n, _, must in OBSERVATION_COLUMNS if must)

_S, _D, _I = T.StringType(), T.DoubleType(), T.IntegerType()
MANIFEST = T.StructType(
    [T.StructField(n, t) for n, t in (("obs_id", _S), ("species", _S), ("month_label", _S), ("chip_uri", _S), ("year", _I), ("block_id", _I), ("lon", _D), ("lat", _D), ("valid_frac", _D))]
)
MANIFEST_KEY = ("obs_id", "month_label", "year")
