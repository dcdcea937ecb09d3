"""Readers of files: CSV as text, GeoJSON rings, shapefiles, YAML."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from pathlib import Path
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def load_config(path: str) -> dict[str, Any]:
    import yaml

    return yaml.safe_load(Path(path).read_text()) or {}


def read_csv(spark: SparkSession, path: str, numbers: tuple[str, ...] = ()) -> DataFrame:
    """Every column as text; `numbers` as doubles, null where they can't be read."""
    df = spark.read.csv(path, header=True)
    return df.withColumns({c: F.col(c).try_cast("double") for c in numbers if c in df.columns})


def list_parquet(spark: SparkSession, root: str, recursive: bool = False) -> list[str]:
    """Parquet files below a folder, sorted, without unfinished ones; a missing folder has none."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(root)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    found, files = [], fs.listFiles(at, recursive)
    while files.hasNext():
        found.append(files.next().getPath().toString())
    return sorted(f for f in found if f.endswith(".parquet") and "/_tmp_" not in f)


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """order, properties (JSON text) and ring of each part of polygons and multipolygons; a null vertex parts the
    outer ring from the holes, and one hole from the next."""
    text = spark.read.text(path, wholetext=True)
    features = text.select(F.posexplode(F.from_json(F.get_json_object("value", "$.features"), "array<string>")).alias("order", "f"))
    kind = F.get_json_object("f", "$.geometry.type")
    coords = F.get_json_object("f", "$.geometry.coordinates")
    single = F.array(F.from_json(coords, "array<array<array<double>>>"))
    many = F.when(kind == "MultiPolygon", F.from_json(coords, "array<array<array<array<double>>>>")).otherwise(single)
    parts = features.select("order", F.get_json_object("f", "$.properties").alias("properties"), F.explode(many).alias("_p"))
    rings = F.transform("_p", lambda r: F.transform(r, lambda v: F.struct(v[0].alias("x"), v[1].alias("y"))))
    apart = F.flatten(F.transform(rings, lambda r: F.concat(F.array(F.lit(None)), r)))
    return parts.select("order", "properties", F.slice(apart, 2, F.size(apart)).alias("ring")).where("size(ring) > 0")


class ShapefileSource(DataSource):
    """`spark.read.format("shapefile").load(path)`: x and y of points, or the rings of a polygon, a null
    between them, the attributes as text, and record, the number from 0 in the file. Deleted records are left out. Options: columns, a comma list of attributes to read; bbox (four numbers, in the file's own
    coordinates), beyond which polygons are skipped."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> str:
        kind, fields = _header(self.options["path"])
        wanted = self.options.get("columns")
        names = [f[0] for f in fields if not wanted or f[0] in wanted.split(",")]
        shape = "x double, y double" if kind in (1, 11, 21) else "ring array<struct<x:double,y:double>>"
        return ", ".join([shape, *(f"`{n}` string" for n in names), "record bigint"])

    def reader(self, schema) -> DataSourceReader:
        return _ShapefileReader(self.options["path"], schema, self.options.get("bbox"))


def declared_crs(path: str) -> str | None:
    """The projection that a shapefile states, as text; None where it states none."""
    prj = Path(path).with_suffix(".prj")
    return prj.read_text().strip() or None if prj.exists() else None


def shapefile_in(path: str) -> str:
    """A shapefile by name, or the first one of a folder that isn't about data integrity."""
    if not Path(path).is_dir():
        return path
    found = sorted(p for p in Path(path).glob("*.shp") if "integrity" not in p.name.lower())
    if not found:
        raise FileNotFoundError(f"no shapefile of points in {path}")
    return str(found[0])


def _header(path: str) -> tuple[int, list[tuple[str, int]]]:
    """Shape type of the .shp and (name, width) of the .dbf's fields."""
    with Path(path).open("rb") as shp, Path(path).with_suffix(".dbf").open("rb") as dbf:
        kind = struct.unpack("<i", shp.read(36)[32:])[0]
        raw = dbf.read(12)
        size = struct.unpack("<H", raw[8:10])[0]
        raw += dbf.read(size - 12)
    fields = []
    for at in range(32, size - 1, 32):
        if raw[at] == 0x0D:
            break
        fields.append((raw[at : at + 11].split(b"\0")[0].decode("latin-1"), raw[at + 16]))
    return kind, fields


class _ShapefileReader(DataSourceReader):
    """Fixed-width attribute records make a file splittable: a partition is a range of records."""

    ROWS = 50_000

    def __init__(self, path: str, schema, bbox: str | None = None):
        self.path, self.names = path, schema.names
        self.bbox = tuple(float(v) for v in bbox.split(",")) if bbox else None

    def _near(self, raw: bytes, kind: int) -> bool:
        if self.bbox is None or kind in (1, 11, 21) or len(raw) < 36:
            return True
        x0, y0, x1, y1 = struct.unpack("<4d", raw[4:36])
        return x0 <= self.bbox[2] and x1 >= self.bbox[0] and y0 <= self.bbox[3] and y1 >= self.bbox[1]

    def partitions(self) -> list[InputPartition]:
        with Path(self.path).with_suffix(".dbf").open("rb") as dbf:
            n = struct.unpack("<I", dbf.read(8)[4:])[0]
        return [InputPartition((i, min(n, i + self.ROWS))) for i in range(0, n, self.ROWS)] or [InputPartition((0, 0))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        lo, hi = partition.value
        kind, fields = _header(self.path)
        with Path(self.path).open("rb") as shp, Path(self.path).with_suffix(".shx").open("rb") as shx, Path(self.path).with_suffix(".dbf").open("rb") as dbf:
            head, width = struct.unpack("<HH", dbf.read(12)[8:12])
            shx.seek(100 + 8 * lo)
            places = np.frombuffer(shx.read(8 * (hi - lo)), ">i4").reshape(-1, 2) * 2
            dbf.seek(head + lo * width)
            for number, (at, size) in enumerate(places.tolist(), lo):
                shp.seek(at + 8)
                raw, row = shp.read(size), dbf.read(width)
                if row[:1] == b"*" or not self._near(raw, kind):
                    continue
                shape = _shape(raw, kind)
                pos, values = 1, []
                for name, length in fields:
                    if name in self.names:
                        values.append(row[pos : pos + length].decode("utf-8", "replace").strip() or None)
                    pos += length
                yield (*shape, *values, number)


def _shape(raw: bytes, kind: int) -> tuple:
    """x and y of a point, or the rings of a polygon one after the other, None between them; empty shapes are None."""
    empty = struct.unpack("<i", raw[:4])[0] == 0
    if kind in (1, 11, 21):
        return (None, None) if empty else struct.unpack("<dd", raw[4:20])
    if empty:
        return (None,)
    parts, points = struct.unpack("<ii", raw[36:44])
    starts = struct.unpack(f"<{parts}i", raw[44 : 44 + 4 * parts])
    ring: list = [(float(x), float(y)) for x, y in np.frombuffer(raw, "<f8", 2 * points, 44 + 4 * parts).reshape(-1, 2)]
    for start in reversed(starts[1:]):
        ring.insert(start, None)
    return (ring,)
