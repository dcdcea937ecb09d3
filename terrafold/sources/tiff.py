"""Tiled TIFF in Spark: a source with a partition a tile, reading of many scenes by the cells that are asked for, and a
writer whose tasks pack and write tiles.

Paths are those of a file system that all executors mount. Read are classic and big files, in tiles or strips, plain or
deflated, with or without horizontal differences, bands side by side or one after the other; anything else is an error.
Written are big files (64-bit offsets), with an overview for each halving down to one tile."""

from __future__ import annotations

import os
import shutil
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any, BinaryIO

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: Fixed values of the format: struct codes of field types, sample kinds, and tags by name.
_TYPES = {1: "B", 2: "c", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
_KINDS = {1: "u", 2: "i", 3: "f"}
_WIDTH, _HEIGHT, _BITS, _COMPRESSION, _STRIPS, _BANDS, _STRIP_ROWS, _STRIP_BYTES = 256, 257, 258, 259, 273, 277, 278, 279
_PLANES, _PREDICTOR, _TILE_WIDTH, _TILE_HEIGHT, _TILES, _TILE_BYTES, _KIND = 284, 317, 322, 323, 324, 325, 339
_SCALE, _TIE, _GEO, _NODATA = 33550, 33922, 34735, 42113


def local(path: str) -> str:
    return path.removeprefix("file://") if path.startswith("file:///") else path.removeprefix("file:")


@dataclass(frozen=True)
class Info:
    """One image of a file: its size, tiles and place. `order` is that of the file's bytes."""

    width: int
    height: int
    bands: int
    dtype: str
    tile_width: int
    tile_height: int
    compression: int
    predictor: int
    planes: int
    left: float
    top: float
    dx: float
    dy: float
    epsg: int | None
    nodata: float | None
    offsets: tuple[int, ...] = field(repr=False)
    sizes: tuple[int, ...] = field(repr=False)

    @property
    def across(self) -> int:
        return -(-self.width // self.tile_width)

    @property
    def down(self) -> int:
        return -(-self.height // self.tile_height)

    def index(self, row: int, col: int, band: int) -> int:
        """Where a tile stands in the lists; bands side by side share one."""
        return (band * self.down if self.planes == 2 else 0) * self.across + row * self.across + col


def images(f: BinaryIO) -> list[Info]:
    """The images of a file: the raster, then its overviews."""
    head = f.read(16)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    version = struct.unpack(f"{order or '<'}H", head[2:4])[0]
    if order is None or version not in (42, 43):
        raise ValueError("not a TIFF file")
    big = version == 43
    at = struct.unpack(f"{order}Q", head[8:16])[0] if big else struct.unpack(f"{order}I", head[4:8])[0]
    out: list[Info] = []
    while at:
        f.seek(at)
        n = struct.unpack(f"{order}{'Q' if big else 'H'}", f.read(8 if big else 2))[0]
        size, code = (20, "HHQ8s") if big else (12, "HHI4s")
        raw = f.read(size * n + (8 if big else 4))
        tags: dict[int, Any] = {}
        for i in range(n):
            tag, kind, count, value = struct.unpack(f"{order}{code}", raw[size * i : size * (i + 1)])
            if kind not in _TYPES:
                continue
            width = struct.calcsize(_TYPES[kind]) * count
            if width > len(value):
                f.seek(struct.unpack(f"{order}{'Q' if big else 'I'}", value)[0])
                value = f.read(width)
            tags[tag] = value[:width].split(b"\0")[0].decode() if kind == 2 else struct.unpack(f"{order}{count}{_TYPES[kind]}", value[:width])
        out.append(_info(tags, order, out[0] if out else None))
        at = struct.unpack(f"{order}{'Q' if big else 'I'}", raw[size * n :])[0]
    return out


def _info(tags: dict[int, Any], order: str, whole: Info | None) -> Info:
    first = lambda tag, default=None: tags[tag][0] if tag in tags else default
    width, height, bands = first(_WIDTH), first(_HEIGHT), first(_BANDS, 1)
    compression, predictor = first(_COMPRESSION, 1), first(_PREDICTOR, 1)
    if compression not in (1, 8, 32946) or predictor not in (1, 2):
        raise ValueError(f"compression {compression} with predictor {predictor} can't be read")
    tiled = _TILES in tags
    scale, tie, keys = tags.get(_SCALE), tags.get(_TIE), tags.get(_GEO, ())
    if scale and tie:
        dx, dy = scale[0], -scale[1]
        left, top = tie[3] - tie[0] * dx, tie[4] - tie[1] * dy
    elif whole is not None:  # an overview lies where the raster does
        left, top, dx, dy = whole.left, whole.top, whole.dx * whole.width / width, whole.dy * whole.height / height
    else:
        left, top, dx, dy = 0.0, 0.0, 1.0, 1.0
    codes = {keys[i]: keys[i + 3] for i in range(4, len(keys), 4) if keys[i + 1] == 0}
    return Info(
        width, height, bands, f"{order}{_KINDS[first(_KIND, 1)]}{first(_BITS, 8) // 8}",
        first(_TILE_WIDTH, width), first(_TILE_HEIGHT, first(_STRIP_ROWS, height)), compression, predictor, first(_PLANES, 1),
        left, top, dx, dy, codes.get(3072, codes.get(2048)), float(tags[_NODATA]) if tags.get(_NODATA) else None,
        tags[_TILES if tiled else _STRIPS], tags[_TILE_BYTES if tiled else _STRIP_BYTES],
    )


def header(path: str, level: int = 0) -> Info:
    with open(local(path), "rb") as f:
        return images(f)[level]


def tile_of(f: BinaryIO, info: Info, row: int, col: int, band: int) -> np.ndarray:
    """The pixels of a tile in one band, cut to the raster; a tile that was never written is all no-data."""
    at = info.index(row, col, band)
    height, width = min(info.tile_height, info.height - row * info.tile_height), min(info.tile_width, info.width - col * info.tile_width)
    dtype = np.dtype(info.dtype)
    if not info.sizes[at]:
        return np.full((height, width), info.nodata or 0, dtype.newbyteorder("="))
    f.seek(info.offsets[at])
    raw = f.read(info.sizes[at])
    if info.compression != 1:
        raw = zlib.decompress(raw)
    samples = 1 if info.planes == 2 else info.bands
    pixels = np.frombuffer(raw, dtype).reshape(-1, info.tile_width, samples).astype(dtype.newbyteorder("="))
    if info.predictor == 2:
        pixels = np.cumsum(pixels, axis=1, dtype=pixels.dtype)
    return pixels[:height, :width, 0 if info.planes == 2 else band]


class TiffSource(DataSource):
    """`spark.read.format("tiff").load(path)`: row, col, band (from 1), x, y (centres) and value, null where there is no data.

    Options: window (first column and row, last column and row) and bands (a comma list), by which tiles are chosen
    before any is read; level, an overview. A partition is a tile."""

    @classmethod
    def name(cls) -> str:
        return "tiff"

    def schema(self) -> str:
        return "row int, col int, band int, x double, y double, value double"

    def reader(self, schema) -> DataSourceReader:
        return _TiffReader(self.options)


class _TiffReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.level = options["path"], int(options.get("level", 0))
        self.info = header(self.path, self.level)
        window = options.get("window")
        self.window = tuple(int(v) for v in window.split(",")) if window else (0, 0, self.info.width - 1, self.info.height - 1)
        chosen = options.get("bands")
        self.bands = [int(b) for b in chosen.split(",")] if chosen else list(range(1, self.info.bands + 1))

    def partitions(self) -> list[InputPartition]:
        """The tiles that the window meets, a band at a time only where bands lie apart."""
        i, (c0, r0, c1, r1) = self.info, self.window
        rows = range(max(0, r0) // i.tile_height, min(r1, i.height - 1) // i.tile_height + 1)
        cols = range(max(0, c0) // i.tile_width, min(c1, i.width - 1) // i.tile_width + 1)
        groups = [[b] for b in self.bands] if i.planes == 2 else [self.bands]
        return [InputPartition((r, c, tuple(g))) for r in rows for c in cols for g in groups] or [InputPartition((0, 0, ()))]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        tile_row, tile_col, bands = partition.value
        i, (c0, r0, c1, r1) = self.info, self.window
        with open(local(self.path), "rb") as f:
            for band in bands:
                pixels = tile_of(f, i, tile_row, tile_col, band - 1)
                row, col = np.mgrid[0 : pixels.shape[0], 0 : pixels.shape[1]].reshape(2, -1)
                row, col, value = row + tile_row * i.tile_height, col + tile_col * i.tile_width, pixels.ravel().astype(float)
                inside = (row >= r0) & (row <= r1) & (col >= c0) & (col <= c1)
                row, col, value = row[inside], col[inside], value[inside]
                known = pa.array(value, mask=value == i.nodata if i.nodata is not None else None)
                x, y = i.left + (col + 0.5) * i.dx, i.top + (row + 0.5) * i.dy
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row, pa.int32()), pa.array(col, pa.int32()), pa.array(np.full(len(row), band), pa.int32()), pa.array(x), pa.array(y), known],
                    names=["row", "col", "band", "x", "y", "value"],
                )


#: Metres on a side of the cells by which scenes are read.
CELL = 5120.0
_TILE_ROWS = "scene {scene}, epsg int, asset string, path string, band int, trow int, tcol int, cx long, cy long"


def scene_tiles(assets: DataFrame, cell: float = CELL) -> DataFrame:
    """A row for each tile of each asset and cell that it meets. assets: scene, epsg, band (its name), path and, for files of
    several bands, number (from 1). Headers are read in the tasks, one file each."""

    def listed(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            for a in pdf.itertuples(index=False):
                i = header(a.path)
                out = []
                for r in range(i.down):
                    for c in range(i.across):
                        x = sorted((i.left + c * i.tile_width * i.dx, i.left + min((c + 1) * i.tile_width, i.width) * i.dx))
                        y = sorted((i.top + r * i.tile_height * i.dy, i.top + min((r + 1) * i.tile_height, i.height) * i.dy))
                        for cx in range(int(x[0] // cell), int(-(-x[1] // cell))):
                            out += [(a.scene, a.epsg, a.band, a.path, a.number, r, c, cx, cy) for cy in range(int(y[0] // cell), int(-(-y[1] // cell)))]
                yield pd.DataFrame(out, columns=["scene", "epsg", "asset", "path", "band", "trow", "tcol", "cx", "cy"])

    number = F.coalesce(F.col("number"), F.lit(1)) if "number" in assets.columns else F.lit(1)
    one = assets.select("scene", F.col("epsg").cast("int").alias("epsg"), "band", "path", number.cast("int").alias("number"))
    return one.repartition("path").mapInPandas(listed, _TILE_ROWS.format(scene=assets.schema["scene"].dataType.simpleString()))


def scene_pixels(assets: DataFrame, boxes: DataFrame, pixel: float = 10.0, mask: str = "SCL", cell: float = CELL) -> DataFrame:
    """Pixels as rows (scene, epsg, band, x, y, value, scl) of the cells that boxes (scene, epsg, x0, y0, x1, y1) touch.

    Tiles meet the cells that are asked for in an equi-join before any is read; a task then holds one scene's tiles of one
    cell, and takes for each pixel of the common grid the nearest of each asset; `mask` names the asset of scene classes.
    No-data pixels have no row."""
    asked = boxes.withColumn("cx", F.explode(F.sequence(F.floor(F.col("x0") / cell), F.floor(F.col("x1") / cell))))
    asked = asked.withColumn("cy", F.explode(F.sequence(F.floor(F.col("y0") / cell), F.floor(F.col("y1") / cell))))
    met = scene_tiles(assets, cell).join(asked.select("scene", "epsg", "cx", "cy").distinct(), ["scene", "epsg", "cx", "cy"], "left_semi")
    side = round(cell / pixel)

    def decoded(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        scene, epsg, cx, cy = key
        x, y = (k * cell + (np.arange(side) + 0.5) * pixel for k in (cx, cy))
        layers: dict[str, np.ndarray] = {}
        for (asset, path, band), tiles in pdf.sort_values(["asset", "path", "trow", "tcol"]).groupby(["asset", "path", "band"]):
            layer = layers.setdefault(asset, np.full((side, side), np.nan))
            with open(local(path), "rb") as f:
                i = images(f)[0]
                col, row = np.floor((x - i.left) / i.dx).astype(int), np.floor((y - i.top) / i.dy).astype(int)
                for t in tiles.itertuples(index=False):
                    pixels = tile_of(f, i, t.trow, t.tcol, band - 1).astype(float)
                    pixels[pixels == i.nodata] = np.nan
                    c, r = col - t.tcol * i.tile_width, row - t.trow * i.tile_height
                    at_c, at_r = np.flatnonzero((c >= 0) & (c < pixels.shape[1])), np.flatnonzero((r >= 0) & (r < pixels.shape[0]))
                    layer[np.ix_(at_r, at_c)] = pixels[np.ix_(r[at_r], c[at_c])]
        scl = layers.pop(mask, np.full((side, side), np.nan))
        out = []
        for asset, layer in layers.items():
            r, c = np.nonzero(~np.isnan(layer))
            out.append(pd.DataFrame({"scene": scene, "epsg": epsg, "band": asset, "x": x[c], "y": y[r], "value": layer[r, c], "scl": pd.array(scl[r, c]).astype("Int32")}))
        return pd.concat(out) if out else pd.DataFrame(columns=["scene", "epsg", "band", "x", "y", "value", "scl"])

    schema = f"scene {assets.schema['scene'].dataType.simpleString()}, epsg int, band string, x double, y double, value double, scl int"
    return met.groupBy("scene", "epsg", "cx", "cy").applyInPandas(lambda key, pdf: decoded(key, pdf), schema)


@dataclass(frozen=True)
class Grid:
    """Where a raster lies: its upper left corner, size, pixel and projection. epsg 32767 means a projection of one's own."""

    left: float
    top: float
    width: int
    height: int
    metres: float
    epsg: int


def overviews(width: int, height: int, tile: int) -> int:
    """How often a raster is halved until one tile holds it."""
    return max(0, (-(-max(width, height) // tile) - 1).bit_length())


def packed_tiles(rows: DataFrame, grid: Grid, bands: tuple[str, ...], dtype: str = "u1", nodata: float = 255, tile: int = 256) -> DataFrame:
    """level, row, col, data: the deflated tiles of rows (row, col and a column a band) and of every halving, for which each
    second pixel stands. A group is one tile; tiles without a row are left out."""
    levels = overviews(grid.width, grid.height, tile)
    every = f"explode(filter(sequence(0, {levels}), k -> row % shiftleft(1, k) = 0 and col % shiftleft(1, k) = 0))"
    spread = rows.select(F.expr(every).alias("level"), F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), *[F.col(b).cast("double").alias(f"b{k}") for k, b in enumerate(bands)])
    at = {n: F.expr(f"shiftright({n}, level)") for n in ("row", "col")}
    cut = spread.withColumns(at).withColumns({"trow": F.expr(f"row div {tile}").cast("int"), "tcol": F.expr(f"col div {tile}").cast("int")})

    def pack(table: pa.Table) -> pa.Table:
        pixels = np.full((tile, tile, len(bands)), nodata, np.dtype(dtype).newbyteorder("<"))
        r, c = (table[n].to_numpy() % tile for n in ("row", "col"))
        for k in range(len(bands)):
            value = table[f"b{k}"].to_numpy(zero_copy_only=False).astype(float)
            pixels[r, c, k] = np.where(np.isnan(value), nodata, value)
        return pa.table([*(table[n].slice(0, 1).cast(pa.int32()) for n in ("level", "trow", "tcol")), pa.array([zlib.compress(pixels.tobytes(), 6)], pa.binary())], names=["level", "row", "col", "data"])

    return cut.groupBy("level", "trow", "tcol").applyInArrow(pack, "level int, row int, col int, data binary")


class TiledTiffSink(DataSource):
    """Writes `packed_tiles` as one file. Tasks write their tiles to a part beside it; the commit puts the directory of all
    images before the parts, joins them in pieces of a megabyte, and moves the result to its name."""

    @classmethod
    def name(cls) -> str:
        return "tiled_tiff"

    def schema(self) -> str:
        return "level int, row int, col int, data binary"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _TiffWriter(dict(self.options))


@dataclass
class _Part(WriterCommitMessage):
    path: str
    tiles: list[tuple[int, int, int, int]]  # level, row, col, size, in the order of the file


class _TiffWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.options, self.path = options, local(options["path"])
        self.parts = f"{self.path}.parts-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        os.makedirs(self.parts, exist_ok=True)
        part = _Part(f"{self.parts}/{uuid.uuid4().hex}", [])
        with open(part.path, "wb") as f:
            for batch in iterator:
                for level, row, col, data in zip(*(batch[n].to_pylist() for n in ("level", "row", "col", "data")), strict=True):
                    f.write(data)
                    part.tiles.append((level, row, col, len(data)))
        return part

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        parts = [m for m in messages if m is not None]
        number = {n: int(self.options[n]) for n in ("width", "height", "tile", "bands", "bits", "kind", "epsg")}
        levels = overviews(number["width"], number["height"], number["tile"])
        blank = _directories(self.options, number, levels, {})
        at, places = len(blank), {}
        for p in parts:
            for level, row, col, size in p.tiles:
                places[level, row, col] = (at, size)
                at += size
        os.makedirs(self.parts, exist_ok=True)
        whole = f"{self.parts}/whole"
        with open(whole, "wb") as out:
            out.write(_directories(self.options, number, levels, places))
            for p in parts:
                with open(p.path, "rb") as f:
                    shutil.copyfileobj(f, out, 1 << 20)
        os.replace(whole, self.path)
        shutil.rmtree(self.parts, ignore_errors=True)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        shutil.rmtree(self.parts, ignore_errors=True)


def _directories(options: dict[str, str], number: dict[str, int], levels: int, places: dict[tuple[int, int, int], tuple[int, int]]) -> bytes:
    """The file's head and the directory of each image; as long whatever the places, so that they can be counted first."""
    head, at = struct.pack("<2sHHHQ", b"II", 43, 8, 0, 16), 16
    out = [head]
    tile, bands, metres = number["tile"], number["bands"], float(options["metres"])
    geo = struct.pack("<16H", 1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, 3072, 0, 1, number["epsg"])
    for level in range(levels + 1):
        width, height = (-(-number[n] // (1 << level)) for n in ("width", "height"))
        across, down = -(-width // tile), -(-height // tile)
        found = [places.get((level, r, c), (0, 0)) for r in range(down) for c in range(across)]
        nodata = options["nodata"].encode() + b"\0"
        tags: list[tuple[int, int, int, bytes]] = [
            (254, 4, 1, struct.pack("<I", level > 0)),
            (_WIDTH, 4, 1, struct.pack("<I", width)),
            (_HEIGHT, 4, 1, struct.pack("<I", height)),
            (_BITS, 3, bands, struct.pack(f"<{bands}H", *[number["bits"]] * bands)),
            (_COMPRESSION, 3, 1, struct.pack("<H", 8)),
            (262, 3, 1, struct.pack("<H", 1)),
            (_BANDS, 3, 1, struct.pack("<H", bands)),
            (_PLANES, 3, 1, struct.pack("<H", 1)),
            (_TILE_WIDTH, 4, 1, struct.pack("<I", tile)),
            (_TILE_HEIGHT, 4, 1, struct.pack("<I", tile)),
            (_TILES, 16, len(found), struct.pack(f"<{len(found)}Q", *[f[0] for f in found])),
            (_TILE_BYTES, 16, len(found), struct.pack(f"<{len(found)}Q", *[f[1] for f in found])),
            (_KIND, 3, bands, struct.pack(f"<{bands}H", *[number["kind"]] * bands)),
            (_SCALE, 12, 3, struct.pack("<3d", metres * (1 << level), metres * (1 << level), 0)),
            (_TIE, 12, 6, struct.pack("<6d", 0, 0, 0, float(options["left"]), float(options["top"]), 0)),
            (_GEO, 3, 16, geo),
            (_NODATA, 2, len(nodata), nodata),
        ]
        entries, extra = b"", b""
        tail = at + 8 + 20 * len(tags) + 8
        for tag, kind, count, value in sorted(tags):
            if len(value) > 8:
                entries += struct.pack("<HHQQ", tag, kind, count, tail + len(extra))
                extra += value + b"\0" * (-len(value) % 8)
            else:
                entries += struct.pack("<HHQ", tag, kind, count) + value.ljust(8, b"\0")
        at = tail + len(extra)
        out.append(struct.pack("<Q", len(tags)) + entries + struct.pack("<Q", at if level < levels else 0) + extra)
    return b"".join(out)


def write_raster(rows: DataFrame, path: str, grid: Grid, bands: tuple[str, ...], dtype: str = "u1", nodata: float = 255, tile: int = 256) -> str:
    """Writes rows (row, col and a column a band) as a tiled file with overviews; no array leaves a task. What stood under
    the path is replaced when all is written, and a stop before leaves it as it was."""
    kind = np.dtype(dtype)
    options = {"left": grid.left, "top": grid.top, "width": grid.width, "height": grid.height, "metres": grid.metres, "epsg": grid.epsg}
    options |= {"tile": tile, "bands": len(bands), "bits": 8 * kind.itemsize, "kind": {v: k for k, v in _KINDS.items()}[kind.kind], "nodata": nodata}
    os.makedirs(os.path.dirname(local(path)) or ".", exist_ok=True)
    register(rows.sparkSession)
    packed_tiles(rows, grid, bands, dtype, nodata, tile).write.format("tiled_tiff").options(**{k: str(v) for k, v in options.items()}).mode("append").save(local(path))
    return path


def register(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(TiffSource)
    spark.dataSource.register(TiledTiffSink)
    return spark
