"""Grids, and joins of points with blocks, polygons and each other, all as equi-joins on cells."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrafold.functions import geo


Outline = list[tuple[float, float] | None]


def rings_of(outline: Outline) -> list[tuple[float, list[tuple[float, float]]]]:
    """The rings of an outline, of which None parts one from the next, each with its sign: -1 within an odd number of others."""
    rings, begun = [], False
    for v in outline:
        if v is None:
            begun = False
        elif begun:
            rings[-1].append(v)
        else:
            rings.append([v])
            begun = True

    def holds(ring: list, x: float, y: float) -> bool:
        return sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in zip(ring, ring[1:] + ring[:1], strict=True)) % 2 == 1

    return [((-1.0) ** sum(holds(o, *r[0]) for o in rings if o is not r), r) for r in rings]


def clip_area(ring: list[tuple[float, float]], x0: float, y0: float, x1: float, y1: float) -> float:
    """Area of a ring within a box: four half-plane cuts, then the shoelace formula."""
    points = ring[:-1] if ring and ring[0] == ring[-1] else list(ring)
    for axis, bound, sign in ((0, x0, 1), (0, x1, -1), (1, y0, 1), (1, y1, -1)):
        kept = []
        for i, p in enumerate(points):
            q = points[(i + 1) % len(points)]
            dp, dq = sign * (p[axis] - bound), sign * (q[axis] - bound)
            if dp >= 0:
                kept.append(p)
            if (dp > 0 > dq) or (dp < 0 < dq):
                t = dp / (dp - dq)
                kept.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        points = kept
        if not points:
            return 0.0
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:] + points[:1], strict=True))) / 2


def grid(spark: SparkSession, ring: Outline, km: float, min_share: float) -> DataFrame:
    """block_id, ix, iy, box and lon/lat ring of the cells over an area given in Albers metres.

    Cells start at the area's own lower corner, run by columns, stay if more than `min_share` of them lies
    in the area, and are then numbered from 0. Areas are computed in tasks, one row a cell."""
    step = km * 1000.0
    x0, y0 = lower_corner(ring)
    x1, y1 = max(p[0] for p in ring if p), max(p[1] for p in ring if p)
    rings = rings_of(ring)
    nx, ny = max(1, int(-(-(x1 - x0) // step))), max(1, int(-(-(y1 - y0) // step)))
    cells = spark.range(nx * ny).select((F.col("id") / ny).cast("int").alias("ix"), (F.col("id") % ny).cast("int").alias("iy"))

    def share(pdfs):
        for pdf in pdfs:
            boxes = [(x0 + i * step, y0 + j * step, x0 + (i + 1) * step, y0 + (j + 1) * step) for i, j in zip(pdf.ix, pdf.iy, strict=True)]
            yield pdf.assign(share=[sum(sign * clip_area(r, *box) for sign, r in rings) / step**2 for box in boxes])

    kept = cells.mapInPandas(share, "ix int, iy int, share double").where(F.col("share") > min_share)
    numbered = kept.withColumn("block_id", (F.row_number().over(Window.orderBy("ix", "iy")) - 1).cast("int"))
    corner = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for k, (dx, dy) in enumerate(((0, 0), (1, 0), (1, 1), (0, 1)))]))
    corners = numbered.withColumn("_c", corner).withColumns({"cx_": F.lit(x0) + (F.col("ix") + F.col("_c.dx")) * F.lit(step), "cy_": F.lit(y0) + (F.col("iy") + F.col("_c.dy")) * F.lit(step)})
    corners = geo.apply(corners, geo.albers_inverse("cx_", "cy_", "clon_", "clat_"))
    rings = corners.groupBy("block_id", "ix", "iy", "share").agg(
        *[f(c).alias(n) for n, f, c in (("minx", F.min, "cx_"), ("miny", F.min, "cy_"), ("maxx", F.max, "cx_"), ("maxy", F.max, "cy_"))],
        F.array_sort(F.collect_list(F.struct(F.col("_c.k").alias("k"), F.col("clon_").alias("x"), F.col("clat_").alias("y")))).alias("_r"),
    )
    vertices = F.transform("_r", lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y")))
    return rings.withColumn("ring", F.concat(vertices, F.slice(vertices, 1, 1))).drop("_r")


def lower_corner(ring: Outline) -> tuple[float, float]:
    """Where the grid over an area starts."""
    return min(p[0] for p in ring if p), min(p[1] for p in ring if p)


def assign_blocks(points: DataFrame, blocks: DataFrame, km: float, slack: float = 2.0, origin: tuple[float, float] | None = None, straight: str = "degrees") -> DataFrame:
    """Adds block_id; points in no block go. `origin` is the `lower_corner` of the grid's area; without it, a look at the
    blocks finds it.

    A point's cell comes from its Albers place. `straight` says where block edges are straight lines. In "degrees", within
    `slack` metres of a cell's edge the neighbouring cells are candidates too and the block's ring decides; points
    on an edge between blocks go. In "metres" the cell is the block, and its lower edges belong to it."""
    if straight not in ("degrees", "metres"):
        raise ValueError(f"straight: {straight}")
    step = km * 1000.0
    if origin is None:
        low = blocks.agg(F.min("minx"), F.min("miny"), F.min("ix"), F.min("iy")).first()
        if low[0] is None:
            return points.withColumn("block_id", F.lit(None).cast("int")).where(F.lit(False))
        origin = (low[0] - low[2] * step, low[1] - low[3] * step)
    x0, y0 = origin
    placed = geo.apply(points, geo.albers("lon", "lat", "ax_", "ay_"))
    if straight == "metres":
        at = {n: F.floor((F.col(axis) - base) / step).cast("int") for n, axis, base in (("ix", "ax_", x0), ("iy", "ay_", y0))}
        return placed.withColumns(at).join(blocks.select("block_id", "ix", "iy"), ["ix", "iy"]).select(*points.columns, "block_id")

    def cells(axis: str, base: float) -> Column:
        v = (F.col(axis) - base) / step
        lo, hi = F.floor(v - slack / step), F.floor(v + slack / step)
        return F.when(lo == hi, F.array(lo)).otherwise(F.array(lo, hi))

    near = placed.withColumn("_ixs", cells("ax_", x0)).withColumn("_iys", cells("ay_", y0))
    near = near.withColumn("_edge", (F.size("_ixs") > 1) | (F.size("_iys") > 1))
    near = near.withColumn("ix", F.explode("_ixs")).withColumn("iy", F.explode("_iys")).withColumns({"ix": F.col("ix").cast("int"), "iy": F.col("iy").cast("int")})
    met = near.join(blocks.select("block_id", "ix", "iy", "ring"), ["ix", "iy"])
    found = met.where(~F.col("_edge") | geo.in_ring("lon", "lat", "ring", boundary=False))
    return found.select(*points.columns, "block_id")


#: Degrees on a side of the cells of polygons, from the first to the one that every cell comes to, by halves; a cell in
#: which more than `MOST_EDGES` edges begin is halved `HALVES` times more, down to the last of `LEVELS`.
ROOT, BASE, HALVES, LEVELS, MOST_EDGES = 16.0, 0.25, 3, 5, 128


def _parity(seed: Column, pairs: Column, px: Column, py: Column, x: Column, y: Column) -> Column:
    """Whether (x, y) is inside, from whether (px, py) is (`seed`), the lower left corner of a cell that holds both, and the
    edges that meet the cell. The way goes up the cell's left side, then to the right, and turns with each edge that it
    crosses. All decisions about an edge are made by its x at a latitude, computed as `geo.in_edges` does, so they agree."""

    def turns(e: Column) -> Column:
        a, b = e["a"], e["b"]

        def spans(v: Column) -> Column:
            return (a["y"] > v) != (b["y"] > v)

        def at(v: Column) -> Column:
            return (b["x"] - a["x"]) * (v - a["y"]) / F.when(b["y"] == a["y"], 1e0).otherwise(b["y"] - a["y"]) + a["x"]

        def right(v: Column) -> Column:
            """Whether the edge, or its nearer end, lies right of the cell's left side at a latitude."""
            above, below = F.when(a["y"] >= b["y"], a["x"]).otherwise(b["x"]), F.when(a["y"] >= b["y"], b["x"]).otherwise(a["x"])
            return F.when(spans(v), at(v) > px).when(v >= F.greatest(a["y"], b["y"]), above > px).otherwise(below > px)

        up = ((a["x"] > px) != (b["x"] > px)) & (right(py) != right(y))
        along = spans(y) & (at(y) > px) & (at(y) <= x)
        return up != along

    return seed != (F.size(F.filter(pairs, turns)) % 2 == 1)


def _inside(e: np.ndarray, seed: bool, px: float, py: float, x: float, y: float) -> bool:
    """`_parity` of edges in four rows: ax, ay, bx, by."""
    ax, ay, bx, by = e

    def at(v: float) -> np.ndarray:
        return (bx - ax) * (v - ay) / np.where(by == ay, 1.0, by - ay) + ax

    def right(v: float) -> np.ndarray:
        above, below = np.where(ay >= by, ax, bx), np.where(ay >= by, bx, ax)
        return np.where((ay > v) != (by > v), at(v) > px, np.where(v >= np.maximum(ay, by), above > px, below > px))

    up = ((ax > px) != (bx > px)) & (right(py) != right(y))
    along = ((ay > y) != (by > y)) & (at(y) > px) & (at(y) <= x)
    return seed != bool((up != along).sum() % 2)


def _cut(e: np.ndarray, cx: int, cy: int, seed: bool, size: float, last: float) -> Iterator[tuple[int, int, bool, np.ndarray]]:
    """Cells of the `last` size in a cell of this one that a polygon touches, with edges or inside it, and the edges of each. A
    quarter is made from the edges of the cell it quarters."""
    stack = [(cx, cy, seed, size, e)]
    while stack:
        cx, cy, seed, size, e = stack.pop()
        if not seed and not e.shape[1]:
            continue
        if size <= last:
            yield cx, cy, seed, e
            continue
        half, low, high = size / 2, np.minimum(e[:2], e[2:]), np.maximum(e[:2], e[2:])
        for i in (2 * cx, 2 * cx + 1):
            for j in (2 * cy, 2 * cy + 1):
                x, y = i * half, j * half
                near = (high[0] >= x) & (low[0] <= x + half) & (high[1] >= y) & (low[1] <= y + half)
                stack.append((i, j, _inside(e, seed, cx * size, cy * size, x, y), half, e[:, near]))


_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
_EDGE = pa.struct([("a", _POINT), ("b", _POINT)])
_CELL = "_cx bigint, _cy bigint, _seed boolean, _e array<struct<a:struct<x:double,y:double>,b:struct<x:double,y:double>>>"


def _with_cells(df: DataFrame, column: str, cells: Callable[[pa.RecordBatch], Iterator[tuple[int, tuple[int, int, bool, np.ndarray]]]]) -> DataFrame:
    """Rows of `df` without some columns, once for each cell that `cells` gives for its place in a batch."""
    kept = [c for c in df.columns if c not in ("_cx", "_cy", "_seed", "_e", column)]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(cells(batch))
            rows, made = [r for r, _ in found], [c for _, c in found]
            flat = np.concatenate([np.zeros((4, 0)), *[c[3] for c in made]], axis=1)
            ends = [pa.StructArray.from_arrays([pa.array(flat[k]), pa.array(flat[k + 1])], fields=list(_POINT)) for k in (0, 2)]
            bounds = pa.array(np.concatenate([[0], np.cumsum([c[3].shape[1] for c in made])]), pa.int32())
            pairs = pa.ListArray.from_arrays(bounds, pa.StructArray.from_arrays(ends, fields=list(_EDGE)))
            new = [pa.array([c[k] for c in made], t) for k, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(n).take(pa.array(rows, pa.int64())) for n in kept), *new, pairs], names=[*kept, "_cx", "_cy", "_seed", "_e"])

    schema = ", ".join([*(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in kept), _CELL])
    return df.mapInArrow(step, schema)


def polygon_cells(polygons: DataFrame) -> DataFrame:
    """A row for each polygon and cell of `BASE` degrees that it touches: _cx, _cy, _seed (is the cell's lower left corner
    inside?), _e (the edges that meet the cell), and the polygon's columns but for its ring. A polygon is cut in the task that
    reads it, quarter by quarter, so that each edge is looked at about four times a halving."""

    def cells(batch: pa.RecordBatch) -> Iterator[tuple[int, tuple[int, int, bool, np.ndarray]]]:
        for row, ring in enumerate(batch.column("ring")):
            if not ring.is_valid or len(ring) < 2:
                continue
            v = ring.values
            x, y = (v.field(n).to_numpy(zero_copy_only=False).astype(float) for n in ("x", "y"))
            known = v.is_valid().to_numpy(zero_copy_only=False)
            e = np.stack([x[:-1], y[:-1], x[1:], y[1:]])[:, known[:-1] & known[1:]]
            if not e.shape[1]:
                continue
            x0, y0, x1, y1 = (int(f(e[k::2]) // ROOT) for f, k in ((np.min, 0), (np.min, 1), (np.max, 0), (np.max, 1)))
            for cx in range(x0, x1 + 1):
                for cy in range(y0, y1 + 1):
                    px, py = cx * ROOT, cy * ROOT
                    with np.errstate(all="ignore"):
                        crossed = ((e[1] > py) != (e[3] > py)) & (px < (e[2] - e[0]) * (py - e[1]) / np.where(e[3] == e[1], 1.0, e[3] - e[1]) + e[0])
                        yield from ((row, c) for c in _cut(e, cx, cy, bool(crossed.sum() % 2), ROOT, BASE))

    return _with_cells(polygons, "ring", cells)


def _split(cells: DataFrame, size: float, last: float) -> DataFrame:
    """Cells of this size cut to ones of the `last`."""

    def finer(batch: pa.RecordBatch) -> Iterator[tuple[int, tuple[int, int, bool, np.ndarray]]]:
        for row, (cx, cy, seed, pairs) in enumerate(zip(*(batch.column(n) for n in ("_cx", "_cy", "_seed", "_e")), strict=True)):
            v = pairs.values
            e = np.stack([v.field(n).field(axis).to_numpy(zero_copy_only=False) for n in ("a", "b") for axis in ("x", "y")])
            yield from ((row, c) for c in _cut(e, cx.as_py(), cy.as_py(), seed.as_py(), size, last))

    return _with_cells(cells, "_e", finer)


def _begins(x: Column, y: Column, size: float) -> Callable[[Column], Column]:
    return lambda e: (e["a"]["x"] >= x) & (e["a"]["x"] < x + size) & (e["a"]["y"] >= y) & (e["a"]["y"] < y + size)


def _within(px: Column, py: Column, boundary: bool) -> Callable[[Column], Column]:
    """Whether a polygon of a cell holds the point of the row."""

    def holds(p: Column) -> Column:
        inside, on = _parity(p["_seed"], p["_e"], px, py, F.col("lon"), F.col("lat")), geo.on_edges("lon", "lat", p["_e"])
        return (inside | on) if boundary else (inside & ~on)

    return holds


def join_polygons(points: DataFrame, polygons: DataFrame, boundary: bool = False, most_edges: int = MOST_EDGES) -> DataFrame:
    """Left join of points with the polygon they lie in (`order`, `ring`, attributes); the first wins. boundary: what a point
    on an edge is.

    Polygons are cut to cells (`polygon_cells`), and a cell's polygons are one row, in their order; a point joins the one
    row of its cell and meets the edges of that cell only. Cells with too many edges are marked there; they are split
    again, and their points join once more. So a point is moved once for each level it needs, and never multiplied."""
    extra = [c for c in polygons.columns if c not in ("ring", "order")]
    cells, size, rest, parts = polygon_cells(polygons), BASE, points, []
    for level in range(LEVELS):
        here = rest.withColumn("_cx", F.floor(F.col("lon") / size)).withColumn("_cy", F.floor(F.col("lat") / size))
        heavy = None
        if level < LEVELS - 1:
            x, y = F.col("_cx") * F.lit(size), F.col("_cy") * F.lit(size)
            # edges that begin in the cell: those that only pass would pass its parts too
            own = F.size(F.filter("_e", _begins(x, y, size)))
            heavy = cells.groupBy("_cx", "_cy").agg(F.sum(own).alias("_n")).where(F.col("_n") > most_edges).select("_cx", "_cy")
            heavy = None if heavy.isEmpty() else heavy
        light = cells if heavy is None else cells.join(heavy, ["_cx", "_cy"], "left_anti")
        rows = light.groupBy("_cx", "_cy").agg(F.sort_array(F.collect_list(F.struct("order", "_seed", "_e", *extra))).alias("_near")).withColumn("_deeper", F.lit(False))
        if heavy is not None:
            rows = rows.unionByName(heavy.withColumn("_deeper", F.lit(True)), allowMissingColumns=True)
        met = here.join(rows, ["_cx", "_cy"], "left")
        px, py = F.col("_cx") * F.lit(size), F.col("_cy") * F.lit(size)

        found = met.where(F.coalesce(~F.col("_deeper"), F.lit(True))).withColumn("_first", F.get(F.filter("_near", _within(px, py, boundary)), F.lit(0)))
        parts.append(found.select(*points.columns, *[F.col(f"_first.{c}").alias(c) for c in extra]))
        if heavy is None:
            break
        rest = met.where("_deeper").select(*points.columns)
        cells, size = _split(cells.join(heavy, ["_cx", "_cy"], "left_semi"), size, size / 2**HALVES), size / 2**HALVES
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def away_from(points: DataFrame, others: DataFrame, metres: float, zone: int = 34) -> DataFrame:
    """Points with no other point within a distance: two anti-joins on cells.

    Of cells whose diagonal is below the distance, a point that shares one with another point is near it, whatever else lies
    there, so dense places are settled without a pair. What is left meets the cells of the distance around it, and of
    these the distinct other points, up to the first that is near."""
    here = geo.apply(points, geo.utm("lon", "lat", zone, x="px_", y="py_"))
    there = geo.apply(others.select("lon", "lat").distinct(), geo.utm("lon", "lat", zone, x="qx_", y="qy_")).select("qx_", "qy_")
    own = 0.7 * metres  # the diagonal is 0.99 of the distance
    taken = there.select(F.floor(F.col("qx_") / own).alias("_sx"), F.floor(F.col("qy_") / own).alias("_sy")).distinct()
    alone = here.withColumns({"_sx": F.floor(F.col("px_") / own), "_sy": F.floor(F.col("py_") / own)}).join(taken, ["_sx", "_sy"], "left_anti")
    alone = alone.withColumn("_cx", F.floor(F.col("px_") / metres)).withColumn("_cy", F.floor(F.col("py_") / metres))
    around = F.sequence(F.lit(-1), F.lit(1))
    there = there.withColumn("_dx", F.explode(around)).withColumn("_dy", F.explode(around))
    there = there.select("qx_", "qy_", (F.floor(F.col("qx_") / metres) + F.col("_dx")).alias("_ox"), (F.floor(F.col("qy_") / metres) + F.col("_dy")).alias("_oy"))
    near = (F.col("px_") - F.col("qx_")) ** 2 + (F.col("py_") - F.col("qy_")) ** 2 < metres * metres
    return alone.join(there, (F.col("_cx") == F.col("_ox")) & (F.col("_cy") == F.col("_oy")) & near, "left_anti").select(points.columns)
