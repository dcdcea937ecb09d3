"""`python -m terrafold.cli VERB ...`: the engine's verbs over files."""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.operators import adapters, campaign, crosswalk, filters, head, manifest, spatial, split, stats
from terrafold.shipping import ship
from terrafold.sources import files, sinks, tiff
from terrafold.sources.store import Store


def parse_bbox(text: str) -> tuple[float, float, float, float]:
    """minlon,minlat,maxlon,maxlat"""
    try:
        x0, y0, x1, y1 = (float(v) for v in text.split(","))
    except ValueError as e:
        raise argparse.ArgumentTypeError(f"not four numbers: {text!r}") from e
    if not (x0 < x1 and y0 < y1):
        raise argparse.ArgumentTypeError(f"the lower corner must come first: {text!r}")
    return x0, y0, x1, y1


def provinces(rings: DataFrame, names: list[str], field: str = "shapeName", south: float = -35.0) -> DataFrame:
    """Parts of the named provinces on the mainland; a name that isn't there is an error. A part lies where an inner point
    of it does: half way between the vertices next to the middle of its box."""
    named = rings.withColumn("province", F.trim(F.get_json_object("properties", f"$.{field}")))
    asked = [n.strip().lower() for n in names]
    have = {r[0] for r in named.select(F.lower("province")).distinct().take(10_000)}
    if missing := sorted(set(asked) - have):
        raise ValueError(f"no such province: {missing}")
    ys = F.filter(F.transform("ring", lambda v: v["y"]), lambda y: y.isNotNull())
    half = (F.array_min(ys) + F.array_max(ys)) / 2
    inner = (F.array_max(F.filter(ys, lambda y: y <= half)) + F.coalesce(F.array_min(F.filter(ys, lambda y: y > half)), F.array_max(ys))) / 2
    return named.where(F.lower("province").isin(*asked) & (inner > south)).select("order", "province", "ring")


def _outline(spark: SparkSession, path: str, most: int = 2_000_000) -> spatial.Outline:
    """All rings of an area in Albers metres, None between them; an area of over `most` vertices is an error."""
    from terrafold.functions import geo

    vertex = F.posexplode(F.concat("ring", F.array(F.lit(None)))).alias("i", "v")
    rows = files.read_geojson(spark, path).select(F.monotonically_increasing_id().alias("part"), "ring").select("part", vertex)
    if rows.limit(most + 1).count() > most:
        raise ValueError(f"{path} has more than {most} vertices: simplify it first")
    rows = geo.apply(rows.select("part", "i", F.col("v.x").alias("lon"), F.col("v.y").alias("lat")), geo.albers("lon", "lat"))
    return [None if r["x"] is None else (r["x"], r["y"]) for r in rows.orderBy("part", "i").collect()]


def _classes(a: argparse.Namespace) -> crosswalk.ClassMap:
    return crosswalk.build(files.load_config(a.schema).get("class_maps", {}), a.class_map)


def aoi(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    return provinces(files.read_geojson(spark, a.source), a.provinces, a.field)


def aoi_tiles(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    return spatial.grid(spark, _outline(spark, a.aoi), a.km, 0.01)


def labels_bioscape_ingest(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    numbers = ("GPS_PlotCenter_Latitude", "GPS_PlotCenter_Longitude", "PercentCoverAlive", "PercentCoverDead")
    sites = files.read_csv(spark, a.sites, numbers).withColumn("row", F.monotonically_increasing_id())
    rows = [adapters.bioscape_line(files.read_csv(spark, a.lines), sites, _classes(a), not a.all)] if a.lines else []
    rows += [adapters.bioscape_plot(files.read_csv(spark, a.plots, numbers), sites, _classes(a), not a.all)] if a.plots else []
    return _upsert(spark, a, rows, "BioSCape_VegPlots_Berg_Eerste_2425")


def labels_mapwaps_ingest(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    spark.dataSource.register(files.ShapefileSource)
    survey = adapters.CATCHMENTS[a.catchment]
    if survey.src_zone is None and files.declared_crs(a.points) is None:
        raise ValueError(f"{a.points} declares no projection, and none is known for {a.catchment}")
    points = spark.read.format("shapefile").load(a.points).withColumnRenamed("record", "row")
    return _upsert(spark, a, [adapters.mapwaps(points, survey)], a.catchment)


def labels_sanlc_ingest(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    spark.dataSource.register(files.ShapefileSource)
    parts = []
    for year, path in (p.split("=", 1) for p in a.points):
        shp = spark.read.format("shapefile").load(files.shapefile_in(path))
        name = "Acc_Cls_Na" if "Acc_Cls_Na" in shp.columns else "Class_name"
        parts.append(shp.select(F.lit(int(year)).alias("year"), F.col(name).alias("cname"), F.col("x").alias("lon"), F.col("y").alias("lat")))
    points = parts[0]
    for p in parts[1:]:
        points = points.unionByName(p)
    points = filters.clip(points.withColumn("obs_id", F.monotonically_increasing_id().cast("string")), files.read_geojson(spark, a.aoi), boundary=False)
    biomes = _biomes(spark, a.biomes, points)
    return _upsert(spark, a, [adapters.sanlc(points, biomes, Store(spark, a.root).read())], "sanlc_accuracy_points")


def _biomes(spark: SparkSession, path: str, points: DataFrame) -> DataFrame:
    """order, ring and T_BIOME of the polygons near the points, of a shapefile in degrees or of GeoJSON."""
    if path.endswith(".shp"):
        box = points.agg(F.min("lon"), F.min("lat"), F.max("lon"), F.max("lat")).first()
        near = spark.read.format("shapefile").option("columns", "T_BIOME").option("bbox", ",".join(str(v) for v in box) if box[0] is not None else "0,0,0,0")
        return near.load(path).where("ring is not null").withColumnRenamed("record", "order")
    return files.read_geojson(spark, path).withColumn("T_BIOME", F.get_json_object("properties", "$.T_BIOME")).drop("properties")


def _upsert(spark: SparkSession, a: argparse.Namespace, parts: list[DataFrame], dataset: str) -> DataFrame:
    from terrafold.sources.store import run_id

    store, run = Store(spark, a.root), run_id(dataset)
    for part in parts:
        store.upsert(part.withColumns({"ingested_at": F.current_timestamp(), "ingest_run_id": F.lit(run)}), dataset, run)
    return stats.source_summary(store.read())


def _labels(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    rule = filters.LabelFilter(species=tuple(a.species) if a.species else None, max_uncertainty=a.max_coord_uncertainty_m, date_min=a.date_min, date_max=a.date_max, bbox=a.bbox)
    return filters.select_labels(Store(spark, a.root).read(), rule, files.read_geojson(spark, a.aoi) if a.aoi else None)


def labels(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Writes and shows the store's summary; gives the filtered labels."""
    sinks.write_summary(Store(spark, a.root).read(), a.summary_out or f"{a.root}/summary.parquet").show(100, truncate=False)
    return _labels(spark, a)


def ingest_chips(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Extracts the chips that the manifest under --out-prefix lacks; without --scenes and --pixels, lists them."""
    from terrafold.functions.scalars import year_or
    from terrafold.operators.dedup import thin

    if bool(a.scenes) != bool(a.pixels):
        raise ValueError("--scenes and --pixels go together")
    cfg = files.load_config(a.pipeline)
    rows = _labels(spark, a).where("geom_type = 'point'")
    rows = rows.withColumns({"zone": adapters.zone_of("aoi_admin1", cfg.get("admin1_zone")), "year": year_or("event_date", a.default_year)})
    outline = _outline(spark, a.aoi or cfg["aoi"]["train_path"])
    rows = spatial.assign_blocks(thin(rows, a.thin_m, "species_normalized"), spatial.grid(spark, outline, a.block_km, 0.001), a.block_km, origin=spatial.lower_corner(outline))
    rows = rows.select("obs_id", "species_normalized", "lon", "lat", "year", "zone", "block_id")
    c = campaign.Campaign(a.out_prefix, cfg["months_by_zone"], cloud_max=cfg.get("cloud_cover_max", 40), most_scenes=cfg.get("max_scenes_per_composite"), bands=tuple(cfg["s2_bands"]))
    if a.scenes:
        # labels of some species know nothing of the other species' chips
        return campaign.run(rows, spark.read.parquet(a.scenes), spark.read.parquet(a.pixels), c, prune=not a.species)
    wanted = manifest.windows(rows.withColumn("months", campaign.months_of(F.col("zone"), c.months)))
    return wanted.join(manifest.todo(wanted, sinks.read_manifest(spark, a.out_prefix)), ["obs_id", "month_label"], "left_semi")


def chips_stats(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    m = spark.read.parquet(a.manifest)
    for title, df in (
        ("overview", stats.overview(m)),
        ("species", stats.top(stats.species_stats(m), "n_obs", "species", a.top_species)),
        ("months", stats.month_completeness(m)),
        ("blocks", stats.top(stats.distinct_by(m, "block_id"), "n_obs", "block_id", a.top_blocks)),
        ("dominated by one block", stats.dominance(m)),
        ("years", stats.distinct_by(m, "year")),
    ):
        print(title)
        df.show(a.top_species, truncate=False)
    return stats.cumulative_share(m)


def make_split(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Splits the manifest's observations; with --out-prefix writes folds, lists and split.parquet there, and keeps the folds of blocks that have one."""
    classes = _classes(a) if a.class_map else None
    folds = f"{a.out_prefix}/block_folds.parquet"
    locked = sinks.load_folds(spark, folds) if a.out_prefix and not a.no_lock_folds else None
    rows = split.make_split(spark.read.parquet(a.manifest), classes, a.species or None, a.min_class_obs, train=a.train_frac, val=a.val_frac, seed=a.seed, locked=locked)
    if a.out_prefix:
        sinks.write_split(rows, a.out_prefix)
        now = rows.select("block_id", "fold").distinct()
        if locked:  # blocks that have no row this time stay locked
            now = now.unionByName(spark.createDataFrame(sorted(locked.items()), "block_id int, fold string")).distinct()
        sinks.save_folds(now, folds)
    stats.fold_balance(rows).show()
    for key in ("species", "class_id") if classes else ("species",):
        stats.fold_matrix(rows, key).orderBy(key).show(1000, truncate=False)
    if classes:
        stats.composition_text(rows).orderBy("class_id").show(1000, truncate=False)
    return rows


def embed(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    from terrafold.operators.raster import RawStats
    from terrafold.operators.raster import embed as run

    return run(spark.read.parquet(a.stacks), RawStats(), tuple(a.shape))


def train_head(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    rows = spark.read.parquet(a.emb).join(spark.read.parquet(a.split), "obs_id").select(F.col("emb").alias("embedding"), F.col("class_id").alias("label"), "fold")
    h = head.train(rows, a.arch, a.weight)
    if a.save:
        Path(a.save).write_text(json.dumps(h.to_row()))
    return spark.createDataFrame([(k, float(v)) for k, v in h.report.items()], "measure string, value double")


def infer(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """A map with the raw-statistics features of a pixel: of --composites (tile, height, width, months, bands, data), or of
    --bbox from --scenes and --pixels, then written to --raster in Albers, or with --native in the box's own zone."""
    from terrafold.operators import inference

    h = head.Head.from_row(json.loads(Path(a.ckpt).read_text()))

    def score(stacks):
        n, t, c, y, x = stacks.shape
        p, o = h.probabilities(stacks.transpose(0, 3, 4, 1, 2).reshape(-1, t * c).astype(float))
        return p.reshape(n, y, x, -1), o.reshape(n, y, x)

    if a.composites:
        return inference.blend_map(inference.predict_windows(spark.read.parquet(a.composites), score, views=a.tta_views), h.classes)
    if not (a.bbox and a.scenes and a.pixels and a.pipeline):
        raise ValueError("either --composites, or --bbox with --scenes, --pixels and --pipeline")
    cfg = files.load_config(a.pipeline)
    windows = [(m["label"], *(f"{a.year}-{str(m[e])[5:]}" for e in ("start", "end"))) for m in cfg["months"]]
    box = inference.box_of(spark, a.bbox)
    tile = inference.composite(spark.read.parquet(a.pixels), spark.read.parquet(a.scenes), a.bbox, box, windows, list(cfg["s2_bands"]), cfg.get("cloud_cover_max", 95), cfg.get("max_scenes_per_composite"))
    cells = inference.blend_map(inference.predict_windows(tile, score, views=a.tta_views), h.classes)
    if a.native:
        rows, place, epsg = cells.select(F.col("y").alias("row"), F.col("x").alias("col"), "class_id", "confidence", "ood"), (box.x0, box.y0, box.width, box.height), box.epsg
    else:
        rows, place = inference.to_albers(cells, box)
        epsg = 32767
    if a.raster:
        left, top, width, height = place
        tiff.write_raster(rows, a.raster, tiff.Grid(left, top, width, height, box.metres, epsg), ("class_id", "confidence", "ood"), nodata=inference.NODATA)
    return rows


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="terrafold")
    verbs = top.add_subparsers(dest="verb", required=True)

    def verb(name: str, run, **options) -> None:
        p = verbs.add_parser(name, help=(run.__doc__ or name).splitlines()[0])
        p.set_defaults(run=run)
        p.add_argument("--out")
        for key, value in options.items():
            flag = f"--{key.replace('_', '-')}"
            if value is bool:
                p.add_argument(flag, action="store_true")
            elif isinstance(value, list):
                p.add_argument(flag, nargs="*", default=value, type=int if value and isinstance(value[0], int) else str)
            elif callable(value):
                p.add_argument(flag, type=value)
            else:
                p.add_argument(flag, default=value, type=type(value) if value is not None else str, required=value == "")

    query = {"root": "data/labels/processed", "aoi": None, "species": [], "max_coord_uncertainty_m": 500.0, "date_min": "2018-01-01", "date_max": None, "bbox": parse_bbox}
    verb("aoi-wc", aoi, source="", field="shapeName", provinces=["Western Cape"])
    verb("aoi-sa", aoi, source="", field="shapeName", provinces=["Western Cape", "Eastern Cape", "Northern Cape", "Free State", "KwaZulu-Natal", "North West", "Gauteng", "Mpumalanga", "Limpopo"])
    verb("aoi-tiles", aoi_tiles, aoi="", km=10.0)
    verb("labels-bioscape-ingest", labels_bioscape_ingest, root="data/labels/processed", sites="", lines=None, plots=None, schema="configs/labels_schema.yaml", class_map="western_cape_iap", all=bool)
    verb("labels-mapwaps-ingest", labels_mapwaps_ingest, root="data/labels/processed", points="", catchment="")
    verb("labels-sanlc-ingest", labels_sanlc_ingest, root="data/labels/processed", points=[], aoi="", biomes="")
    verb("labels", labels, **query | {"summary_out": None})
    chips = {"max_coord_uncertainty_m": 40.0, "date_max": "2025-12-31", "pipeline": "", "out_prefix": "data/chips/train", "scenes": None, "pixels": None, "block_km": 10.0, "thin_m": 20.0, "default_year": 2023}
    verb("ingest-chips", ingest_chips, **query | chips)
    verb("chips-stats", chips_stats, manifest="", top_species=30, top_blocks=10)
    verb("make-split", make_split, manifest="", species=[], class_map=None, schema="configs/labels_schema.yaml", seed=42, train_frac=0.7, val_frac=0.15, min_class_obs=0, out_prefix=None, no_lock_folds=bool)
    verb("embed", embed, stacks="", shape=[3, 10, 64, 64])
    verb("train-head", train_head, emb="", split="", arch="linear", weight="balanced", save=None)
    verb("infer", infer, composites=None, ckpt="", tta_views=1, bbox=parse_bbox, year=2023, pipeline=None, scenes=None, pixels=None, native=bool, raster=None)
    return top


def main(args: list[str] | None = None) -> None:
    a = parser().parse_args(args)
    spark = ship(SparkSession.builder.appName(f"terrafold {a.verb}").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    result = a.run(spark, a)
    if a.out:
        result.write.mode("overwrite").option("compression", "zstd").parquet(a.out)
    else:
        result.show(50, truncate=False)


if __name__ == "__main__":
    main()
