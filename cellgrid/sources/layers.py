"""Layers, documents and logs: packed layers with metadata, GeoJSON, CSV, JSON lines, catalogues."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellgrid.functions.cells import decode_layer, encode_layer
from cellgrid.session import nan_to_null, require_columns


def layer_stats(cells: DataFrame, value: str, mask: Column | None = None) -> DataFrame:
    """min, p10, mean, p50, p90, max, n of the grid and, if there is a mask, of the cells under it."""
    scopes = [(F.lit("grid"), F.lit(True))] + ([(F.lit("mask"), mask)] if mask is not None else [])
    scope = F.explode(F.filter(F.array(*[F.when(c, n) for n, c in scopes]), lambda s: s.isNotNull()))
    points = F.percentile("_v", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    out = nan_to_null(cells).select(scope.alias("scope"), F.col(value).alias("_v")).groupBy("scope")
    out = out.agg(F.min("_v").alias("min"), points.alias("_p"), F.avg("_v").alias("mean"), F.max("_v").alias("max"), F.count("_v").alias("n"))
    return out.select("scope", "min", F.col("_p")[0].alias("p10"), "mean", F.col("_p")[1].alias("p50"), F.col("_p")[2].alias("p90"), "max", "n")


def write_layer(cells: DataFrame, value: str, path: str, scale: float, offset: float, meta: Mapping[str, str], mask: Column | None = None) -> None:
    """Codes by cell as Parquet, sorted within files by row so that boxes prune; metadata and statistics as JSON."""
    codes = cells.select("row", "col", encode_layer(F.col(value), scale, offset).alias("code"))
    codes.repartitionByRange("row").sortWithinPartitions("row", "col").write.mode("overwrite").parquet(f"{path}/codes")
    stats = layer_stats(cells, value, mask).withColumns({k: F.lit(v) for k, v in meta.items()})
    stats.withColumns({"scale": F.lit(scale), "offset": F.lit(offset)}).coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def read_layer(spark: SparkSession, path: str, name: str, box: tuple[int, int, int, int] | None = None) -> DataFrame:
    """row, col, value; box: first row, last row, first column, last column, pushed down to the files."""
    meta = spark.read.json(f"{path}/meta").select("scale", "offset").first()
    codes = spark.read.parquet(f"{path}/codes")
    if box:
        codes = codes.filter(F.col("row").between(box[0], box[1]) & F.col("col").between(box[2], box[3]))
    return codes.select("row", "col", decode_layer(F.col("code"), meta["scale"], meta["offset"]).alias(name))


def read_layers(spark: SparkSession, paths: Mapping[str, str], required: Sequence[str], optional: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """All layers side by side by cell, and the optional ones that are missing; a missing required one is an error."""
    missing = [n for n in optional if n not in paths]
    absent = [n for n in required if n not in paths]
    if absent:
        raise ValueError(f"missing required layers: {', '.join(absent)}")
    layers = [read_layer(spark, paths[n], n) for n in [*required, *optional] if n in paths]
    return reduce(lambda a, b: a.join(b, ["row", "col"], "left"), layers), missing


def geojson(features: DataFrame, geometry: str, digits: int = 6) -> DataFrame:
    """value: one Feature a line; geometry is struct<type, coordinates: array<array<double>>>, other columns properties."""
    require_columns(features, [geometry])
    points = F.transform(F.col(f"{geometry}.coordinates"), lambda p: F.transform(p, lambda v: F.round(v, digits)))
    shape = F.struct(F.col(f"{geometry}.type").alias("type"), points.alias("coordinates"))
    rest = F.struct(*[c for c in features.columns if c != geometry])
    return features.select(F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), rest.alias("properties"))).alias("value"))


def write_csv(df: DataFrame, path: str) -> None:
    """Scalars only, quoted, quotes doubled, one header a file."""
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("struct", "array", "map")]
    df.select(*plain).write.mode("overwrite").csv(path, header=True, quoteAll=True, escape='"')


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All lines; those that don't parse come as nulls."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def catalogue(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """path, length, title, unit, note of the metadata files under a folder; an unreadable one becomes a note."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    made = F.from_json(F.decode("content", "UTF-8"), "title string, unit string", {"mode": "PERMISSIVE"})
    out = files.select("path", "length", made.alias("m"))
    bad = F.col("m.title").isNull() & F.col("m.unit").isNull()
    return out.select("path", "length", F.col("m.title").alias("title"), F.col("m.unit").alias("unit"), F.when(bad, "unreadable").alias("note"))


def unseen(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Work that is not on the list of what is done."""
    return items.join(done, key, "left_anti")


def read_present(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A JSON table, or nothing if the path isn't there; any other failure is an error."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e.getCondition() or e):
            return None
        raise


def continuous(parts: Sequence[DataFrame], keys: Sequence[str], day: str) -> DataFrame:
    """Several parts of a daily series as one, later parts first where they overlap; adds joined: the day before is there."""
    marked = [p.withColumn("_part", F.lit(k)) for k, p in enumerate(parts)]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    last = Window.partitionBy(*keys, day).orderBy(F.desc("_part"))
    one = every.withColumn("_r", F.row_number().over(last)).filter("_r = 1").drop("_r", "_part")
    before = F.lag(day).over(Window.partitionBy(*keys).orderBy(day))
    return one.withColumn("joined", before.isNull() | (F.datediff(day, before) == 1))


def shifted(cells: DataFrame, rows: int, cols: int) -> DataFrame:
    """A layer on a lattice whose corner lies a whole number of cells away."""
    return cells.withColumns({"row": F.col("row") + rows, "col": F.col("col") + cols})


def month_slices(spark: SparkSession, path: str, month: str, first: str, last: str, value: str) -> DataFrame:
    """Slices of a table partitioned by month, only the asked ones read; negative values are no data."""
    rows = spark.read.parquet(path).filter(F.col(month).between(first, last))
    return rows.withColumn(value, F.when(F.col(value) >= 0, F.col(value)))


def missing_months(rows: DataFrame, month: str, first: str, last: str) -> DataFrame:
    """Months (yyyy-MM) from first to last that the table lacks."""
    dates = [F.to_date(F.lit(f"{m}-01")) for m in (first, last)]
    wanted = rows.sparkSession.range(1).select(F.explode(F.sequence(dates[0], dates[1], F.expr("interval 1 month"))).alias("_d"))
    return wanted.select(F.date_format("_d", "yyyy-MM").alias(month)).join(rows.select(month).distinct(), month, "left_anti")


def documents_by(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """value: one JSON document for each key, its rows nested in order, NaN as null."""
    rest = [c for c in rows.columns if c not in keys]
    made = nan_to_null(rows).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, *[c for c in rest if c != order]))).alias("rows"))
    return made.select(*keys, F.to_json(F.struct(*keys, "rows")).alias("value"))


def element_counts(elements: DataFrame, kind: str, tags: str, points: str, wanted: str, box: tuple[float, float, float, float]) -> DataFrame:
    """kind, n, untagged, short (fewer than two points of a way) and outside (no point in the box x0, y0, x1, y1)."""
    inside = F.exists(points, lambda p: p["x"].between(box[0], box[2]) & p["y"].between(box[1], box[3]))
    count = lambda c, name: F.count(F.when(c, 1)).alias(name)
    return elements.groupBy(kind).agg(
        F.count("*").alias("n"), count(F.try_element_at(F.col(tags), F.lit(wanted)).isNull(), "untagged"),
        count((F.col(kind) == "way") & (F.size(points) < 2), "short"), count(~inside, "outside"),
    )


#: Fields of a scene catalogue that are kept.
SCENE = "id string, datetime timestamp, platform string, path string, row string, tier string, cloud double, assets map<string,string>"


def scenes(spark: SparkSession, path: str, manifest: str | None = None) -> DataFrame:
    """A scene catalogue (JSON lines), only the known fields, by time and id; without it, the ids of a manifest (one a line)."""
    found = read_present(spark, path, SCENE)
    if found is None:
        if manifest is None:
            raise ValueError(f"no catalogue at {path}, and no manifest")
        found = spark.read.text(manifest).select(F.trim("value").alias("id")).filter("id <> ''")
        for part in SCENE.split(", ")[1:]:
            name, kind = part.split(" ", 1)
            found = found.withColumn(name, F.lit(None).cast(kind))
    return found.orderBy("datetime", "id")


def stations(rows: DataFrame, lat: str, lon: str, value: str, box: tuple[float, float, float, float]) -> tuple[DataFrame, DataFrame]:
    """Rows of text columns in a box (south, north, west, east) with numbers, and the rows whose numbers don't parse."""
    cast = lambda c: F.expr(f"try_cast(`{c}` as double)")
    made = rows.withColumns({f"_{k}": cast(c) for k, c in enumerate((lat, lon, value))})
    bad = F.col("_0").isNull() | F.col("_1").isNull() | (F.col("_2").isNull() & F.col(value).isNotNull())
    inside = F.col("_0").between(box[0], box[1]) & F.col("_1").between(box[2], box[3])
    rest = [c for c in rows.columns if c not in (lat, lon, value)]
    good = made.filter(~bad & inside).select(*rest, F.col("_0").alias(lat), F.col("_1").alias(lon), F.col("_2").alias(value))
    return good, rows.join(made.filter(bad).select(*rows.columns), rows.columns, "left_semi")


def complete(pages: DataFrame, key: str, expected: int) -> DataFrame:
    """Pages of a service put together: each key once; an error unless there are as many as the service says."""
    one = pages.dropDuplicates([key])
    found = one.count()
    if found != expected:
        raise ValueError(f"{found} rows of {expected}: pages are missing")
    return one
