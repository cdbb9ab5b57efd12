"""Readers of the tables that segmentations and instruments leave behind: everything becomes long tables with fixed columns.

A region is a value of a column, not a loop: paths may hold wildcards, and ``region`` comes from the path. Rows: missing optional files give
null or identity, as each function says; blank lines are no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import geometry as G
from tessella.operators import columns as C

#: Column names of one assignment-native tool, to those used here.
POINTS = {"transcript_id": "tx_id", "x": "x", "y": "y", "z": "z", "gene": "gene"}
TRANSCRIPTS = "tx_id bigint, gene string, x double, y double, z int"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether any file system that Spark knows has ``path``, which may hold wildcards."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(place))


def resolve_file(spark: SparkSession, folder: str, canonical: str, legacy: str) -> str:
    """The canonical file if it is there, else the legacy one if that is, else the canonical name."""
    return f"{folder}/{legacy if not exists(spark, f'{folder}/{canonical}') and exists(spark, f'{folder}/{legacy}') else canonical}"


def region_folder(spark: SparkSession, store: str, experiment: str, region: str, label: str, must_exist: bool = False) -> str:
    """``experiment/region/label``, or ``experiment/label/region`` where only that is there."""
    first, second = f"{store}/{experiment}/{region}/{label}", f"{store}/{experiment}/{label}/{region}"
    if exists(spark, first):
        return first
    if exists(spark, second):
        return second
    if must_exist:
        raise FileNotFoundError(f"neither {first} nor {second}")
    return first


def read_table(spark: SparkSession, path: str, where: dict[str, str] | None = None, fallback: str | None = None) -> DataFrame:
    """A parquet table, only the partitions that ``where`` names; from ``fallback`` if the path is missing."""
    rows = spark.read.parquet(path if fallback is None or exists(spark, path) else fallback)
    for name, value in (where or {}).items():
        rows = rows.where(F.col(name) == value)
    return rows


def read_any(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV (also compressed) or parquet, by the name."""
    if ".csv" in path.rsplit("/", 1)[-1]:
        reader = spark.read.option("header", True)
        return reader.schema(schema).option("enforceSchema", False).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    return spark.read.parquet(path)


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """All regions of an experiment in one table: ``path`` holds ``region_*``, which becomes the column ``region``."""
    rows = read_any(spark, path)
    return rows.withColumn("region", F.regexp_extract("_metadata.file_path", r"/(region_[^/]+)/", 1))


def long_counts(wide: DataFrame, cell: str, rule: str = "any") -> DataFrame:
    """(cell_id, gene, is_blank, count) of a wide matrix with one column a gene; zeros are left out."""
    genes = [c for c in wide.columns if c != cell]
    long = wide.select(F.col(f"`{cell}`").cast("string").alias("cell_id"), *[F.col(f"`{g}`").cast("double").alias(g) for g in genes]).unpivot(["cell_id"], genes, "gene", "count")
    return long.where("count <> 0").select("cell_id", "gene", C.is_blank(F.col("gene"), rule).alias("is_blank"), "count")


def read_counts(spark: SparkSession, path: str, cell: str | None = None, rule: str = "any") -> DataFrame:
    wide = read_any(spark, path)
    return long_counts(wide, cell or (wide.columns[0] if not set(C.ID_COLUMNS) & set(wide.columns) else C.id_column(wide.columns)), rule)


def with_transcript_count(obs: DataFrame, counts: DataFrame) -> DataFrame:
    """``obs`` with ``transcript_count`` anew: the counts of genes that do not start with ``Blank-``."""
    n = counts.where(~C.is_blank(F.col("gene"), "start")).groupBy("cell_id").agg(F.sum("count").alias("transcript_count"))
    return obs.drop("transcript_count").join(n, "cell_id", "left").fillna(0, ["transcript_count"])


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """(properties, polygon) of every part of every feature of GeoJSON files, also compressed; a part keeps its place in ``part``."""
    shape = "features array<struct<properties:string,geometry:struct<type:string,coordinates:string>>>"
    rows = spark.read.schema(shape).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    one, many = "array<array<array<double>>>", "array<array<array<array<double>>>>"
    parts = F.when(F.col("f.geometry.type") == "MultiPolygon", F.from_json("f.geometry.coordinates", many)).otherwise(F.array(F.from_json("f.geometry.coordinates", one)))
    point = lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))
    ring = lambda r: F.transform(F.slice(r, 1, F.greatest(F.size(r) - 1, F.lit(0))), point)
    out = rows.where(F.col("f.geometry.type").isin("Polygon", "MultiPolygon")).select(F.col("f.properties").alias("properties"), F.posexplode(parts).alias("part", "rings"))
    return out.select("properties", "part", F.transform("rings", ring).alias("polygon"))


def read_boundaries(spark: SparkSession, path: str, cell: str = "cell", geometry: str = "geometry") -> DataFrame:
    """(entity_id as text, z, polygon), one row an entity and plane: the part of the largest area of each. Parquet keeps polygons as text."""
    if "json" in path.rsplit("/", 1)[-1]:
        found = read_geojson(spark, path)
        get = lambda k: F.get_json_object("properties", f"$.{k}")
        rows = found.select(get(cell).alias("entity_id"), F.coalesce(get("z_layer"), get("z"), get("ZIndex"), F.lit("0")).cast("int").alias("z"), "polygon")
    else:
        found = spark.read.parquet(path)
        z = next((c for c in ("z_layer", "z", "ZIndex") if c in found.columns), None)
        parts = found.select(F.col(cell).cast("string").alias("entity_id"), (F.col(z) if z else F.lit(0)).cast("int").alias("z"), F.explode(G.parts_of_wkt(F.col(geometry))).alias("polygon"))
        rows = parts
    best = F.max_by("polygon", F.coalesce(G.area(F.col("polygon")), F.lit(0.0)))
    return rows.where(F.size("polygon") > 0).groupBy("entity_id", "z").agg(best.alias("polygon"))


def read_points(spark: SparkSession, path: str, names: dict[str, str] | None = None) -> DataFrame:
    """Transcripts with the names used here; other columns stay."""
    rows = read_any(spark, path)
    return rows.withColumnsRenamed({a: b for a, b in (names or POINTS).items() if a in rows.columns})


def read_affine(spark: SparkSession, path: str, strict: bool = True) -> list[list[float]]:
    """A matrix of numbers between white space; ``strict`` asks for 3 x 3. A file of a few lines, read by the driver."""
    lines = [r["value"].split() for r in spark.read.text(path).where(F.trim("value") != "").limit(64).collect()]
    out = [[float(x) for x in line] for line in lines]
    if strict and (len(out) != 3 or any(len(r) != 3 for r in out)):
        raise ValueError(f"{path} is not a 3 x 3 matrix")
    return out


def read_channels(spark: SparkSession, path: str) -> DataFrame:
    """The channel table of a data organisation file; columns that hold ``[0, 1, 2]`` become arrays, and ``pattern`` is the files' name."""
    rows = spark.read.option("header", True).csv(path)
    numbers = lambda c: F.transform(F.split(F.regexp_replace(c, r"[\[\]\s]", ""), ","), lambda x: x.cast("double"))
    lists = [c for c in rows.columns if c in ("frame", "zPos")]
    out = rows.withColumns({c: numbers(F.col(c)) for c in lists})
    if {"imageType", "imageRegExp"} <= set(out.columns):
        out = out.withColumn("pattern", F.concat("imageType", F.lit("_"), "imageRegExp"))
    return out


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """(gene) of a file with one name a line."""
    return spark.read.text(path).select(F.trim("value").alias("gene")).where("gene <> ''").distinct()


def read_renames(spark: SparkSession, path: str) -> DataFrame:
    """(gene, new_gene) of a JSON object; no rows where the file is missing."""
    if not exists(spark, path):
        return spark.createDataFrame([], "gene string, new_gene string")
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias("gene", "new_gene"))


def naming_map(spark: SparkSession, path: str) -> DataFrame:
    """A CSV whose column ``Name`` is the key."""
    return spark.read.option("header", True).csv(path)


def with_names(rows: DataFrame, names: DataFrame, lab: str | None = None) -> DataFrame:
    """Columns of the naming map by ``experiment_region`` (and ``_lab``); null where there is no entry."""
    key = F.concat_ws("_", "experiment", "region", *([F.lit(lab)] if lab else []))
    right = names.select(F.col("Name").alias("naming_key"), *[c for c in names.columns if c not in ("Name", *rows.columns)]).dropDuplicates(["naming_key"])
    return rows.join(right, key == F.col("naming_key"), "left").drop("naming_key")


@dataclass(frozen=True)
class Spec:
    """What a segmentation's folder holds and under which names."""

    boundaries: str
    counts: str
    transcripts: str
    metadata: str | None = None
    cell: str = "cell"
    geometry: str = "geometry"
    blank_rule: str = "any"
    points: dict[str, str] = field(default_factory=lambda: dict(POINTS))


#: Specifications by the tool's name; users add their own.
SPECS: dict[str, Spec] = {
    "polygons": Spec("boundaries.parquet", "cell_by_gene.csv", "transcripts.parquet", "cell_metadata.csv"),
    "native": Spec("cell-polygons.geojson.gz", "expected-counts.csv.gz", "transcript-metadata.csv.gz", "cell-metadata.csv.gz", blank_rule="start"),
}


def load_segmentation(spark: SparkSession, folder: str, spec: Spec | str, tags: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """``boundaries``, ``counts``, ``transcripts`` and ``cells`` of one segmentation; cells are those of the metadata, else those with counts."""
    s = SPECS[spec] if isinstance(spec, str) else spec
    counts = read_counts(spark, f"{folder}/{s.counts}", s.cell, s.blank_rule)
    if s.metadata:
        obs = read_any(spark, f"{folder}/{s.metadata}")
        cells = obs.withColumn("cell_id", F.col(C.id_column(obs.columns, s.cell)).cast("string"))
    else:
        cells = counts.select("cell_id").distinct()
    cells = with_transcript_count(cells, counts) if s.blank_rule == "start" else cells
    return {
        "boundaries": read_boundaries(spark, f"{folder}/{s.boundaries}", s.cell, s.geometry), "counts": counts,
        "transcripts": read_points(spark, f"{folder}/{s.transcripts}", s.points), "cells": C.tagged(cells, tags or {}),
    }
