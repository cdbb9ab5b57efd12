"""Sinks: tables that are overwritten, written once or only if missing, upserted by key, or split into files by group."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions import geometry as G
from tessella.sources.readers import exists

#: What happens if the table exists.
MODES = {"overwrite": "overwrite", "once": "errorifexists", "skip": "ignore", "append": "append"}


def write(rows: DataFrame, path: str, mode: str = "overwrite", by: tuple[str, ...] = (), kind: str = "parquet") -> None:
    """Write a table. ``overwrite`` with ``by`` replaces only the partitions that ``rows`` has; ``once`` raises and ``skip`` does nothing if it exists."""
    writer = rows.write.mode(MODES[mode]).format(kind)
    if kind == "csv":
        writer = writer.option("header", True)
    if by:
        writer = writer.partitionBy(*by).option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def _swap(spark, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path``; the old one is kept aside until the new one is there."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = Path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    old = f"{path}-old-{uuid.uuid4().hex}"
    if fs.exists(Path(path)):
        fs.rename(Path(path), Path(old))
    if not fs.rename(Path(new), Path(path)):
        fs.rename(Path(old), Path(path))
        raise OSError(f"{new} can't take the place of {path}")
    fs.delete(Path(old), True)


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``old`` whose key (nulls are equal) is not in ``new``, and all of ``new``."""
    gone = new.select(*keys).distinct().toDF(*[f"new_{k}" for k in keys])
    same = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"new_{k}"))
        same = one if same is None else same & one
    return old.join(gone, same, "left_anti").unionByName(new, allowMissingColumns=True)


def upsert(new: DataFrame, path: str, keys: list[str], kind: str = "parquet") -> None:
    """Replace the rows of a table that have a key of ``new``; other rows stay, and a table that is missing begins with ``new``."""
    spark = new.sparkSession
    if not exists(spark, path):
        return write(new, path, "once", kind=kind)
    reader = spark.read.format(kind)
    old = (reader.option("header", True).schema(new.schema) if kind == "csv" else reader).load(path)
    fresh = f"{path}-new-{uuid.uuid4().hex}"
    write(upserted(old, new, keys), fresh, "once", kind=kind)
    return _swap(spark, fresh, path)


def write_transcripts(points: DataFrame, assigned: DataFrame, path: str, kind: str = "csv") -> None:
    """Transcripts with the cell that they are assigned to, -1 for none, in one table."""
    out = points.drop("cell_id").join(assigned.select("tx_id", "cell_id"), "tx_id", "left").fillna(-1, ["cell_id"])
    write(out, path, "overwrite", kind=kind)


def write_groups(rows: DataFrame, path: str, group: str = "cell_type", kind: str = "csv") -> None:
    """One folder of files for each group, named by it, and all of them as one table when read back."""
    write(rows, path, "overwrite", (group,), kind)


def geojson_features(rows: DataFrame, polygon: str = "polygon") -> DataFrame:
    """(value): a GeoJSON feature a row, with all other columns as properties."""
    closed = F.transform(polygon, lambda r: F.transform(F.concat(r, F.slice(r, 1, 1)), lambda p: F.array(p["x"], p["y"])))
    properties = F.struct(*[c for c in rows.columns if c != polygon])
    return rows.select(F.to_json(F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), F.struct(F.lit("Polygon").alias("type"), closed.alias("coordinates")).alias("geometry"))).alias("value"))


def write_geometry(rows: DataFrame, path: str, kind: str = "parquet", polygon: str = "polygon") -> None:
    """Polygons as text in a parquet table, or as lines of GeoJSON features."""
    if kind == "geojson":
        geojson_features(rows, polygon).write.mode("overwrite").text(path)
    else:
        write(rows.withColumn("geometry", G.to_wkt(F.col(polygon))).drop(polygon), path)


def nested_json(rows: DataFrame, levels: list[str], leaf: list[str]) -> DataFrame:
    """(first level, json): a list of ``leaf`` structs under each deeper level, in order; one row for each value of the first level."""
    out = rows.groupBy(*levels).agg(F.array_sort(F.collect_list(F.struct(*leaf))).alias("items"))
    for depth in range(len(levels) - 1, 0, -1):
        entry: Column = F.struct(F.col(levels[depth]), F.col("items"))
        out = out.groupBy(*levels[:depth]).agg(F.array_sort(F.collect_list(entry)).alias("items"))
    return out.select(levels[0], F.to_json("items").alias("json"))
