"""Spatial roles played by the star-schema tables, each as a DataFrame and as the SQL of the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.sources.tables import table

#: Common table expressions by role; ``with_roles`` puts those that a query names in front of it.
SQL = {
    "cell_gene": "SELECT l_suppkey AS cell_id, p_brand AS gene, ends_with(p_brand, '5') AS is_blank, sum(l_quantity) AS count FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL",
    "cells": "SELECT s_suppkey AS cell_id, n_name AS donor, r_name AS region, abs(s_acctbal) + 1 AS volume, CAST(s_suppkey % 17 AS DOUBLE) AS center_x, CAST(s_suppkey % 13 AS DOUBLE) AS center_y, CAST((s_suppkey * 37) % 101 AS DOUBLE) AS dapi, s_suppkey % 4 AS cluster FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "points": "SELECT event_id AS tx_id, event_type AS gene, value AS x, CAST(json_extract_string(props, '$.k') AS DOUBLE) + 0.5 AS y, CAST(event_id % 7 AS INTEGER) AS z, user_id AS cell_hint FROM events",
    "boxes": "SELECT s_suppkey AS entity_id, CAST((s_suppkey + k) % 7 AS INTEGER) AS z, CAST((s_suppkey * 7) % 90 AS DOUBLE) AS minx, CAST((s_suppkey * 13) % 90 AS DOUBLE) AS miny, CAST((s_suppkey * 7) % 90 + 6 + s_suppkey % 4 AS DOUBLE) AS maxx, CAST((s_suppkey * 13) % 90 + 6 + s_suppkey % 5 AS DOUBLE) AS maxy FROM supplier CROSS JOIN range(2) r(k)",
    "shapes": "SELECT s_suppkey AS entity_id, CAST((s_suppkey + k) % 7 AS INTEGER) AS z, CAST((s_suppkey * 7) % 90 AS DOUBLE) AS x0, CAST((s_suppkey * 13) % 90 AS DOUBLE) AS y0 FROM supplier CROSS JOIN range(2) r(k)",
    "outlines": "SELECT s_suppkey AS entity_id, CAST((s_suppkey + k) % 7 AS INTEGER) AS z, (s_suppkey * 7) % 90 AS x0, (s_suppkey * 13) % 90 AS y0, 6 + s_suppkey % 4 AS w, 6 + s_suppkey % 5 AS h, 2 + s_suppkey % 3 AS a, 3 + s_suppkey % 2 AS b, s_suppkey % 3 > 0 AS hole FROM supplier CROSS JOIN range(2) r(k)",
    "votes": "SELECT l_orderkey AS query_id, l_suppkey AS ref_id, CAST(l_discount AS DOUBLE) AS distance, s_nationkey AS label FROM lineitem JOIN supplier ON l_suppkey = s_suppkey",
    "labelled": "SELECT vec_id, label, vec_id % 2 AS is_query, CAST(vec_id % 9 AS INTEGER) AS cluster, embedding FROM embeddings",
}


def with_roles(sql: str) -> str:
    used = [f"{name} AS ({text})" for name, text in SQL.items() if f" {name}" in sql]
    body = sql.strip()
    if not used:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ", ".join([*used, body[15:]])
    return "WITH " + (", ".join([*used, body[5:]]) if body.upper().startswith("WITH ") else f"{', '.join(used)} {body}")


def cell_gene(spark: SparkSession, d: str) -> DataFrame:
    """(cell_id, gene, is_blank, count): stored, non-zero counts."""
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    gene = F.col("p_brand")
    return rows.groupBy(F.col("l_suppkey").alias("cell_id"), gene.alias("gene"), gene.endswith("5").alias("is_blank")).agg(F.sum("l_quantity").alias("count"))


def cells(spark: SparkSession, d: str) -> DataFrame:
    """(cell_id, donor, region, volume, center_x, center_y, dapi, cluster): the spine of all cells."""
    key = F.col("s_suppkey")
    rows = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.select(
        key.alias("cell_id"), F.col("n_name").alias("donor"), F.col("r_name").alias("region"), (F.abs("s_acctbal") + 1).alias("volume"),
        (key % 17).cast("double").alias("center_x"), (key % 13).cast("double").alias("center_y"), (key * 37 % 101).cast("double").alias("dapi"), (key % 4).alias("cluster"),
    )


def points(spark: SparkSession, d: str) -> DataFrame:
    """(tx_id, gene, x, y, z, cell_hint): detected transcripts."""
    y = F.get_json_object("props", "$.k").cast("double") + 0.5
    return table(spark, d, "events").select(F.col("event_id").alias("tx_id"), F.col("event_type").alias("gene"), F.col("value").alias("x"), y.alias("y"), (F.col("event_id") % 7).cast("int").alias("z"), F.col("user_id").alias("cell_hint"))


def boxes(spark: SparkSession, d: str) -> DataFrame:
    """(entity_id, z, minx, miny, maxx, maxy): the bounds of the outlines, on two planes each."""
    number = lambda c: c.cast("double")
    x, y, w, h = map(F.col, ("x0", "y0", "w", "h"))
    return outlines(spark, d).select("entity_id", "z", number(x).alias("minx"), number(y).alias("miny"), number(x + w).alias("maxx"), number(y + h).alias("maxy"))


def labelled(spark: SparkSession, d: str) -> DataFrame:
    """(vec_id, label, is_query, cluster, embedding): reference and query cells in one space."""
    v = F.col("vec_id")
    return table(spark, d, "embeddings").select("vec_id", "label", (v % 2).alias("is_query"), (v % 9).cast("int").alias("cluster"), "embedding")


#: Corners of a shape, from its own: the outer ring with a notch, and a hole.
OUTER, HOLE = [(0, 0), (9, 0), (9, 4), (4, 4), (4, 9), (0, 9)], [(1, 1), (2, 1), (2, 3), (1, 3)]


def shapes(spark: SparkSession, d: str) -> DataFrame:
    """(entity_id, z, x0, y0, polygon): notched polygons with a hole, on two planes each."""
    key = F.col("s_suppkey")
    rows = table(spark, d, "supplier").select(key.alias("entity_id"), F.explode(F.array(F.lit(0), F.lit(1))).alias("k"), (key * 7 % 90).cast("double").alias("x0"), (key * 13 % 90).cast("double").alias("y0"))
    ring = lambda corners: F.array(*[F.struct((F.col("x0") + x).alias("x"), (F.col("y0") + y).alias("y")) for x, y in corners])
    return rows.select("entity_id", ((F.col("entity_id") + F.col("k")) % 7).cast("int").alias("z"), "x0", "y0", F.array(ring(OUTER), ring(HOLE)).alias("polygon"))


def outlines(spark: SparkSession, d: str) -> DataFrame:
    """(entity_id, z, x0, y0, w, h, a, b, hole, polygon): notched polygons of many forms, two of three with a hole, on two planes each.

    A form is w wide and b tall, and h tall over its first a units.
    """
    key = F.col("s_suppkey")
    rows = table(spark, d, "supplier").select(
        key.alias("entity_id"), F.explode(F.array(F.lit(0), F.lit(1))).alias("k"), (key * 7 % 90).alias("x0"), (key * 13 % 90).alias("y0"),
        (6 + key % 4).alias("w"), (6 + key % 5).alias("h"), (2 + key % 3).alias("a"), (3 + key % 2).alias("b"), (key % 3 > 0).alias("hole"),
    )
    point = lambda x, y: F.struct((F.col("x0") + x).cast("double").alias("x"), (F.col("y0") + y).cast("double").alias("y"))
    w, h, a, b, none = F.col("w"), F.col("h"), F.col("a"), F.col("b"), F.lit(0)
    outer = F.array(point(none, none), point(w, none), point(w, b), point(a, b), point(a, h), point(none, h))
    hole = F.array(*[point(F.lit(x), F.lit(y)) for x, y in ((1, 1), (2, 1), (2, 2), (1, 2))])
    polygon = F.when(F.col("hole"), F.array(outer, hole)).otherwise(F.array(outer))
    return rows.select("entity_id", ((F.col("entity_id") + F.col("k")) % 7).cast("int").alias("z"), "x0", "y0", "w", "h", "a", "b", "hole", polygon.alias("polygon"))


def votes(spark: SparkSession, d: str) -> DataFrame:
    """(query_id, ref_id, distance, label): neighbours of each query with the label of each."""
    rows = table(spark, d, "lineitem").join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.select(F.col("l_orderkey").alias("query_id"), F.col("l_suppkey").alias("ref_id"), F.col("l_discount").cast("double").alias("distance"), F.col("s_nationkey").alias("label"))
