"""The driver's tables as terrain: points, rasters, extents, triangles, faces, voxels, legends and features.

Each adapter is a projection of one table. SQL has the same projections for the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RASTER_WIDTH = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, lon, lat, h of events."""
    i = F.col("event_id")
    return table(spark, sf_dir, "events").select(i.alias("id"), (F.lit(-180.0) + (i * 7919 % 360000) / 1000.0).alias("lon"), (F.lit(-90.0) + (i * 104729 % 180000) / 1000.0).alias("lat"), F.col("value").alias("h"))


def raster_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raster, row, col, z: one raster for each label, a row for each vector."""
    rows = table(spark, sf_dir, "embeddings").withColumn("row", F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1)
    return rows.select(F.col("label").alias("raster"), "row", F.posexplode("embedding").alias("col", "e")).select("raster", "row", "col", (F.col("e").cast("double") * 1000.0).alias("z"))


def rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raster, width, height and extent; neighbours overlap by half."""
    k = F.col("label")
    low = F.lit(-180.0) + k * 30.0
    return table(spark, sf_dir, "embeddings").groupBy("label").agg(F.count("*").cast("int").alias("height")).select(k.alias("raster"), F.lit(RASTER_WIDTH).alias("width"), "height", low.alias("min_lon"), F.lit(-60.0).alias("min_lat"), (low + 60.0).alias("max_lon"), F.lit(60.0).alias("max_lat"))


def extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, extent and pixel size of orders."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    low_x, low_y = F.lit(-180.0) + (o * 37 % 3500) / 10.0, F.lit(-90.0) + (o * 53 % 1700) / 10.0
    return table(spark, sf_dir, "orders").select(o.alias("id"), low_x.alias("min_lon"), low_y.alias("min_lat"), F.least(F.lit(180.0), low_x + 0.1 + (c % 90) / 10.0).alias("max_lon"), F.least(F.lit(90.0), low_y + 0.1 + (c % 80) / 10.0).alias("max_lat"), (1 + c % 500).cast("double").alias("pixel"))


def triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id and three corners (lon, lat, h) of line items."""
    a, b, c = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    at = lambda k, n: (k % n).cast("double")
    return table(spark, sf_dir, "lineitem").select(
        (a * 8 + F.col("l_linenumber")).alias("id"),
        (at(a * 17, 3590) / 10.0 - 180.0).alias("x0"), (at(b * 13, 1790) / 10.0 - 90.0).alias("y0"), F.col("l_quantity").alias("z0"),
        (at(a * 17, 3590) / 10.0 - 180.0 + 0.1 + at(c, 7) / 10.0).alias("x1"), (at(b * 13, 1790) / 10.0 - 90.0).alias("y1"), (F.col("l_extendedprice") / 1000.0).alias("z1"),
        (at(a * 17, 3590) / 10.0 - 180.0).alias("x2"), (at(b * 13, 1790) / 10.0 - 90.0 + 0.1 + at(b, 5) / 10.0).alias("y2"), (F.col("l_discount") * 100.0).alias("z2"),
    )


def faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """face, v0, v1, v2: corners by id."""
    return table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("face"), (F.col("l_partkey") % 500).alias("v0"), (F.col("l_suppkey") % 97 + 500).alias("v1"), (F.col("l_orderkey") % 800 + 600).alias("v2"))


def voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ix, iy, iz, alpha and the order in which a part sets its voxel."""
    p = F.col("p_partkey")
    return table(spark, sf_dir, "part").select((p % 8).cast("int").alias("ix"), (F.expr("p_partkey div 8") % 8).cast("int").alias("iy"), (F.expr("p_partkey div 64") % 8).cast("int").alias("iz"), (F.col("p_size") * 5).cast("int").alias("alpha"), p.alias("seq"))


def legend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """value and colour of nations."""
    k = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select((k * 20.0).alias("value"), (k * 37 % 256).cast("int").alias("r"), (k * 59 % 256).cast("int").alias("g"), (k * 83 % 256).cast("int").alias("b"))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, name, segment, nation and height of customers."""
    return table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation"), F.col("c_acctbal").alias("height"))


SQL = {
    "pts": "SELECT event_id AS id, -180.0::DOUBLE + ((event_id * 7919) % 360000)::DOUBLE / 1000.0::DOUBLE AS lon, -90.0::DOUBLE + ((event_id * 104729) % 180000)::DOUBLE / 1000.0::DOUBLE AS lat, value AS h FROM events",
    "cells": "SELECT label AS raster, r AS row, i - 1 AS col, embedding[i]::DOUBLE * 1000.0::DOUBLE AS z FROM (SELECT label, embedding, (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1)::INT AS r FROM embeddings), unnest(range(1, 65)) AS t(i)",
    "ras": "SELECT label AS raster, 64 AS width, count(*)::INT AS height, -180.0::DOUBLE + label * 30.0::DOUBLE AS min_lon, -60.0::DOUBLE AS min_lat, -180.0::DOUBLE + label * 30.0::DOUBLE + 60.0::DOUBLE AS max_lon, 60.0::DOUBLE AS max_lat FROM embeddings GROUP BY label",
    "ext": "SELECT o_orderkey AS id, -180.0::DOUBLE + ((o_orderkey * 37) % 3500)::DOUBLE / 10.0::DOUBLE AS min_lon, -90.0::DOUBLE + ((o_orderkey * 53) % 1700)::DOUBLE / 10.0::DOUBLE AS min_lat, least(180.0::DOUBLE, -180.0::DOUBLE + ((o_orderkey * 37) % 3500)::DOUBLE / 10.0::DOUBLE + 0.1::DOUBLE + (o_custkey % 90)::DOUBLE / 10.0::DOUBLE) AS max_lon, least(90.0::DOUBLE, -90.0::DOUBLE + ((o_orderkey * 53) % 1700)::DOUBLE / 10.0::DOUBLE + 0.1::DOUBLE + (o_custkey % 80)::DOUBLE / 10.0::DOUBLE) AS max_lat, (1 + o_custkey % 500)::DOUBLE AS pixel FROM orders",
    "tri": "SELECT l_orderkey * 8 + l_linenumber AS id, (l_orderkey * 17 % 3590)::DOUBLE / 10.0::DOUBLE - 180.0::DOUBLE AS x0, (l_partkey * 13 % 1790)::DOUBLE / 10.0::DOUBLE - 90.0::DOUBLE AS y0, l_quantity AS z0, (l_orderkey * 17 % 3590)::DOUBLE / 10.0::DOUBLE - 180.0::DOUBLE + 0.1::DOUBLE + (l_suppkey % 7)::DOUBLE / 10.0::DOUBLE AS x1, (l_partkey * 13 % 1790)::DOUBLE / 10.0::DOUBLE - 90.0::DOUBLE AS y1, l_extendedprice / 1000.0::DOUBLE AS z1, (l_orderkey * 17 % 3590)::DOUBLE / 10.0::DOUBLE - 180.0::DOUBLE AS x2, (l_partkey * 13 % 1790)::DOUBLE / 10.0::DOUBLE - 90.0::DOUBLE + 0.1::DOUBLE + (l_partkey % 5)::DOUBLE / 10.0::DOUBLE AS y2, l_discount * 100.0::DOUBLE AS z2 FROM lineitem",
    "face": "SELECT l_orderkey * 8 + l_linenumber AS face, l_partkey % 500 AS v0, l_suppkey % 97 + 500 AS v1, l_orderkey % 800 + 600 AS v2 FROM lineitem",
    "vox": "SELECT (p_partkey % 8)::INT AS ix, (p_partkey // 8 % 8)::INT AS iy, (p_partkey // 64 % 8)::INT AS iz, (p_size * 5)::INT AS alpha, p_partkey AS seq FROM part",
    "leg": "SELECT n_nationkey * 20.0::DOUBLE AS value, (n_nationkey * 37 % 256)::INT AS r, (n_nationkey * 59 % 256)::INT AS g, (n_nationkey * 83 % 256)::INT AS b FROM nation",
    "feat": "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, n_name AS nation, c_acctbal AS height FROM customer JOIN nation ON c_nationkey = n_nationkey",
}


def oracle(*names: str, recursive: bool = False) -> str:
    """WITH clause of the named projections, open for more; what is named here is computed once."""
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ", ".join(f"{n} AS MATERIALIZED ({SQL[n]})" for n in names)
