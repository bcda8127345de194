"""All queries of the library by name, with the SQL that gives the same rows where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import geometry_queries, library_queries, mesh_queries, model_queries, pyramid_queries, raster_queries, shape_queries, solid_queries, surface_queries, tile_queries

_MODULES = [tile_queries, raster_queries, mesh_queries, model_queries, geometry_queries, shape_queries, surface_queries, solid_queries, library_queries, pyramid_queries]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
ORACLE: dict[str, str] = {k: s for m in _MODULES for k, s in m.ORACLE.items()}
FLAGSHIP = "mesh_pyramid"
