"""Queries over the driver's tables; importing any module of this package fills the registry."""

from cellgrid.plans import grid_queries, registry, score_queries, series_queries, shape_queries  # noqa: F401
