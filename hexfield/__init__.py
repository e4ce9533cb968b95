"""Site-suitability analytics on Spark: hexagonal grids, spatial joins, rasters, scoring."""
