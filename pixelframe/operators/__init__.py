"""DataFrame operators: preparation, raster algebra, features, metrics, reports."""
