"""Scans, sinks, catalog helpers, raster metadata and driver-table fixtures."""

from pixelframe.sources.pixels import (
    PIXEL_COLUMNS, BAND_NAMES, FEATURES, pixel_schema, read_pixels_csv, write_pixels_csv,
    apply_schema, schema_violations, register, preview, schema_report,
)
from pixelframe.sources.raster import (
    RasterMeta, raster_meta_frame, read_band, write_pixels, write_pixels_bucketed,
)

__all__ = [
    "PIXEL_COLUMNS", "BAND_NAMES", "FEATURES", "pixel_schema", "read_pixels_csv",
    "write_pixels_csv", "apply_schema", "schema_violations", "register", "preview",
    "schema_report", "RasterMeta", "raster_meta_frame", "read_band", "write_pixels",
    "write_pixels_bucketed",
]
