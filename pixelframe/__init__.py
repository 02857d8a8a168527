"""pixelframe — raster pixels to model-ready tables and Spark ML models.

Every public function takes and returns Spark ``DataFrame`` / ``Column``
objects; the only driver-side values are fitted models and a handful of
bounded scalars (class counts, grid parameters, parameter maps).

Sub-packages
------------
sources    scans, sinks, catalog helpers, raster metadata and test fixtures
functions  pure ``Column`` expressions (Albers projection, predicates, report formats)
operators  DataFrame operators (data preparation, raster algebra, features, metrics, reports)
plans      Spark ML estimators, pipelines, tuning and end-to-end workflows
"""

from pixelframe.session import get_spark, checkpoint_dir, scratch_path, read_table, release_scratch

__all__ = ["get_spark", "checkpoint_dir", "scratch_path", "read_table", "release_scratch"]
