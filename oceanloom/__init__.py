"""A PySpark engine for gridded ocean-model snapshots.

Every frame is long: one row per grid cell, keyed by ``(face, j, i)``.  Missing
values are NULL everywhere; ``oceanloom.schema.nan_to_null`` turns the IEEE NaN
of model output into NULL once, at ingest.
"""
