"""rides: bike-share trip analytics expressed as Spark DataFrame plans.

Layout
------
functions/  Column-level helpers (haversine, surrogate key, calendar parts).
sources/    Readers and writers: by-name CSV, zip archives, Parquet, shared folders.
operators/  Reusable relational building blocks (rolling stats, month-over-month,
            ranking, exact percentiles, upsert, data-quality checks).
plans/      The models (staging, intermediate, dimensions, facts) and reports.
streaming/  File-arrival incremental load on Structured Streaming.
"""

from rides.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
