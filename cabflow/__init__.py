"""cabflow: trip-and-fare analytics expressed as Spark DataFrame plans.

Sub-packages
------------
sources    readers for the raw feeds, processed Parquet, dimensions and test fixtures
sinks      writers (partitioned Parquet, CSV, JSON text, model metrics)
functions  pure ``Column`` builders (rules, features, bins, haversine)
operators  DataFrame -> DataFrame steps (quality, matching, enrichment, profile, KPIs,
           business questions, ML)
plans      end-to-end jobs (ETL, reprocess-from-Parquet) and the CLI
streaming  intentionally empty: the workload is bounded batch only
"""

from cabflow.session import build_session, scratch_dir  # noqa: F401
