"""zonefare: zone-based dynamic pricing analytics on Spark DataFrames.

Sub-packages
  sources    table loaders, the ride-event view, stream sources and JSON decode
  functions  Column-returning scalar functions (pricing, time, weather, geo, text)
  operators  aggregates, latest-per-key, windows, joins, quality checks, calendar
  plans      composite queries (serving look-ups, dashboard roll-ups, query registry)
  streaming  Structured Streaming jobs and the Parquet history / current store
  model      Spark ML training and scoring
"""

from zonefare.config import DEFAULT, PricingConfig

__all__ = ["DEFAULT", "PricingConfig"]
