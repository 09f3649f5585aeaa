"""voltaic — facility sensor analytics as Spark DataFrame pipelines.

Layout:
  session      session defaults (UTC, AQE) and the shared checkpoint folder
  schemas      declared StructTypes and data-rule declarations
  adapters     driver test tables -> domain frames (readings, sensors, ...)
  functions/   Column-expression helpers (rounding, time buckets, interpolation)
  operators/   the pipelines: scoring, ranking, reports, timeseries, quality,
               load/merge, layout
  sources/     typed CSV/JSON scans, default columns, sinks
  plans/       report registry + runner, the registered query catalogue
  streaming/   incremental file loads with Structured Streaming
"""

__version__ = "0.1.0"
