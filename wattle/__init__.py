"""wattle: time-series consolidation and forecasting on Spark DataFrames.

Sub-packages
  functions/  pure Column expressions (cleaning, calendar, numeric helpers)
  sources/    readers for raw source files, driver tables and derived stand-ins, sinks
  operators/  DataFrame -> DataFrame building blocks (resample, merge, quality, models)
  plans/      end-to-end jobs and the query catalogue used by ``__spark_entry__``
  streaming/  incremental (Structured Streaming) variant of the resampling job
"""

__version__ = "0.1.0"
