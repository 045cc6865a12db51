"""faultline: machine-health analytics written as Spark DataFrame, SQL, MLlib and
Structured Streaming jobs.

Sub-packages
------------
sources    file discovery, table readers, archives, images, sinks, artifacts
functions  column-level helpers (name standardisation, lenient parsing, null rules)
operators  DataFrame -> DataFrame operators (combine, clean, KNN, features, metrics, models)
plans      end-to-end compositions and the registry of named queries
streaming  envelope parsing and the keyed upsert sink
"""

__version__ = "0.1.0"
