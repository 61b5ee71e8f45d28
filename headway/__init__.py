"""Transit-delay analytics as Spark DataFrame operators.

functions/  fixed thresholds, wire schemas, column helpers
sources/    topic readers, feed decoding, the test-data adapter
operators/  ingest, parse, window aggregates, state, models, hotspots,
            percentiles, quality, dashboard products, ML
sinks/      table reads/writes, merge/upsert, incremental filter, compaction
streaming/  streaming jobs over the same operators (jobs.py)
plans/      compositions over the test tables, query registry, DuckDB twins,
            SQL views, plan report
"""
