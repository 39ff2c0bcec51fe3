"""starloom: measurement-to-star-schema engine on Spark DataFrames.

Layout
------
functions/  Column -> Column building blocks (calendar, clock, keys, measures)
sources/    typed scans: Parquet tables, CSV with quarantine, recorded JSON
            payloads, JDBC
operators/  DataFrame -> DataFrame operators: contracts, time series,
            enrichment, star schema, keyed upsert, integrity checks, reports
plans/      stand-in inputs over the driver tables and the registered queries
streaming/  incremental day-by-day load with Structured Streaming
"""

__version__ = "0.1.0"
