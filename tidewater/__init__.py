"""tidewater: service-event analytics on Spark DataFrames.

Layers (each a set of pure ``DataFrame -> DataFrame`` functions):

* ``sources``   – schema-checked scans (JSON Lines / CSV / Parquet), page unpacking, test fixtures
* ``operators`` – dedup, validation, latest-per-key, order timeline, running stock, KPIs, ops roll-ups
* ``functions`` – reusable Column expressions (rules, time arithmetic, rounding)
* ``sinks``     – partitioned Parquet / JSON writers
* ``plans``     – the three batch jobs and the query registry used by ``__spark_entry__``
* ``streaming`` – Structured Streaming twin of scan, dedup and windowed KPIs
"""

__version__ = "0.1.0"
