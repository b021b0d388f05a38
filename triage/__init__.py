"""triage — PySpark-native message triage analytics.

Every operator takes and returns Spark DataFrames. Subpackages:

* ``sources``   base tables (explicit schemas), mail fixture views, nested JSON payloads
* ``functions`` pure ``Column`` builders (feature extraction, text cleaning, scoring)
* ``operators`` reusable DataFrame operators (joins, writes, aggregates, windows)
* ``plans``     domain jobs: reports, rule mining, gateway, sync, snapshots, audits
* ``streaming`` Structured Streaming jobs and their batch twins
"""

AS_OF = "2024-01-31 00:00:00"
