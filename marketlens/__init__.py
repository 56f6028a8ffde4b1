"""marketlens: a PySpark-native retail analytics library.

Landing ingest with lineage columns, typed staging, key deduplication, a star
schema with surrogate keys, a daily regional KPI table, data-quality checks and
local-time/holiday volume baselines. Everything is expressed with the DataFrame
API so Catalyst plans the whole model graph as one job.
"""

__version__ = "0.1.0"
