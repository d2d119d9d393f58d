"""capture_lake: a Spark-native capture lake.

Turns buckets of scanned document captures into a checked, day-partitioned
table: listing filters, content-hash dedup, source-archive joins, recognised
text assembly, typed metadata, range rules with quarantine, batch and
streaming ingest.  Row codecs and models plug in as user functions.
"""

__version__ = "0.1.0"
