"""tidewatch — a Spark-native market-signal engine.

Lands trade and snapshot feeds, types them into clean tables through
idempotent merges, and scores ten-minute VWAP windows against a moving
six-hour baseline.  Every stage is a DataFrame / Spark SQL plan or a
Structured Streaming query; see README.md for the module map.
"""

__version__ = "0.1.0"
