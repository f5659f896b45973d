"""tallycheck: clean, reconcile and gate two-source tabular data on Spark.

Sub-packages:
  functions  Column -> Column helpers (text, numbers, dates, flags)
  operators  lookups, reconciliation, rollups, checks, gate
  sources    CSV reading under contracts, missing-source policies, sinks
  plans      the election configuration and the driver-table query catalogue
  streaming  incremental (Structured Streaming) form of the coverage timeline
"""

from tallycheck.session import configure, get_session

__all__ = ["configure", "get_session"]
