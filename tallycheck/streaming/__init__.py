"""Structured Streaming entry points.

The reference has no streaming operators; election returns simply arrive over
the night. :mod:`tallycheck.streaming.timeline` keeps the coverage timeline
(rollup A5) current from a folder of arriving ER files, reusing the batch
operators inside ``foreachBatch``.
"""

from tallycheck.streaming.timeline import current_timeline, start_timeline

__all__ = ["current_timeline", "start_timeline"]
