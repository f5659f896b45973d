"""Distributed operators; each returns a lazy DataFrame."""

from tallycheck.operators import checks, gate, lookup, ordering, reconcile, rollups

__all__ = ["checks", "gate", "lookup", "ordering", "reconcile", "rollups"]
