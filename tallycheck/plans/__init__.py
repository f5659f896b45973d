"""Configurations of the operators: the election run and the query catalogue."""
