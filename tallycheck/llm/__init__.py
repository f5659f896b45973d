"""Operators for preparing training text at scale. One module per operator;
``queries`` applies each to the driver tables."""
