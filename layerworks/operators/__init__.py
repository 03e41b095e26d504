"""Generic DataFrame operators: dedup, routing, merge, versions."""
